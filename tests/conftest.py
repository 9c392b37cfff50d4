from __future__ import annotations

import contextlib
import io
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wanderlake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        # Plans are read by tests; their text is not to be cut once expression ids get long.
        spark__sql__maxMetadataStringLength="2000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def plan_of(df) -> str:
    """The physical plan as explain prints it."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()
