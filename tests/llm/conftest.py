from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators give to what they add.
        T.StructField("size", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("component_id", T.StringType()),
        T.StructField("decoded", T.StringType()),
    ]
)

WORDS = {
    "en": "the of and to in is that it for was on are with as his they at be this from".split(),
    "de": "der die und das nicht über schön für mit auf ist von den zu ein straße größe wäre".split(),
}


def prose(seed: int, n: int, lang: str = "en") -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", "ing", "er", ".", ","]) for _ in range(n))


def doc(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text or ""), "x", "x", "x", "x")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null, empty, blank, short, long and repeated texts; null ids, languages and sources."""
    long_text = prose(1, 30_000)
    rows = [
        doc(1, None),
        doc(2, ""),
        doc(3, " \t\n"),
        doc(4, "one two"),
        doc(5, "One  TWO"),
        doc(6, long_text),
        doc(7, long_text),
        doc(7, long_text),
        doc(8, prose(2, 200), None, None),
        doc(9, prose(3, 200, "de"), "de", "b"),
        doc(None, prose(3, 200, "de"), "de", "b"),
        doc(None, None, None, None),
        doc(10, "x" * 5_000 + "é\U0001f600\u00a0漢字", "en", "b"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
