from __future__ import annotations

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from wanderlake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RAW = open(PATH, "rb").read()
CODEC = bpe.Codec(bpe.BytePairs.from_file_bytes(RAW), public_tokenizers.PATTERN)
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RAW.splitlines())}
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(text):
    return np.frombuffer(CODEC.encode_text(text), "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=300))
def test_any_text_is_encoded_as_the_library_does(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)
    assert CODEC.decode_ids(CODEC.encode_text(text)) == text.encode()


@pytest.mark.parametrize("alphabet", ["a", "ab", "aé", "the ing".replace(" ", ""), "漢字かな", "!?", "0123456789", "ößäschung"])
@pytest.mark.parametrize("length", [1, 23, 24, 25, 100, 3_000])
def test_long_matches_are_joined_from_halves(alphabet, length):
    rng = random.Random(length)
    text = "".join(rng.choice(alphabet) for _ in range(length))
    assert ids(text) == LIBRARY.encode_ordinary(text)


def test_every_token_encodes_to_itself():
    table = CODEC.table
    assert all(table.encode(token) == [rank] for token, rank in RANKS.items())


def test_join_equals_encoding_the_whole():
    rng, table = random.Random(3), CODEC.table
    for _ in range(300):
        left, right = (bytes(rng.choice(b"abcdeinrst") for _ in range(rng.randint(0, 40))) for _ in range(2))
        assert table.join(table.encode(left), table.encode(right)) == table.encode(left + right) == table._merge(left + right)


def test_rows(spark, edge_docs, no_docs):
    out = bpe.encode_decode(edge_docs, PATH, public_tokenizers.PATTERN, ids_as_array=True)
    rows = out.collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        assert r["token_ids"] == LIBRARY.encode_ordinary(r["text"] or "")
        assert r["n_tokens"] == len(r["token_ids"]) and bytes(r["decoded"]) == (r["text"] or "").encode()
        assert r["size"] == "x"
    assert bpe.encode_decode(no_docs, PATH, public_tokenizers.PATTERN).count() == 0


def test_batches_are_cut_by_rows_and_by_bytes():
    import pyarrow as pa

    from wanderlake.llm.common import _pieces

    batch = pa.RecordBatch.from_arrays([pa.array(["x" * (i * 100) for i in range(100)])], names=["text"])
    for rows, size in ((7, 1 << 30), (1000, 20_000), (1, 1), (1000, 1 << 30)):
        parts = list(_pieces(batch, rows, size))
        assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
        assert all(p.num_rows == 1 or (p.num_rows <= rows and p.nbytes <= size) for p in parts)
    assert list(_pieces(batch.slice(0, 0))) == []
