"""Byte-level BPE encoding and decoding by tree reduction.

A text is cut by the pattern of its vocabulary; every match is encoded on its own. Within a
match the tokens form a monoid: two neighbouring encodings are joined into the encoding of
the joined bytes. A long match is therefore encoded by halves, recursively, and the halves
are joined at their boundary; only short leaves run the merge loop.

Joining rests on one property of such vocabularies: a sequence of tokens is the encoding of
its bytes exactly when every two adjacent tokens are the encoding of their own joined bytes.
The join re-encodes a window of some tokens on each side of the boundary. If the window keeps
its outermost tokens, every adjacent pair of the whole is a pair of a valid encoding, so
nothing outside the window can change; if not, the window grows, up to everything.

Decoding concatenates bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from itertools import islice
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from wanderlake.llm.common import scored

LEAF_BYTES = 24
CACHED_PIECES = 400_000
PIECES_AT_ONCE = 200_000
WINDOW = 4


class BytePairs:
    """A vocabulary of byte strings with ranks; the rank is the token id."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks single bytes: {missing[:5]}")
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}

    @classmethod
    def from_file_bytes(cls, raw: bytes) -> BytePairs:
        """Lines of base64 token and rank."""
        pairs = (line.split() for line in raw.splitlines() if line)
        return cls({base64.b64decode(token): int(rank) for token, rank in pairs})

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) <= LEAF_BYTES:
            return self._merge(piece)
        middle = len(piece) // 2
        return self.join(self.encode(piece[:middle]), self.encode(piece[middle:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the joined bytes of two encodings."""
        if not left or not right:
            return left + right
        width = WINDOW
        while True:
            outer_left, outer_right = max(0, len(left) - width), min(len(right), width)
            inside = left[outer_left:] + right[:outer_right]
            window = b"".join(map(self.bytes_of.__getitem__, inside))
            new = self._merge(window)
            settled_left = outer_left == 0 or new[0] == left[outer_left]
            settled_right = outer_right == len(right) or new[-1] == right[outer_right - 1]
            if settled_left and settled_right:
                return left[:outer_left] + new + right[outer_right:]
            width *= 2

    def _merge(self, piece: bytes) -> list[int]:
        """Merge the adjacent pair of lowest rank, the leftmost first, until none is left."""
        ranks = self.ranks
        rank, none = ranks.get, 1 << 40
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [rank(piece[i : i + 2], none) for i in range(len(piece) - 1)]
        pairs.append(none)  # the last part has no neighbour
        while (best := min(pairs)) < none:
            at = pairs.index(best)
            joined = parts[at] = parts[at] + parts.pop(at + 1)
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + joined, none)
            if at + 1 < len(parts):
                pairs[at] = rank(joined + parts[at + 1], none)
        return [ranks[p] for p in parts]

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of a sequence of ids, halves joined up the tree."""
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


class _Pieces(dict):
    """Encoded matches met so far, each as packed ids; emptied when full, so memory is bounded."""

    def __init__(self, table: BytePairs):
        super().__init__()
        self.table = table

    def __missing__(self, piece: str) -> bytes:
        ids = self.table.encode(piece.encode("utf-8"))
        packed = pack(f"<{len(ids)}I", *ids)
        if len(self) >= CACHED_PIECES:
            self.clear()
        if len(piece) <= 64:
            self[piece] = packed
        return packed


class Codec:
    """Whole texts to packed ids (unsigned 32-bit little-endian) and back."""

    def __init__(self, table: BytePairs, pattern: str):
        self.table = table
        self.pattern = regex.compile(pattern)
        self.pieces = _Pieces(table)

    def encode_text(self, text: str | None) -> bytes:
        if not text:
            return b""
        encode = self.pieces.__getitem__
        if len(text) <= PIECES_AT_ONCE:
            return b"".join(map(encode, self.pattern.findall(text)))
        matches, parts = (m[0] for m in self.pattern.finditer(text)), []
        while some := list(islice(matches, PIECES_AT_ONCE)):
            parts.append(b"".join(map(encode, some)))
        return b"".join(parts)

    def decode_ids(self, packed: bytes) -> bytes:
        return self.table.decode(np.frombuffer(packed, "<u4").tolist())


@lru_cache(maxsize=2)
def _codec(raw: bytes, pattern: str) -> Codec:
    return Codec(BytePairs.from_file_bytes(raw), pattern)


def encode_decode(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids_as_array: bool = False) -> DataFrame:
    """Add ``n_tokens``, ``token_ids`` and ``decoded`` to every row of ``df``.

    ``vocabulary`` is a file of base64 tokens and ranks that the driver can read; its bytes
    (bounded by the vocabulary) are broadcast. ``token_ids`` is binary, ids as little-endian
    unsigned 32-bit integers, or an array of integers with ``ids_as_array``; ``decoded`` is
    binary, the bytes of the decoded ids. Columns of these names in ``df`` are replaced.

    A null or empty text gives no tokens and empty bytes. Special tokens are never produced;
    their spelling in a text is ordinary text. Equal texts give equal rows; an empty table
    gives an empty table; a match of any length is encoded by halves.
    """
    with open(vocabulary, "rb") as file:
        raw = df.sparkSession.sparkContext.broadcast(file.read())

    def scorer():
        codec = _codec(raw.value, pattern)

        def score(texts):
            packed = [codec.encode_text(t) for t in texts]
            decoded = [codec.decode_ids(p) for p in packed]
            counts = [len(p) // 4 for p in packed]
            ids = pa.array(packed, pa.binary())
            if ids_as_array:
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(packed), "<i4")))
            return [counts, ids, decoded]

        return score

    kind = T.ArrayType(T.IntegerType()) if ids_as_array else T.BinaryType()
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("token_ids", kind), T.StructField("decoded", T.BinaryType())]
    return scored(df, text, fields, scorer)
