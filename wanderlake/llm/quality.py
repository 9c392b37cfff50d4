"""Quality rules by distribution divergence.

For every language the whole corpus gives two reference histograms: of character classes and
of common words (those with at least ``COMMON_SHARE`` of the language's words; all others
together are one more bin). A document is compared with its language's references by the
Jensen-Shannon distance. Short documents have noisy histograms, so each comparison holds only
from a minimum length.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderlake.llm.common import scored, ship
from wanderlake.session import remove, scratch_dir

SYMBOLS = "#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "blank", "line", "mark", "symbol", "beyond")
COMMON_SHARE = 0.002  # so a language has at most 500 common words
WINDOW = 8
FLUSH_WORDS = 2_000_000


@dataclass(frozen=True)
class Rules:
    """Limits of the verdict."""

    least_words: int = 20
    repeat_percent: int = 30
    class_distance: float = 0.3
    class_chars: int = 200
    word_distance: float = 0.45
    word_words: int = 100
    reference_words: int = 1000  # a language with fewer words is compared with all texts together


def _class_of(code: int) -> int:
    c = chr(code)
    if c == "\n":
        return 4
    if c.isspace():
        return 3
    if c in SYMBOLS:
        return 6
    kind = unicodedata.category(c)
    if kind[0] == "L":
        return 1 if kind in ("Lu", "Lt") else 0
    return 2 if kind[0] == "N" else 5 if kind[0] in "PMS" else 7


def class_table() -> np.ndarray:
    """Class of every code of the first plane; those beyond have the last class."""
    return np.array([_class_of(i) for i in range(0x10000)], np.uint8)


_BLANK = np.zeros(0x10000, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def _codes(text: str) -> np.ndarray:
    return np.minimum(np.frombuffer(text.encode("utf-32-le"), "<u4"), 0xFFFF)


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of eight that stand twice or more in the text, the first included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    keys = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + (ids[k : k + n] ^ (ids[k : k + n] >> np.uint64(31)))
    _, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
    if len(counts) == n:
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    again = np.flatnonzero(counts[place] > 1)
    np.add.at(edges, again, 1)
    np.add.at(edges, again + WINDOW, -1)
    return int((np.cumsum(edges) > 0).sum())


def repeated_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


@dataclass
class Reference:
    """Histograms of one language: character classes, and common words with their counts."""

    classes: np.ndarray
    words: dict[bytes, int]
    total_words: int


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, the root of the divergence in bits: 0 to 1."""
    p, q = p / max(p.sum(), 1), q / max(q.sum(), 1)
    middle = (p + q) / 2

    def part(x):
        on = x > 0
        return (x[on] * np.log2(x[on] / middle[on])).sum()

    return float(np.sqrt(max(0.0, (part(p) + part(q)) / 2)))


def references(docs: DataFrame, text: str = "text", lang: str = "lang", common_share: float = COMMON_SHARE) -> dict[str, Reference]:
    """References of every language over all documents.

    Tasks count their own words before the shuffle; the driver receives only words above the
    common share, at most 1 / ``common_share`` for each language.
    """

    def rows(words, classes):
        for name, counted in words.items():
            data = [[name] * len(counted), list(counted), list(counted.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(data, (pa.string(), pa.binary(), pa.int64()), strict=True)], names=["lang", "word", "n"])
        for name, counted in classes.items():
            # Classes share the rows of words; no word holds a blank.
            data = [[name] * len(CLASSES), [b" %d" % i for i in range(len(CLASSES))], counted.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(data, (pa.string(), pa.binary(), pa.int64()), strict=True)], names=["lang", "word", "n"])

    def run(batches):
        table, words, classes, held = class_table(), {}, {}, 0
        for batch in batches:
            for value, name in zip(batch.column(0), batch.column(1), strict=True):
                value, name = value.as_py(), name.as_py()
                found = value.encode("utf-8").lower().split()
                words.setdefault(name, Counter()).update(found)
                classes.setdefault(name, np.zeros(len(CLASSES), np.int64))
                classes[name] += np.bincount(table[_codes(value)], minlength=len(CLASSES))
                held += len(found)
                if held >= FLUSH_WORDS:
                    yield from rows(words, classes)
                    words, classes, held = {}, {}, 0
        yield from rows(words, classes)

    ship(docs.sparkSession)
    named = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang), F.lit("")).alias("lang")).filter(F.col("text").isNotNull())
    counts = named.mapInArrow(run, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    # Read twice below, so the texts are counted once and the counts stored.
    staging = scratch_dir(docs.sparkSession, "word-counts")
    counts.write.parquet(staging)
    marked = docs.sparkSession.read.schema(counts.schema).parquet(staging).withColumn("is_class", F.substring("word", 1, 1) == F.lit(b" "))
    totals = marked.filter(~F.col("is_class")).groupBy("lang").agg(F.sum("n").alias("total"))
    kept = marked.join(F.broadcast(totals), "lang", "left").filter(F.col("is_class") | (F.col("n") >= common_share * F.col("total")))
    out: dict[str, Reference] = {}
    for r in kept.collect():
        own = out.setdefault(r["lang"], Reference(np.zeros(len(CLASSES)), {}, int(r["total"] or 0)))
        if r["is_class"]:
            own.classes[int(bytes(r["word"]))] = r["n"]
        else:
            own.words[bytes(r["word"])] = r["n"]
    remove(docs.sparkSession, staging)
    return out


class Judge:
    """Measures one text and compares it with its language's references."""

    def __init__(self, refs: dict[str, Reference], rules: Rules):
        self.rules, self.table, self.refs = rules, class_table(), {}
        every = Reference(np.zeros(len(CLASSES)), Counter(), 0)
        for r in refs.values():
            every.classes += r.classes
            every.words.update(r.words)
            every.total_words += r.total_words
        for name, r in {None: every, **refs}.items():
            if name is None or r.total_words >= rules.reference_words:
                bins = {word: i for i, word in enumerate(sorted(r.words))}
                counts = np.array([r.words[w] for w in sorted(r.words)] + [r.total_words - sum(r.words.values())], float)
                self.refs[name] = (r.classes, bins, counts)

    def judge(self, text: str | None, lang: str | None) -> tuple:
        raw, rules = (text or "").encode("utf-8"), self.rules
        words, codes = raw.split(), _codes(text or "")
        n_words, repeated = len(words), repeated_words(words)
        classes = np.bincount(self.table[codes], minlength=len(CLASSES))
        failed = n_words < rules.least_words or 100 * repeated > rules.repeat_percent * n_words
        usual, bins, common = self.refs.get(lang) or self.refs[None]
        by_class = by_word = None
        if len(codes) >= rules.class_chars and usual.sum():
            by_class = distance(classes, usual)
        if n_words >= rules.word_words and common.sum():
            place = [bins.get(w, len(bins)) for w in raw.lower().split()]
            by_word = distance(np.bincount(place, minlength=len(bins) + 1), common)
        odd = (by_class or 0) > rules.class_distance or (by_word or 0) > rules.word_distance
        chars = len(codes) - int(_BLANK[codes].sum())
        return n_words, chars, int(classes[6]), repeated_lines(raw), repeated, failed, by_class, by_word, not (failed or odd)


def assess(df: DataFrame, refs: dict[str, Reference], text: str = "text", lang: str = "lang", rules: Rules = Rules()) -> DataFrame:
    """Add the measures of every text, its two distances and the verdict ``kept``.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``; ``base_failed`` by the rules of length and repetition;
    ``class_distance`` and ``word_distance``, null below their minimum lengths; ``kept``, false
    if the base failed or a distance is over its limit. A null text has no words and fails the
    base. A null or unknown language, or one with few words, is compared with all texts
    together. Rows are independent: repeated rows stay, an empty table stays empty. The
    references are broadcast: at most 500 words for each language.
    """
    shared = df.sparkSession.sparkContext.broadcast((refs, rules))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance", "word_distance", "kept")
    kinds = (T.LongType(),) * 5 + (T.BooleanType(), T.DoubleType(), T.DoubleType(), T.BooleanType())
    fields = [T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]

    def scorer():
        judge = Judge(*shared.value).judge
        return lambda texts, langs: list(zip(*map(judge, texts, langs), strict=True)) or [[]] * len(names)

    return scored(df, [text, lang], fields, scorer)
