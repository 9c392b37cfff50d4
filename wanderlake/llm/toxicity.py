"""Toxicity by multiple-instance learning.

Only documents have labels; the model scores sentences. A document's chance of being toxic
is the noisy-or of its sentences, 1 - prod(1 - p), so a single sentence suffices, and the
gradient of the document's label reaches the sentences that explain it. The same sentence
scores then say where a document offends.

The small chances of harmless sentences must not add up with the length of a text. When texts
are scored, different sentences above ``FLOOR`` combine by noisy-or, each counted once; of all
others only the largest chance counts, as a leak that is the same for short and long texts.

The labelled sample stays in Spark: tasks count in how many documents a feature stands, and
turn the sample into numbers of the chosen features, sentence by sentence. Equal sentences of a
document are one with a weight, so a long document is as welcome as a short one.

A sentence has at most ``LONGEST`` words; a longer one is cut. It is a bag of words; a word counts as itself and as its beginnings, so inflected and
compounded forms of a learned stem are recognised.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderlake.llm.common import is_held_out, scored, ship, staged
from wanderlake.session import remove

SENTENCE = re.compile(r"[^.!?\n]+")
BEGINNINGS = (3, 4, 5, 6)
FLOOR = 0.1
LONGEST = 50
EDGES = "\"'`,;:()[]{}<>|*#$%&_-+=/\\~^…«»“”‘’„¿¡"
SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))


@dataclass(frozen=True)
class Fit:
    """Bounds of the training sample and of the model.

    At most ``docs_of_a_label`` documents of each label, of any length. A document with more
    different sentences than ``sentences_of_a_doc`` is fitted by its most suspicious ones.
    """

    docs_of_a_label: int = 3000
    sentences_of_a_doc: int = 2000
    features: int = 4000
    least_docs: int = 4
    least_z: float = 3.5
    steps: int = 300
    rate: float = 0.1
    ridge: float = 1e-3


_PART = re.compile(r"\S+(?:\s+\S+){0,%d}" % (LONGEST - 1))


def sentences(text: str) -> Iterator[tuple[int, int, str]]:
    """First character, end and text of every sentence."""
    for found in SENTENCE.finditer(text):
        if found.end() - found.start() < 2 * LONGEST:
            yield *found.span(), found[0]
        else:
            for part in _PART.finditer(text, *found.span()):
                yield *part.span(), part[0]


def features_of(word: str) -> list[str]:
    """The word without punctuation around it, and its beginnings (marked by a bar)."""
    word = word.strip(EDGES)
    return [word, *(word[:n] + "|" for n in BEGINNINGS if len(word) >= n)] if word else []


@dataclass
class SentenceModel:
    """Log-odds of a sentence: ``bias`` plus the weights of its different words' features."""

    weights: dict[str, float]
    bias: float
    _words: dict[str, float] = field(default_factory=dict)

    def word(self, word: str) -> float:
        score = self._words.get(word)
        if score is None:
            if len(self._words) >= 500_000:
                self._words.clear()
            score = self._words[word] = sum(self.weights.get(f, 0.0) for f in features_of(word))
        return score

    def document(self, text: str | None, spans_from: float = 0.5) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or of the suspicious sentences, and those with a chance of ``spans_from`` or more."""
        if not text or not self.weights:
            return 0.0, []
        clean, leak, spans, seen, word = 0.0, 0.0, [], set(), self.word
        for start, end, sentence in sentences(text):
            words = frozenset(sentence.lower().split())
            logit = self.bias + sum(map(word, words))
            if logit < _FLOOR_LOGIT:
                leak = max(leak, _softplus(logit))
                continue
            if words not in seen:
                seen.add(words)
                clean += _softplus(logit)
            if logit >= 0 and (p := 1 / (1 + math.exp(-logit))) >= spans_from:
                spans.append((start, end, p))
        return -math.expm1(-clean - leak), spans


_FLOOR_LOGIT = math.log(FLOOR / (1 - FLOOR))


def _softplus(x: float) -> float:
    return x + math.log1p(math.exp(-x)) if x > 0 else math.log1p(math.exp(x))


def labelled_sample(docs: DataFrame, labels: DataFrame, fit: Fit, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``toxic, text``: at most ``fit.docs_of_a_label`` texts of each label, of the smallest hashes of their ids.

    Only ids outside the held-out fold. An id labelled both ways counts as toxic; of repeated
    documents the smallest text is taken. The chosen ids are few by construction, so they are
    broadcast to the scan of the texts.
    """
    marks = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out())
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    chosen = [marks.filter(F.col("toxic") == y).orderBy(*order).limit(fit.docs_of_a_label) for y in (0, 1)]
    chosen = chosen[0].union(chosen[1]).select(F.col("doc_id").alias("_wl_id"), "toxic")
    texts = docs.select(F.col(f"`{doc_id}`").alias("_wl_id"), F.col(f"`{text}`").alias("text")).filter("text IS NOT NULL")
    return texts.join(F.broadcast(chosen), "_wl_id").groupBy("_wl_id", "toxic").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, fit: Fit = Fit(), text: str = "text", doc_id: str = "doc_id") -> SentenceModel:
    """A sentence model fitted to document labels on a bounded sample.

    The sample is spread over labels evenly; weights restore their true shares, so scores are
    chances. Without texts of both labels nothing can be learned, and every score is 0. The
    driver gets at most ``fit.features`` features and whole numbers, no texts.
    """
    spark = docs.sparkSession
    sample, folder = staged(spark, labelled_sample(docs, labels, fit, text, doc_id), "labelled")
    counts = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    share = labels.filter(F.col("toxic").isin(0, 1) & ~is_held_out()).agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    model = SentenceModel({}, 0.0)
    if counts.get(0) and counts.get(1):
        share = min(max(share, 1e-3), 1 - 1e-3)
        found = _screened(sample, counts[1], counts[0], fit)
        bags = _bags(sample, found, fit)
        y = bags["toxic"].to_numpy().astype(float)
        weight = np.where(y == 1, share * len(y) / y.sum(), (1 - share) * len(y) / (len(y) - y.sum()))
        model = _fitted(bags, y, weight, list(found), fit)
    remove(spark, folder)
    return model


def _screened(sample: DataFrame, toxic: int, clean: int, fit: Fit) -> dict[str, float]:
    """Features that stand in clearly more of the toxic documents, the clearest first, with their z values."""

    def count(batches):
        known = {}
        for batch in batches:
            for label, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for name in {f for word in set(value.as_py().lower().split()) for f in features_of(word)}:
                    known.setdefault(name, [0, 0])[label] += 1
                if len(known) > 300_000:
                    yield _rows(known)
                    known = {}
        yield _rows(known)

    ship(sample.sparkSession)
    rows = sample.select("toxic", "text").mapInArrow(count, "name string, clean long, toxic long")
    rows = rows.groupBy("name").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter(F.col("toxic") >= fit.least_docs)
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / (toxic + 1 - a)) - F.log(b / (clean + 1 - b))
    rows = rows.select("name", (odds / F.sqrt(1 / a + 1 / b)).alias("z")).filter(F.col("z") >= fit.least_z)
    return {r["name"]: r["z"] for r in rows.orderBy(F.desc("z"), "name").limit(fit.features).collect()}


def _rows(known: dict[str, list[int]]) -> pa.RecordBatch:
    clean, toxic = zip(*known.values(), strict=True) if known else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(known, pa.string()), pa.array(clean, pa.int64()), pa.array(toxic, pa.int64())], names=["name", "clean", "toxic"])


def _bags(sample: DataFrame, found: dict[str, float], fit: Fit) -> pa.Table:
    """For every document ``toxic``, ``plain`` sentences without a feature, and the others' weights, sizes and features.

    Rows are in the order of their ids' hashes, so a fit does not depend on partitions.
    """
    place, z = {name: i for i, name in enumerate(found)}, list(found.values())

    def number(batches):
        of_word: dict[str, list[int]] = {}
        for batch in batches:
            out = []
            for value in batch.column(2):
                bags: Counter = Counter()
                for _, _, sentence in sentences(value.as_py()):
                    ids = []
                    for word in set(sentence.lower().split()):
                        if word not in of_word:
                            if len(of_word) >= 300_000:
                                of_word.clear()
                            of_word[word] = [place[f] for f in features_of(word) if f in place]
                        ids += of_word[word]
                    bags[tuple(sorted(ids))] += 1
                plain = bags.pop((), 0)
                kept = sorted(bags, key=lambda ids: (-sum(z[i] for i in ids), ids))[: fit.sentences_of_a_doc]
                out.append((plain, [bags[b] for b in kept], [len(b) for b in kept], [i for b in kept for i in b]))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            kinds = (pa.int64(), *[pa.list_(pa.int32())] * 3)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["key", "toxic", "plain", "weights", "sizes", "ids"])

    keyed = sample.select(F.xxhash64("_wl_id").alias("key"), F.col("toxic").cast("int"), "text")
    numbered = keyed.mapInArrow(number, "key long, toxic int, plain long, weights array<int>, sizes array<int>, ids array<int>")
    return numbered.orderBy("key", "plain").toArrow()


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column one after another, and how many each row has."""
    lists = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.list_(pa.int32()))
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.diff(lists.offsets.to_numpy())


def _fitted(bags: pa.Table, y: np.ndarray, weight: np.ndarray, names: list[str], fit: Fit) -> SentenceModel:
    """Full-batch Adam on the noisy-or likelihood. Sentences without a feature share one score."""
    plain = bags["plain"].to_numpy().astype(float)
    times, per_doc = _flat(bags["weights"])
    sizes, _ = _flat(bags["sizes"])
    feature_of, _ = _flat(bags["ids"])
    doc_of, sentence_of = np.repeat(np.arange(len(y)), per_doc), np.repeat(np.arange(len(sizes)), sizes)
    params = np.concatenate([np.full(len(names), 0.1), [-5.0]])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, fit.steps + 1):
        w, bias = params[:-1], params[-1]
        logit = bias + np.bincount(sentence_of, w[feature_of], len(doc_of))
        q = np.bincount(doc_of, times * np.logaddexp(0, logit), len(y)) + plain * np.logaddexp(0, bias)
        # Loss is q for a clean document and -log(1 - exp(-q)) for a toxic one.
        slope = weight * np.where(y == 1, -1 / np.expm1(np.clip(q, 1e-9, 50)), 1.0)
        by_sentence = slope[doc_of] * times / (1 + np.exp(-logit))
        grad = np.empty_like(params)
        grad[:-1] = np.bincount(feature_of, by_sentence[sentence_of], len(names)) / len(y) + fit.ridge * w / max(len(names), 1)
        grad[-1] = (by_sentence.sum() + (slope * plain).sum() / (1 + np.exp(-bias))) / len(y)
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        params = params - fit.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return SentenceModel(dict(zip(names, params[:-1].tolist(), strict=True)), float(params[-1]))


def score(df: DataFrame, model: SentenceModel, text: str = "text") -> DataFrame:
    """Add ``toxic_score`` (0 to 1) and ``toxic_spans``, the sentences that offend.

    A span is the first character and the end of a sentence in the text, with its own chance
    of 0.5 or more. Null and empty texts score 0 without spans. Whole texts are read, sentence
    by sentence; harmless sentences do not add up, however many there are; equal texts score
    the same; an empty table stays empty. The model is broadcast: at most ``Fit.features``
    weights.
    """
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def scorer():
        judge = SentenceModel(*shared.value).document
        return lambda texts: list(zip(*map(judge, texts), strict=True)) or [[], []]

    fields = [T.StructField("toxic_score", T.DoubleType()), T.StructField("toxic_spans", SPANS)]
    return scored(df, text, fields, scorer)
