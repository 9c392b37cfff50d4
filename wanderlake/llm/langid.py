"""Language identification with interpolated Kneser-Ney character models.

One model for each language, learned from the n-grams of all training texts. Spark counts:
every task turns its texts into arrays of code points, packs all windows of ``order``
characters at once and sends one row for each language and different n-gram. Lower orders
follow from the highest one, as Kneser-Ney counts how many different characters stand before
an n-gram; their counts, context totals, back-off weights and interpolated probabilities are
tables that Spark groups and joins order by order. The models of all languages share sorted
arrays of packed n-grams, one array for each order, with a log-probability and a back-off
weight for every language beside each n-gram.

A text gets the language of lowest cross-entropy, in bits a character. It is rejected when
even that is higher than calibrated: the mean and spread of the training texts' own
cross-entropies, with more room for short texts.

A packed n-gram is the whole n-gram, so an unseen one is never taken for another; characters
that need more than 16 bits are numbered by ``rare_characters``. Arrays of at
most ``MOST_CELLS`` n-grams times languages are broadcast. Larger models stay tables: the
different n-grams of the texts to score get their log-probabilities by joins with them, and
every text sums those of its own n-grams. Both ways give the same numbers, in double precision.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderlake.llm.common import scored, ship, staged, written
from wanderlake.operators.lookup import find_hot_keys, lookup
from wanderlake.session import remove

ORDER = 4  # the largest that one 64-bit number holds
UNDETERMINED = "und"
SLICE = 500_000
DISCOUNT = 0.75
MOST_CELLS = 1 << 22  # n-grams of all orders times languages: about 80 MB at four languages

_PAD = 0xFFFF  # stands before a text
_FIRST_RARE, _OTHER = 0xE000, 0xF8FF  # the private codes
_RARE = re.compile("[\ue000-\uf8ff\uffff\U00010000-\U0010ffff]")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def normal_form(text: str) -> str:
    """Lower case with white space as one space: what the models see."""
    return " ".join(text.lower().split())


def _codes(text: str, rare: dict[int, int]) -> np.ndarray:
    """Codes of 16 bits: digits as one, characters beyond the first plane and private ones as ``rare`` has them."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    codes[(codes >= 48) & (codes <= 57)] = 48
    odd = np.flatnonzero((codes >= _PAD) | ((codes >= _FIRST_RARE) & (codes <= _OTHER)))
    if len(odd):
        found, place = np.unique(codes[odd], return_inverse=True)
        codes[odd] = np.array([rare.get(c, _OTHER) for c in found.tolist()], np.uint64)[place]
    return codes


def rare_characters(training: DataFrame, text: str) -> dict[int, int]:
    """Codes of their own for the characters of the training texts that have none in 16 bits.

    The most frequent ones get the private codes, one each; should there be more than 6,399,
    the rest share one, as do all characters that the training texts do not have.
    """

    def run(batches):
        known: dict[str, int] = {}
        for batch in batches:
            for value in batch.column(0):
                for c in _RARE.findall(normal_form(value.as_py())):
                    known[c] = known.get(c, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([ord(c) for c in known], pa.int32()), pa.array(list(known.values()), pa.int64())], names=["code", "n"])

    ship(training.sparkSession)
    counts = training.filter(F.col(text).isNotNull()).select(text).mapInArrow(run, "code int, n long")
    counts = counts.groupBy("code").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "code").limit(_OTHER - _FIRST_RARE)
    return {r["code"]: _FIRST_RARE + i for i, r in enumerate(counts.collect())}


def _windows(codes: np.ndarray, order: int) -> np.ndarray:
    """Runs of ``order`` codes, each packed in one number, the last code lowest."""
    n = max(len(codes) - order + 1, 0)
    packed = codes[:n].copy()
    for k in range(1, order):
        packed = (packed << np.uint64(16)) | codes[k : k + n]
    return packed


def _tail(packed: np.ndarray, k: int) -> np.ndarray:
    """The last ``k`` codes of packed runs."""
    return packed & np.uint64((1 << 16 * k) - 1)


def _slot(packed: np.ndarray, bits: int) -> np.ndarray:
    """Where to look for packed runs in a table of 2 ** bits places; different runs may share one."""
    mixed = packed * _ODD
    mixed ^= mixed >> np.uint64(29)
    mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def _slices(text: str, order: int, rare: dict[int, int]):
    """Codes in runs of bounded length, each with ``order - 1`` codes of what went before."""
    text = normal_form(text)
    before = np.full(order - 1, _PAD, np.uint64)
    for at in range(0, len(text), SLICE):
        codes = np.concatenate([before, _codes(text[at : at + SLICE], rare)])
        before = codes[len(codes) - order + 1 :]
        yield codes


def count_ngrams(training: DataFrame, text: str, lang: str, order: int, rare: dict[int, int]) -> DataFrame:
    """``lang, gram, n``: how often each n-gram of the highest order stands in a language's texts.

    ``gram`` is the packed codes. Tasks count before the shuffle, so a language with a third of
    all texts sends one row for each task and n-gram.
    """

    def rows(waiting):
        for name, parts in waiting.items():
            grams, counts = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(counts, pa.int64())],
                names=["lang", "gram", "n"],
            )

    def run(batches):
        waiting, held = {}, 0
        for batch in batches:
            for value, name in zip(batch.column(0), batch.column(1), strict=True):
                for codes in _slices(value.as_py(), order, rare):
                    waiting.setdefault(name.as_py(), []).append(_windows(codes, order))
                    held += len(codes)
                if held > 8 * SLICE:
                    yield from rows(waiting)
                    waiting, held = {}, 0
        yield from rows(waiting)

    ship(training.sparkSession)
    narrow = training.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, lang)
    partial = narrow.mapInArrow(run, "lang string, gram long, n long")
    return partial.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass
class Models:
    """Sorted arrays of the packed n-grams of all languages.

    ``keys[k]`` holds the n-grams of order k + 1 in rising order; ``gains[k]`` and ``backs[k]``
    have a row for each key and a column for each language: log2 of the interpolated
    probability, and log2 of the weight that the next higher order gives to this one's gram
    as context. ``floor`` is log2 of the chance of an unknown character.
    """

    languages: list[str]
    order: int
    keys: list[np.ndarray]
    gains: list[np.ndarray]
    backs: list[np.ndarray]
    floor: float
    rare: dict[int, int]
    limits: np.ndarray | None = None  # for each language: mean and spread of its texts' cross-entropy
    _place: tuple | None = None  # finds n-grams of the highest order; made where it is used

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Sum of log2 probabilities of codes[order - 1:], one value a language."""
        left, total = _windows(codes, self.order), np.zeros(len(self.languages))
        for k in range(self.order, 0, -1):
            found, at = self._find(k, left if k == self.order else _tail(left, k))
            total += self.gains[k - 1].take(at[found], axis=0).sum(axis=0, dtype=np.float64)
            left = left[~found]
            if not len(left):
                break
            if k == 1:
                total += len(left) * self.floor
            else:  # the weight of the context that the unseen gram continues
                seen, at = self._find(k - 1, _tail(left, k) >> np.uint64(16))
                total += self.backs[k - 2].take(at[seen], axis=0).sum(axis=0, dtype=np.float64)
        return total

    def _find(self, k: int, packed: np.ndarray):
        """Which of the n-grams are keys of order k, and their places."""
        keys = self.keys[k - 1]
        if k < self.order:
            return _among(keys, packed)
        if self._place is None:
            bits = min(max(2 * len(keys), 2).bit_length(), 24)
            slots = _slot(keys, bits)
            by_slot = np.argsort(slots, kind="stable").astype(np.int32)
            starts = np.searchsorted(slots[by_slot], np.arange((1 << bits) + 1)).astype(np.int32)
            self._place = bits, by_slot, starts
        bits, by_slot, starts = self._place
        found, places = np.zeros(len(packed), bool), np.zeros(len(packed), np.int64)
        slots = _slot(packed, bits)
        at, end, open_ = starts[slots], starts[slots + 1], np.arange(len(packed))
        while len(open_ := open_[at[open_] < end[open_]]):
            place = by_slot[at[open_]]
            same = keys[place] == packed[open_]
            found[open_[same]], places[open_[same]] = True, place[same]
            open_ = open_[~same]
            at[open_] += 1
        return found, places

    def cross_entropies(self, text: str) -> tuple[np.ndarray, int]:
        """Bits a character of each language, and the number of characters."""
        total, n = np.zeros(len(self.languages)), 0
        for codes in _slices(text, self.order, self.rare):
            total -= self.log_probabilities(codes)
            n += len(codes) - self.order + 1
        return total / max(n, 1), n


def _among(keys: np.ndarray, packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the n-grams are among the sorted keys, and their places."""
    at = np.minimum(np.searchsorted(keys, packed), len(keys) - 1)
    return keys[at] == packed, at


@dataclass
class Tables:
    """Interpolated Kneser-Ney with one discount, as stored tables.

    ``orders[k]`` has ``lang, gram, gain, back`` for the n-grams and contexts of order k + 1 of
    each language: log2 of the interpolated probability (null for padding alone, which is the
    context of first characters but no n-gram), and log2 of the weight that the next order gives
    to the gram as context (null where it is none). ``spares`` is log2 of the chance, for each
    language, of a character that only other languages have.
    """

    languages: list[str]
    order: int
    alphabet: int
    spares: list[float]
    orders: list[DataFrame]
    folders: list[str]
    rare: dict[int, int]
    limits: np.ndarray | None = None  # as in Models

    def cells(self) -> int:
        """Size of the arrays that the tables would fill."""
        return sum(t.select("gram").distinct().count() for t in self.orders) * len(self.languages)


def kneser_ney(counts: DataFrame, order: int, rare: dict[int, int]) -> Tables:
    """Models from ``lang, gram, n``, order by order as tables.

    A task's largest group is the n-grams that continue a context or share a tail: at most one
    for each character. One row a language and one number come to the driver.
    """
    spark = counts.sparkSession
    held, folders = [], []

    def store(df: DataFrame, purpose: str, into: list[str]) -> DataFrame:
        df, folder = staged(spark, df, purpose)
        into.append(folder)
        return df

    own = {order: store(counts, "grams", held)}
    for k in range(order - 1, 0, -1):  # how many different characters stand before the gram
        tail = F.col("gram").bitwiseAND(F.lit((1 << 16 * k) - 1)).alias("gram")
        own[k] = store(own[k + 1].groupBy("lang", tail).agg(F.count(F.lit(1)).alias("n")), "grams", held)
    totals = own[1].groupBy("lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    alphabet = own[1].select("gram").distinct().count() + 1
    rows = sorted(totals.collect(), key=lambda r: r["lang"])
    # Order 1 is interpolated with equal chances for the alphabet.
    even = DISCOUNT * F.col("kinds") / F.col("total") / F.lit(alphabet)
    spares = [float(np.log2(DISCOUNT * r["kinds"] / r["total"] / alphabet)) for r in rows]
    p = F.greatest(F.col("n") - F.lit(DISCOUNT), F.lit(0.0)) / F.col("total")
    orders: list[DataFrame] = []
    for k in range(1, order + 1):
        if k == 1:
            known = own[1].join(F.broadcast(totals), "lang").select("lang", "gram", (p + even).alias("p"))
        else:
            last = orders[-1]
            context = last.filter("total IS NOT NULL").select("lang", F.col("gram").alias("context"), "total", "back")
            below = last.filter("gain IS NOT NULL").select("lang", F.col("gram").alias("tail"), "gain")
            cut = own[k].withColumn("context", F.shiftrightunsigned("gram", 16)).withColumn("tail", F.col("gram").bitwiseAND(F.lit((1 << 16 * (k - 1)) - 1)))
            known = cut.join(context, ["lang", "context"]).join(below, ["lang", "tail"])
            known = known.select("lang", "gram", (p + F.pow(F.lit(2.0), F.col("back") + F.col("gain"))).alias("p"))
        gain = F.log2(F.least(F.greatest("p", F.lit(1e-12)), F.lit(1.0))).alias("gain")
        if k < order:
            contexts = own[k + 1].groupBy("lang", F.shiftrightunsigned("gram", 16).alias("gram"))
            contexts = contexts.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
            back = F.log2(F.lit(DISCOUNT) * F.col("kinds") / F.col("total")).alias("back")
            table = known.join(contexts, ["lang", "gram"], "full").select("lang", "gram", gain, back, "total")
        else:
            table = known.select("lang", "gram", gain, F.lit(None).cast("double").alias("back"), F.lit(None).cast("long").alias("total"))
        orders.append(store(table, "models", folders))
    for folder in held:
        remove(spark, folder)
    return Tables([r["lang"] for r in rows], order, alphabet, spares, orders, folders, rare)


def _dense(tables: Tables) -> Models:
    """The tables as arrays. A language without a gram has its context's weight times the lower order's chance."""
    keys, gains, backs = [], [], []
    for k, stored in enumerate(tables.orders, 1):
        # One order at a time, with numbers in place of the languages' names.
        number = F.array_position(F.array(F.lit(""), *map(F.lit, tables.languages)), F.col("lang")).cast("int") - 2
        table = stored.select(number.alias("lang"), "gram", "gain", "back").toArrow().combine_chunks()
        lang = table.column("lang").to_numpy().astype(np.int64)
        gram = table.column("gram").to_numpy().view(np.uint64)
        own, at = np.unique(gram, return_inverse=True)
        if k == 1:
            gain = np.tile(np.float64(tables.spares), (len(own), 1))
        else:
            is_context, context = _among(keys[-1], own >> np.uint64(16))
            has_tail, tail = _among(keys[-1], _tail(own, k - 1))
            gain = np.where(is_context[:, None], backs[-1][context], 0) + np.where(has_tail[:, None], gains[-1][tail], 0)
        back = np.zeros_like(gain)
        for to, column in ((gain, "gain"), (back, "back")):
            values = table.column(column).to_numpy(zero_copy_only=False)
            there = ~np.isnan(values)
            to[at[there], lang[there]] = values[there]
        keys.append(own)
        gains.append(gain)
        backs.append(back)
    return Models(tables.languages, tables.order, keys, gains, backs, float(-np.log2(tables.alphabet)), tables.rare)


def _ngram_chances(grams: DataFrame, tables: Tables) -> DataFrame:
    """``gram, bits``: minus log2 of the probability in every language, for n-grams of the highest order.

    From single characters upward: an n-gram's own entry, or else its context's weight times the
    chance of its tail. Every key stands for at most one n-gram a character.
    """
    spark, order = grams.sparkSession, tables.order
    asked = {order: written(spark, grams.select("gram").distinct(), "asked")}
    for k in range(order - 1, 0, -1):
        tails = asked[k + 1].select(F.col("gram").bitwiseAND(F.lit((1 << 16 * k) - 1)).alias("gram")).distinct()
        asked[k] = written(spark, tails, "asked")

    def entries(k: int, column: str, key: str) -> DataFrame:
        rows = tables.orders[k - 1].filter(F.col(column).isNotNull())
        return rows.groupBy(F.col("gram").alias(key)).agg(F.map_from_entries(F.collect_list(F.struct("lang", column))).alias(column))

    names = list(enumerate(tables.languages))
    floor = F.lit(float(-np.log2(tables.alphabet)))
    chances = None
    for k in range(1, order + 1):
        rows = asked[k].join(entries(k, "gain", "gram"), "gram", "left")
        if k == 1:
            logs = [F.when(F.col("gain").isNull(), floor).otherwise(F.coalesce(F.col("gain")[name], F.lit(tables.spares[i]))) for i, name in names]
        else:
            rows = rows.withColumn("context", F.shiftrightunsigned("gram", 16)).withColumn("tail", F.col("gram").bitwiseAND(F.lit((1 << 16 * (k - 1)) - 1)))
            rows = rows.join(entries(k - 1, "back", "context"), "context", "left").join(chances.withColumnsRenamed({"gram": "tail", "logs": "below"}), "tail")
            logs = [F.coalesce(F.col("gain")[name], F.coalesce(F.col("back")[name], F.lit(0.0)) + F.col("below")[i]) for i, name in names]
        chances = written(spark, rows.select("gram", F.array(*logs).alias("logs")), "chances")
    return chances.select("gram", F.transform("logs", lambda x: -x).alias("bits"))


def _joined(df: DataFrame, tables: Tables, text: str) -> DataFrame:
    """Add ``_wl_bits``, bits a character of each language, and ``_wl_n``, the characters, by joins.

    Both are null for a text without characters.
    """
    spark, order, rare = df.sparkSession, tables.order, tables.rare
    numbered = written(spark, df.withColumn("_wl_row", F.monotonically_increasing_id()), "numbered")

    def count(batches):
        for batch in batches:
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for codes in _slices(value.as_py(), order, rare):
                    found, n = np.unique(_windows(codes, order), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([row] * len(found), pa.int64()), pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["_wl_at", "gram", "n"])

    ship(spark)
    texts = numbered.filter(F.col(f"`{text}`").isNotNull()).select("_wl_row", F.col(f"`{text}`"))
    grams = written(spark, texts.mapInArrow(count, "_wl_at long, gram long, n long"), "text-grams")
    chances = _ngram_chances(grams, tables)
    # A common n-gram stands in very many texts; its rows are spread.
    found = lookup(grams, chances, F.col("gram"), "gram", "gram", find_hot_keys(grams, {"gram": F.col("gram")}), ("_wl_at",))
    sums = [(F.sum(F.col("n") * F.col("bits")[i]) / F.sum("n")) for i in range(len(tables.languages))]
    sums = found.groupBy("_wl_at").agg(F.array(*sums).alias("_wl_bits"), F.sum("n").alias("_wl_n"))
    return numbered.join(sums, F.col("_wl_row") == F.col("_wl_at"), "left").drop("_wl_at", "_wl_row")


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def train(training: DataFrame, text: str = "text", lang: str = "lang", order: int = ORDER) -> Models | Tables:
    """Models of all languages named in ``training``, learned from every text with a language.

    Arrays up to ``MOST_CELLS``; larger models stay in their tables.

    Calibration of the rejection reads every text again. Rows without text or language teach
    nothing; without any row there are no languages, and every text is undetermined.
    """
    known = training.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    rare = rare_characters(known, "text")
    tables = kneser_ney(count_ngrams(known, "text", "lang", order, rare), order, rare)
    models: Models | Tables = tables
    if tables.cells() <= MOST_CELLS:
        models = _dense(tables)
        for folder in tables.folders:
            remove(training.sparkSession, folder)
    models.limits = _calibrated(known, models)
    return models


def _with_bits(df: DataFrame, models: Models | Tables, text: str, fields: list[T.StructField], judge: Callable) -> DataFrame:
    """Append ``fields``: what ``judge`` makes of a text, its bits a character of each language and its length.

    ``judge`` gets a function for the last two, so that they are made only where they are read.
    """
    if isinstance(models, Tables):
        df = _joined(df, models, text)

        def scorer():
            def one(value, bits, n):
                return judge(value, lambda: (np.array(bits), n))

            return lambda *columns: list(zip(*map(one, *columns), strict=True)) or [[]] * len(fields)

        return scored(df, [text, "_wl_bits", "_wl_n"], fields, scorer).drop("_wl_bits", "_wl_n")
    shared = df.sparkSession.sparkContext.broadcast(models)

    def scorer():
        m = shared.value
        return lambda texts: list(zip(*(judge(t, lambda t=t: m.cross_entropies(t)) for t in texts), strict=True)) or [[]] * len(fields)

    return scored(df, text, fields, scorer)


def _calibrated(known: DataFrame, models: Models | Tables) -> np.ndarray:
    """Mean and spread of each language's cross-entropy over all its own texts that have a letter.

    Tasks average before the shuffle, so a language sends one row for each task.
    """
    limits = np.tile([0.0, np.inf], (len(models.languages), 1))
    if not models.languages:
        return limits

    def judge(value, measure):
        return (measure()[0].tolist() if has_letter(value) else None,)

    measured = _with_bits(known, models, "text", [T.StructField("bits", T.ArrayType(T.DoubleType()))], judge)
    own = F.element_at("bits", F.array_position(F.array(*map(F.lit, models.languages)), F.col("lang")).cast("int"))
    stats = measured.filter("bits IS NOT NULL").groupBy("lang").agg(F.avg(own).alias("mean"), F.stddev_pop(own).alias("spread"))
    for r in stats.collect():
        limits[models.languages.index(r["lang"])] = r["mean"], r["spread"]
    return limits


@dataclass(frozen=True)
class Rejection:
    """How far above its language's mean a text's cross-entropy may lie.

    ``spreads`` times the spread between the language's texts, at least ``least`` bits, and
    ``room`` bits divided by the root of the number of characters.
    """

    spreads: float = 6.0
    least: float = 1.0
    room: float = 12.0


def identify(df: DataFrame, models: Models | Tables, text: str = "text", rejection: Rejection = Rejection()) -> DataFrame:
    """Add ``lang_pred``, ``lang_score``, ``cross_entropy`` and ``lang_rejected``.

    ``lang_pred`` is the language of lowest cross-entropy, ``und`` if the text is null or has
    no letter or no language was learned. ``lang_score`` (0 to 1) is that language's share of
    the chances, at the evidence of at most 50 characters; 0 for ``und``. ``lang_rejected`` is
    true for ``und`` and for a cross-entropy above the calibrated limit. Equal languages: the
    first by name. Texts are scored whole, in slices of bounded length. Rows are independent;
    repeated rows and an empty table come out as they went in. Columns of these names are
    replaced.
    """
    fields = [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("lang_score", T.DoubleType()),
        T.StructField("cross_entropy", T.DoubleType()),
        T.StructField("lang_rejected", T.BooleanType()),
    ]

    languages, limits = models.languages, models.limits

    def judge(value, measure):
        if not languages or not has_letter(value):
            return UNDETERMINED, 0.0, None, True
        bits, n = measure()
        best = int(np.argmin(bits))
        share = 1 / np.exp2(-(bits - bits[best]) * min(n, 50)).sum()
        mean, spread = limits[best]
        limit = mean + max(rejection.spreads * spread, rejection.least) + rejection.room / np.sqrt(n)
        return languages[best], float(share), float(bits[best]), bool(bits[best] > limit)

    return _with_bits(df, models, text, fields, judge)
