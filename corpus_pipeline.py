"""From raw documents to token ids: language, toxicity, near copies, mix, tokens.

Every stage takes the documents that the one before kept and, but for the last, returns them
with the columns they came with.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake.llm import bpe, langid, mixing, near_dedup, toxicity
from wanderlake.llm.common import is_held_out, staged
from wanderlake.llm.queries import VOCABULARY
from wanderlake.session import remove

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


KEPT = ("doc_id", "text", "lang", "source")  # what stages read; their own columns have other names


def packed(docs: DataFrame) -> DataFrame:
    """All other columns of the documents as one, so that none has the name of a column that a stage adds."""
    rest = [F.col(f"`{c}`").alias(c) for c in docs.columns if c not in KEPT]
    return docs.select(*(c for c in KEPT if c in docs.columns), *([F.struct(*rest).alias("_wl_rest")] if rest else []))


def unpacked(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.select(*(F.col(c) if c in KEPT else F.col("_wl_rest")[c].alias(c) for c in columns))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language model rejects them; models learn from these documents."""
    named = langid.identify(packed(docs), langid.train(docs.filter(~is_held_out())))
    return unpacked(named.filter(~F.col("lang_rejected")), docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are more likely toxic than not, by the labels of the folder."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return unpacked(toxicity.score(packed(docs), model).filter(F.col("toxic_score") < 0.5), docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: the one of smallest id, once.

    A document is known by its id and a hash of its text, so two texts under one id are two
    documents, and stay unless they are near copies of others. Repeated rows are one document.
    Rows without an id are linked with nothing and all stay.
    """
    # Ids in the order of whole numbers, as bytes; the sign bit is turned so that negative ones come first.
    order = F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(2**63)).cast("long"))), 16, "0")
    keyed = docs.withColumn("_wl_key", F.unhex(F.concat(order, F.lpad(F.hex(F.xxhash64("text")), 16, "0"))))
    groups = near_dedup.near_duplicates(keyed, doc_id="_wl_key")
    kept = groups.filter("kept").select(F.col("doc_id").alias("_wl_key")).filter("_wl_key IS NOT NULL").distinct()
    chosen = keyed.join(kept, "_wl_key", "left_semi").dropDuplicates(["_wl_key"])
    return chosen.unionByName(keyed.filter("_wl_key IS NULL")).select(*(F.col(f"`{c}`") for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as it is taken."""
    rows = packed(docs)
    return unpacked(mixing.repeated(mixing.mix(rows, mixing.word_count("text")), rows.columns), docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, and whether they decode to its text."""
    coded = bpe.encode_decode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, ids_as_array=True)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return coded.select("doc_id", "source", "n_tokens", "token_ids", same.alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("mix", mix_sources),
    ("tokens", tokenize),
]

#: Models, seeded choices and byte-pair merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each one's rows are stored and read again.

    What a stage read is removed once its own rows are stored.
    """
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        before = folder
        docs, folder = staged(spark, stage(spark, docs, sf_dir), name)
        if before:
            remove(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
