"""One query for each operator over the given tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wanderlake.llm import ann, bpe, centroids, collocations, langid, mixing, near_dedup, pii, quality, sharding, toxicity, url_filter, warc
from wanderlake.llm.common import is_held_out
from wanderlake.session import scratch_dir

SHARDS = 24
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(docs, settings=near_dedup.Settings(shingle=3, percent=85))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_decode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"), mixing.word_count("text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    models = langid.train(docs.filter(~is_held_out()))
    named = langid.identify(docs.select("doc_id", "text"), models)
    return named.select("doc_id", is_held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "cross_entropy", "lang_rejected")


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old layout has a shard for each hash of the text; its bytes are levelled over as many shards."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    old = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(SHARDS))
    layout = sharding.lay_out(docs, old, scratch_dir(spark, "shards"), SHARDS)
    plan = sharding.plan_transfers(layout, SHARDS)
    sharding.rewrite(spark, layout, plan)
    return sharding.read_shards(spark, layout, plan).select(
        "doc_id",
        sharding.text_bytes().alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("_wl_shard").alias("shard"),
        F.col("_wl_slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "strict_terms", "soft_terms", "soft_weight")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.assess(docs, quality.references(docs)).drop("text", "lang")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    marked = toxicity.score(docs, model)
    return marked.select(
        "doc_id",
        is_held_out().alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= 0.5).cast("int").alias("predicted"),
        F.size("toxic_spans").alias("n_offending"),
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    files = warc.write_archives(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    return warc.read_archives(spark, files, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents").select("lang", "text"))


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    field = pii.train(pii.labelled_examples())
    found = pii.find_personal_data(_table(spark, sf_dir, "documents").select("doc_id", "text"), field)

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("pii_spans", lambda s: s["base"])
    def number(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = map(number, pii.KINDS)
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("pii_spans")).alias("spans"))


QUERIES = {q.__name__: q for q in (op1_near_dedup, op2_bpe, op3_nearest, op4_mix, op5_language, op6_shards, op7_urls, op8_quality, op9_toxicity, op10_warc, op11_centroids, op12_collocations, op13_pii)}
