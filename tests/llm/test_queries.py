from __future__ import annotations

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import prose
from tools.compare import digest
from wanderlake.llm.oracle import ORACLE
from wanderlake.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM read_parquet('{table}')")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    result = db.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(names, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op3_nearest", "op11_centroids", "op12_collocations"}))
def test_a_row_for_each_row_of_the_table(spark, name):
    table = "pages" if name in ("op7_urls", "op10_warc") else "documents"
    out, key = QUERIES[name](spark, FOLDER), "page_id" if table == "pages" else "doc_id"
    given = spark.read.parquet(f"{FOLDER}/{table}.parquet")
    assert out.select(key).exceptAll(given.select(key)).count() == 0 and out.count() == given.count()


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == columns
        counts.append(docs.count())
    language, toxic, near = counts[1:4]
    assert counts[0] >= language > toxic > near > 0.7 * counts[0]
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert tokens.count() == counts[4] and tokens.filter("NOT round_trip").count() == 0
    assert tokens.filter("n_tokens <> size(token_ids)").count() == 0


def test_stages_on_edges(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", None, None, 0), (1, None, "en", None, 0)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0, name
        assert stage(spark, odd, FOLDER).count() <= 3, name


def test_clashing_and_dotted_columns_pass_through(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = ("size", "copies", "cross_entropy", "toxic_score", "lang_pred", "row", "gram", "a.b", "kept", "_wl_size2")
    clashing = docs.select("*", *(F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in odd))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, FOLDER)
        assert out.columns == clashing.columns, name
        rows = out.select("doc_id", *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(odd))).collect()
        assert rows and all(r[f"c{i}"] == f"{c}:{r['doc_id']}" for r in rows for i, c in enumerate(odd)), name


def test_two_texts_under_one_id_are_two_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = [prose(i, 80) for i in range(4)]
    rows = [(8, texts[0], "en", "a", 1), (8, texts[1], "en", "a", 1), (3, texts[1] + " end", "en", "a", 1), (8, texts[0], "en", "a", 1)]
    rows += [(-4, texts[2], "en", "a", 1), (9, texts[2], "en", "a", 1), (None, texts[2], "en", "a", 1), (None, texts[2], "en", "a", 1), (12, None, "en", "a", 0), (12, "", "en", "a", 0)]
    out = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, docs.schema), FOLDER)
    kept = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert kept == sorted([(8, texts[0]), (3, texts[1] + " end"), (-4, texts[2]), (None, texts[2]), (None, texts[2]), (12, None), (12, "")], key=str)


def test_run(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "source", "n_tokens", "token_ids", "round_trip"] and out.count() > 0
