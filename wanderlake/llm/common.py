"""Helpers shared by the operators of this folder.

Operators add columns to whatever frame they get. Names that they need for themselves start
with ``_wl_``, so columns of the input never clash with them, and the input's columns pass
through unchanged unless an operator says otherwise.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wanderlake.session import scratch_dir

FOLDS = 5

_PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()

Scorer = Callable[..., list[Iterable]]


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of all executors, once for each application.

    The archive goes through the shared folder, so a worker on any machine finds it.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(_PACKAGE.rglob("*.py")):
            archive.write(file, str(file.relative_to(_PACKAGE.parent)))
    path = f"{scratch_dir(spark, 'package')}/{_PACKAGE.name}_workers.zip"
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
    out.write(packed.getvalue())
    out.close()
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def is_held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the fifth of all documents that no model is fitted on.

    The remainder of crc32(doc_id as text) by five; a null id counts as the text "".
    """
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    as_text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % FOLDS == 0


def scored(df: DataFrame, inputs: str | list[str], fields: list[T.StructField], scorer: Callable[[], Scorer]) -> DataFrame:
    """Append ``fields``, computed from the input columns batch by batch.

    ``scorer()`` is called once in each task and returns a function from one list of values for
    each input column to one list of values for each field. Every row goes through in one
    pass, without a shuffle. Columns with the fields' names are replaced.
    """
    ship(df.sparkSession)
    inputs = [inputs] if isinstance(inputs, str) else inputs
    kept = [c for c in df.columns if c not in {f.name for f in fields} or c in inputs]
    if set(kept) & {f.name for f in fields}:
        raise ValueError("an input column has the name of an added one; rename it first")
    df = df.select(*(F.col(f"`{c}`") for c in kept))
    schema = T.StructType(df.schema.fields + fields)
    places, names, types = [kept.index(c) for c in inputs], schema.names, [_arrow_type(f.dataType) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer()
        for batch in batches:
            for part in _pieces(batch):
                values = score(*(part.column(i).to_pylist() for i in places))
                added = [v if isinstance(v, pa.Array) else pa.array(v, t) for v, t in zip(values, types, strict=True)]
                yield pa.RecordBatch.from_arrays(part.columns + added, names=names)

    return df.mapInArrow(run, schema)


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _pieces(batch: pa.RecordBatch, rows: int = 1000, size: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """Smaller batches, in rows and in bytes, so that the Python objects of one of them stay small."""
    if batch.num_rows > rows or (batch.num_rows > 1 and batch.nbytes > size):
        half = batch.num_rows // 2
        yield from _pieces(batch.slice(0, half), rows, size)
        yield from _pieces(batch.slice(half), rows, size)
    elif batch.num_rows:
        yield batch


def staged(spark: SparkSession, df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """The frame as stored in the cluster's shared folder, and its folder there.

    Computed once, and read by all that follow. Unlike a cache it outlives executors, and the
    plan after it starts from files. Whoever knows the last reader removes the folder.
    """
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """``staged`` for what a lazy result still reads; the folder stays."""
    return staged(spark, df, purpose)[0]


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z in lower case, as UTF-8."""
    return text.encode("utf-8").lower().split() if text else []
