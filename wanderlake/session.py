"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Applied by build_session; a cluster's own spark-defaults win for anything not listed here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session for the jobs; keyword names use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    Every executor must see what another one wrote there, so a machine-local folder is
    used only when the master itself is local and nothing was configured.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="wanderlake-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package made, such as staging that is no longer read."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    return [name for name, _ in listing(spark, path)]


def listing(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Names in a folder and when each was last changed, in seconds; none if it does not exist."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(context._jsc.hadoopConfiguration())
    found = files.listStatus(target) if files.exists(target) else []
    return [(status.getPath().getName(), status.getModificationTime() / 1000) for status in found]


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A small file of any store that Spark reads."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(context._jsc.hadoopConfiguration()).open(target)
    try:
        return bytes(context._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def create_file(spark: SparkSession, path: str, content: bytes) -> bool:
    """Write a small file unless there is one of that name; False says that there was.

    It is written under another name first, so it appears whole. The renaming fails where the
    name is taken; HDFS does both in one step.
    """
    context = spark.sparkContext
    jvm, conf = context._jvm, context._jsc.hadoopConfiguration()
    folder, _, name = path.rpartition("/")
    waiting, target = (jvm.org.apache.hadoop.fs.Path(f"{folder}/{n}") for n in (f"_{name}-{uuid.uuid4().hex}", name))
    files = target.getFileSystem(conf)
    out = files.create(waiting)
    try:
        out.write(content)
    finally:
        out.close()
    options = context._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    store = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
    try:
        store.rename(files.makeQualified(waiting), files.makeQualified(target), options)
    except Py4JJavaError as error:
        files.delete(waiting, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName() or files.exists(target):
            return False
        raise
    return True
