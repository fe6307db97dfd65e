"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: the only separators of words in this subpackage.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


#: Bytes of an Arrow batch: what a task holds of long texts at once, in the executor and in its Python worker.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Let Spark hand rows to Python in batches of BATCH_BYTES at most, instead
    of 10,000 rows of any length; a smaller setting of the session stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(str(spark.conf.get(name)).rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(name, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """The text, a null as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, LOWER)


def scratch(spark: SparkSession) -> str:
    """A new place in the shared folder of the cluster (spark.checkpoint.dir).
    Where that is unset, as in tests on one machine, a temporary folder; a
    cluster has no such folder that all its machines see, so it must be set there."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="touchline-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/touchline-{uuid.uuid4().hex}"


def stash(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and reread it.

    Row numbers must be written with the rows: how files are split among tasks
    when they are read depends on how many cores there are at that time.

    Cuts the lineage: a lost executor costs a reread, not a recomputation, and
    several readers of the result compute it once.  Whoever owns the shared
    folder clears it when the job is done; what is read no more within an
    operator goes by ``release``.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` for a join that is to be a shuffle, never a broadcast of Spark's own.

    Spark sizes what explode or a Python operator yields by the rows that go in,
    however many come out of each, so it would broadcast any number of them.
    """
    return df.hint("merge")


def release(stashed: DataFrame) -> None:
    """Delete a ``stash`` that nothing reads any more."""
    spark = stashed.sparkSession
    files = stashed.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def worker_cache() -> dict:
    """A dictionary that lives as long as the Python worker does, so that what
    is loaded or memoised in one task serves the next one."""
    return sys.__dict__.setdefault("_touchline_cache", {})
