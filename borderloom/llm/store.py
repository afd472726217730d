"""Intermediate tables in the folder that driver and executors share.

The folder is the one the cluster names in ``spark.checkpoint.dir``; a session on
one machine without any (tests, a laptop) gets a temporary one, on a cluster that is
an error.  Tables that nothing deletes before go when the session ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from borderloom.sources.staging import shared_folder


def shared_dir(spark: SparkSession) -> str:
    return shared_folder(spark)


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Have Spark hand rows to Python in batches of at most so many rows and bytes: texts are long, and a batch is held by the JVM and by Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: a cut of the lineage that outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _files(spark, path)[0].deleteOnExit(_files(spark, path)[1])
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a staged table that nothing will read again."""
    path = getattr(df, "_staged_at", None)
    if path:
        files, at = _files(df.sparkSession, path)
        files.delete(at, True)


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores before it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def named(df: DataFrame, name: str) -> str:
    """The column of ``df`` that ``name`` means, as it is spelt there."""
    return next((c for c in df.columns if c == name), None) or next(c for c in df.columns if c.lower() == name.lower())
