"""Cuts of the lineage for iterative plans, in the checkpoint folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a session on one machine without any (tests, a laptop) gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = held.get() if held.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="borderloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the session's checkpoint folder, without the estimate of its size.

    A checkpoint keeps the estimate of the plan that it ends, and a join multiplies
    those of its sides: over the rounds of a loop they were numbers of millions of
    digits, which took the driver's time and memory.  Real sizes decide at run time.
    """
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    held = df.checkpoint(eager=True)._jdf
    return DataFrame(df.sparkSession._jsparkSession.internalCreateDataFrame(held.queryExecution().logical().rdd(), held.schema(), False), df.sparkSession)
