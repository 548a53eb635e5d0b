"""Tables that a job writes for its own later steps, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's spark.checkpoint.dir. Where it is unset a temporary folder serves in local mode; elsewhere that is an error."""
    sc = spark.sparkContext
    at = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if at is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="firmscope-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(at)
    return at


def shuffled(df: DataFrame) -> DataFrame:
    """df for a join that both sides are shuffled for.

    Spark's estimates take an exploded list for one row and a made-up name for the number that it is made of, so that it
    would send tables of any size through the driver.
    """
    return df.hint("merge")


def kept(df: DataFrame) -> DataFrame:
    """df, worked out once and written to the shared folder: later steps read it there, also after an executor is lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
