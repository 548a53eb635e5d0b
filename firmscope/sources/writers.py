"""Sinks: whole tables or partitions at once, and content-addressed snapshots."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace_partitions(df: DataFrame, path: str, by: str) -> None:
    """Only partitions that occur in df are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def retained(df: DataFrame, ts: str, as_of: str, days: int) -> DataFrame:
    return df.filter(F.col(ts) >= F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days)))


def content_hash(df: DataFrame) -> str:
    """A hash of all rows that does not depend on their order: sums of row hashes, added in Spark."""
    h = df.select(F.sha2(F.to_json(F.struct(*sorted(df.columns))), 256).alias("h"))
    sums = [F.sum(F.conv(F.substring("h", 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)")).alias(f"p{i}") for i in range(5)]
    return hashlib.sha256(str(tuple(h.agg(F.count("*").alias("n"), *sums).first())).encode()).hexdigest()


def _complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder was finished: it has the mark of Spark's committer."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def snapshot(df: DataFrame, folder: str, version: str) -> str:
    """Writes df under its content's hash with a manifest row beside it; returns the path.

    Equal content is written once; what a failed write has left there is written anew.
    """
    key = content_hash(df)
    path = f"{folder}/{key[:16]}"
    if not _complete(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)
    row = df.sparkSession.createDataFrame([(key, path, version)], "sha256 string, path string, version string")
    row.coalesce(1).write.mode("overwrite").json(f"{folder}/latest.json")
    return path


def single_active(versions: DataFrame, key: str, active: str) -> DataFrame:
    """versions with is_active true for one version and false for all others."""
    return versions.withColumn("is_active", F.coalesce(F.col(key) == active, F.lit(False)))


def updated(df: DataFrame, where: Column, values: dict[str, object]) -> DataFrame:
    """df with these columns set in the rows where the condition holds."""
    hit = F.coalesce(where, F.lit(False))
    return df.withColumns({c: F.when(hit, F.lit(v)).otherwise(F.col(c)) for c, v in values.items()})


def next_id(df: DataFrame, id_col: str) -> int:
    return (df.agg(F.max(id_col)).first()[0] or 0) + 1
