"""Tables published by version: written aside, then a pointer is swapped, so that readers see one whole version or another."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmscope.sources.writers import content_hash

POINTER = "latest.json"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at, jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), spark.sparkContext._jsc.hadoopConfiguration())


def _swap(spark: SparkSession, root: str, pointer: dict) -> None:
    """Writes the pointer beside its place and renames it over the old one, which the file system does in one step."""
    aside = f"{root}/.{POINTER}-{uuid.uuid4().hex}"
    jvm, at, files = _fs(spark, aside)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at, True)
    out.write(json.dumps(pointer, sort_keys=True).encode())
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(at, jvm.org.apache.hadoop.fs.Path(f"{root}/{POINTER}"), options)


def pointer(spark: SparkSession, root: str) -> dict | None:
    """What is published now: version, path, sha256, rows, updated_at; None before the first."""
    _, at, files = _fs(spark, f"{root}/{POINTER}")
    if not files.util().exists(at):
        return None
    return json.loads("".join(r["value"] for r in spark.read.text(f"{root}/{POINTER}", wholetext=True).collect()))


def publish(df: DataFrame, root: str, updated_at: str) -> dict:
    """Writes df as a new version and makes it the published one; returns the pointer.

    Equal content isn't written again, only its time is new. What a write that died has left is never pointed at, and a
    reader that took the pointer before goes on reading the version that it names.
    """
    spark, key = df.sparkSession, content_hash(df)
    now = pointer(spark, root)
    if now and now["sha256"] == key:
        done = {**now, "updated_at": updated_at}
    else:
        path = f"{root}/v-{key[:16]}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        done = {"version": (now or {"version": 0})["version"] + 1, "path": path, "sha256": key, "rows": spark.read.parquet(path).count(), "updated_at": updated_at}
    _swap(spark, root, done)
    return done


def published(spark: SparkSession, root: str) -> DataFrame:
    """The published version, pinned: later versions don't change what this reads."""
    now = pointer(spark, root)
    if now is None:
        raise FileNotFoundError(f"nothing is published under {root}")
    return spark.read.parquet(now["path"])


def list_statistics(entities: DataFrame, lists: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """list_id, name, entities, individuals, updated_at, needs_update of every list; one never loaded or `hours` or more old needs an update."""
    n = entities.groupBy("list_id").agg(F.count("*").alias("entities"), F.count(F.when(F.col("entity_type") == "individual", 1)).alias("individuals"))
    old = F.col("updated_at").isNull() | (as_of.cast("timestamp") >= F.col("updated_at").cast("timestamp") + F.make_dt_interval(hours=F.lit(hours)))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return lists.join(n, "list_id", "left").select("list_id", "name", zero("entities"), zero("individuals"), "updated_at", old.alias("needs_update"))
