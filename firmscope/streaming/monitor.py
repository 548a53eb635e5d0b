"""Watching a folder for new evidence: only content that hasn't been seen goes on, in runs that take what is there."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def new_evidence(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], ts: str, delay: str = "1 day") -> DataFrame:
    """Rows of files as they come, one for each key within the delay."""
    rows = spark.readStream.schema(schema).parquet(path).withColumn(ts, F.col(ts).cast("timestamp"))
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def hourly_counts(stream: DataFrame, ts: str, by: str) -> DataFrame:
    return stream.groupBy(F.window(ts, "1 hour").alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("hour"), by, "n")


def run_available(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Takes all that has come since the last run and stops."""
    return df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def sustained_alerts(stream: DataFrame, series: str, ts: str, breach: Column, seconds: int, delay: str = "1 minute") -> DataFrame:
    """series, since, fired_at of a stream of samples: as logs.sustained(), each alert once, as soon as it is due.

    Samples that come in order, or late by less than `delay` within what a run takes up, are put in order; the state of a
    series is when its condition began and whether its alert has gone out.
    """
    kind = stream.schema[series].dataType.simpleString()
    rows = stream.withWatermark(ts, delay).select(F.col(series).alias("series"), F.col(ts).alias("ts"), F.coalesce(breach, F.lit(False)).alias("on"))

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        since, fired = state.get if state.exists else (-1, False)
        samples = pd.concat(list(batches)).groupby("ts")["on"].all().sort_index()  # of one series in one run
        out = []
        for at, on in zip((samples.index.astype("int64") // {"ns": 1000, "us": 1}[samples.index.unit]).tolist(), samples.tolist(), strict=True):
            if not on:
                since, fired = -1, False
            else:
                since = at if since < 0 else since
                if not fired and at >= since + seconds * 1_000_000:
                    fired = True
                    out.append((key[0], since, at))
        state.update((since, fired))
        yield pd.DataFrame(out, columns=["series", "since", "fired_at"])

    found = rows.groupBy("series").applyInPandasWithState(run, f"series {kind}, since long, fired_at long", "since long, fired boolean", "append", GroupStateTimeout.NoTimeout)
    return found.select(F.col("series").alias(series), F.timestamp_micros("since").alias("since"), F.timestamp_micros("fired_at").alias("fired_at"))
