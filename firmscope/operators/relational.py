"""Relational operators that the engine's queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that are worked out once a row, however often later steps use them.

    Spark folds a projection into the next one, so that an expression used ten times is evaluated, and planned, ten
    times. A generator in between, of one row each, keeps it from that; it costs no shuffle.
    """
    made = F.explode_outer(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))).alias("__once")
    return df.select("*", made).select(*(c for c in df.columns if c not in columns), "__once.*")


def latest_by(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key by the order columns. The rank is cut before the shuffle, so a common key sends few rows."""
    w = Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order))
    return df.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def top_per_group(df: DataFrame, keys: list[str], k: int, *order: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def percentile_best0(df: DataFrame, value: str, keys: list[str], out: str) -> DataFrame:
    """Percentile of each value in its group, 0 the best; ties take the larger rank, a single row 50, halves go to even.

    Ranks come from counts of distinct values, in ranges of them, so that a large group is many tasks (running_counts).
    Rows whose keys or value are null have no rank and are left out.
    """
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("__c")).filter(F.col(value).isNotNull())
    ranks = running_counts(counts, value, "__c", keys).select(*keys, value, F.col("upto").alias("__r"), F.col("total").alias("__n"))
    p = F.when(F.col("__n") == 1, F.lit(50)).otherwise(F.bround((1 - (F.col("__r") - 1) / F.nullif(F.col("__n") - 1, F.lit(0))) * 100, 0)).cast("long")
    return df.join(ranks.withColumn(out, p).drop("__r", "__n"), [*keys, value])


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep_old: bool = False) -> DataFrame:
    """All keys of either side. A new value replaces the old one unless it is null; with keep_old only gaps are filled."""
    a, b = old.alias("a"), new.alias("b")
    first, second = ("a", "b") if keep_old else ("b", "a")
    cols = [c for c in old.columns if c not in keys]
    return a.join(b, keys, "full_outer").select(*keys, *(F.coalesce(F.col(f"{first}.{c}"), F.col(f"{second}.{c}")).alias(c) for c in cols))


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """old and, for each key that it lacks, the first new row."""
    w = Window.partitionBy(*keys).orderBy(*order)
    first = new.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")
    return old.unionByName(first.join(old, keys, "left_anti"))


def broken_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with the names of the rules in `broken`."""
    names = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules.items())))
    return df.withColumn("broken", names).filter(F.size("broken") > 0)


def streaks(df: DataFrame, key: str, order: list[str], failed: Column) -> DataFrame:
    """df with `streak`: failures in a row up to and with this row."""
    w = Window.partitionBy(key).orderBy(*order)
    d = df.withColumn("__f", F.when(failed, 1).otherwise(0)).withColumn("__i", F.sum(F.when(failed, 0).otherwise(1)).over(w))
    return d.withColumn("streak", F.sum("__f").over(Window.partitionBy(key, "__i").orderBy(*order))).drop("__f", "__i")


def sample_skewness(c: str) -> Column:
    n = F.count(c)
    return F.when((n < 3) | (F.stddev_pop(c) == 0), 0.0).otherwise(F.skewness(c) * F.sqrt((n * (n - 1)).cast("double")) / (n - 2))


def running_counts(counts: DataFrame, value: str, count: str, keys: list[str] | None = None, parts: int = 256) -> DataFrame:
    """counts (distinct values, of each key, and how often each occurs) with `upto`, the sum of counts up to a value, and `total`.

    Values are parted into up to `parts` ranges of about equal size, by quantiles: sums are taken within ranges, and
    over the ranges' totals, of which a key has no more than `parts`. No task sees all values, nor all of a key.
    """
    keys = keys or []
    cuts = sorted(set(counts.approxQuantile(value, [i / parts for i in range(1, parts)], 1 / (2 * parts))))
    part = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x < F.col(value))) if cuts else F.lit(0)
    ranged = counts.withColumn("__g", part)
    totals = ranged.groupBy(*keys, "__g").agg(F.sum(count).alias("__t"))
    own = Window.partitionBy(*keys)
    before = totals.select(*keys, "__g", (F.sum("__t").over(own.orderBy("__g")) - F.col("__t")).alias("__b"), F.sum("__t").over(own).alias("total"))
    inside = F.sum(count).over(Window.partitionBy(*keys, "__g").orderBy(value))
    return ranged.withColumn("__i", inside).join(before if keys else F.broadcast(before), [*keys, "__g"]).withColumn("upto", F.col("__i") + F.col("__b")).drop("__g", "__i", "__b")


def nth_smallest(df: DataFrame, value: str, position: Column) -> DataFrame:
    """One row: the value at a place (from 0) of the ascending order, by running counts of distinct values; `n` is the number of rows."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("c"))
    run = running_counts(counts, value, "c").withColumnRenamed("total", "n")
    return run.filter(F.col("upto") > position).agg(F.min(value).alias(value))
