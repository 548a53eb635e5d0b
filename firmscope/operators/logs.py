"""Folds over logs in order: rolling quantiles, cache replay, counters' rates, quantiles of histograms, and alerts that must hold."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 20_000


def placed(rows: DataFrame, key: str, ts: Column, order: list[str], span: int) -> DataFrame:
    """rows with __pos, their place (from 0) in their key by ts and the order columns, which must tell rows apart.

    A key's rows are ranked within spans of `span` seconds, and the counts of the spans before are added, so no task ranks
    all rows of a common key.
    """
    d = rows.withColumn("__ts", ts).withColumn("__span", F.floor(F.unix_micros("__ts") / (span * 1_000_000)))
    counts = d.groupBy(key, "__span").agg(F.count("*").alias("__n"))
    before = counts.select(F.col(key).alias("__k"), F.col("__span").alias("__s"), (F.sum("__n").over(Window.partitionBy(key).orderBy("__span")) - F.col("__n")).alias("__b"))
    local = F.row_number().over(Window.partitionBy(key, "__span").orderBy("__ts", *order)) - 1
    joined = d.withColumn("__l", local).join(before, F.col(key).eqNullSafe(F.col("__k")) & F.col("__span").eqNullSafe(F.col("__s")))
    return joined.withColumn("__pos", F.col("__b") + F.col("__l")).drop("__k", "__s", "__b", "__l", "__span")


def rolling_nth(rows: DataFrame, key: str, id_col: str, value: str, ts: Column, last: int = 1000, share: float = 0.95, span: int = 3600, block: int = BLOCK) -> DataFrame:
    """key, id_col, n and nth: of each row's last `last` values (its own included) the one at place floor(n * share) of the ascending order.

    A key's rows are cut into blocks, each with the last values of the one before, so a common key is many tasks; a task
    holds `last` values in order. Rows without a value are left out; ids must be unique in a key.
    """
    d = placed(rows.filter(F.col(value).isNotNull()).select(F.col(key).alias("k"), F.col(id_col).alias("id"), F.col(value).cast("double").alias("v"), ts.alias("t")), "k", F.col("t"), ["id"], span)
    b = F.floor(F.col("__pos") / block)
    # the last rows of a block lead the next ones
    to = F.sequence(b, F.floor((F.col("__pos") + last - 1) / block))
    dealt = d.select("k", "id", "v", "__pos", b.alias("own"), F.explode(to).alias("b"))

    def fold(keys: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("__pos")
        queue: deque[float] = deque()
        ordered: list[float] = []
        out = []
        for i, v, own in zip(part["id"], part["v"], part["own"] == keys[1], strict=True):
            queue.append(v)
            insort(ordered, v)
            if len(queue) > last:
                del ordered[bisect_left(ordered, queue.popleft())]
            if own:
                out.append((keys[0], i, len(queue), ordered[min(int(len(queue) * share), len(queue) - 1)]))
        return pd.DataFrame(out, columns=["k", "id", "n", "nth"])

    kind = lambda c: rows.schema[c].dataType.simpleString()
    return dealt.groupBy("k", "b").applyInPandas(fold, f"k {kind(key)}, id {kind(id_col)}, n long, nth double").withColumnsRenamed({"k": key, "id": id_col})


def cache_replay(requests: DataFrame, key: str, id_col: str, ts: Column, ttl: int) -> DataFrame:
    """key, id_col and hit of each request for a key, in order of ts and id: a miss stores the value for `ttl` seconds, and a request within them is a hit.

    A request depends on the one before, so one task reads a key's requests; it streams them and holds one time.
    """
    d = requests.select(F.col(key).alias("k"), F.col(id_col).alias("id"), F.unix_micros(ts).alias("t")).filter("t IS NOT NULL")
    sorted_ = d.repartition("k").sortWithinPartitions("k", "t", "id")

    def replay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, until = object(), 0
        for b in batches:
            hits = []
            for k, t in zip(b["k"], b["t"], strict=True):
                if (k != now and not (pd.isna(k) and pd.isna(now))) or t >= until:
                    now, until = k, t + ttl * 1_000_000
                    hits.append(False)
                else:
                    hits.append(True)
            yield pd.DataFrame({"k": b["k"], "id": b["id"], "hit": hits})

    kind = lambda c: requests.schema[c].dataType.simpleString()
    return sorted_.mapInPandas(replay, f"k {kind(key)}, id {kind(id_col)}, hit boolean").withColumnsRenamed({"k": key, "id": id_col})


def hit_rate(replayed: DataFrame) -> DataFrame:
    """One row: hits, misses and hit_rate (0 without requests)."""
    n = lambda c: F.count(F.when(c, 1))
    return replayed.agg(n(F.col("hit")).alias("hits"), n(~F.col("hit")).alias("misses"), F.coalesce(F.avg(F.col("hit").cast("double")), F.lit(0.0)).alias("hit_rate"))


def rates(samples: DataFrame, series: str, ts: str, value: str, seconds: int) -> DataFrame:
    """samples with rate: the increase of a counter over the last `seconds` seconds, each second; a smaller value than the one before is a restart from 0."""
    w = Window.partitionBy(series).orderBy(F.unix_micros(ts))
    before = F.lag(value).over(w)
    step = F.when(before.isNull(), 0.0).when(F.col(value) >= before, F.col(value) - before).otherwise(F.col(value)).cast("double")
    recent = w.rangeBetween(-seconds * 1_000_000 + 1, 0)
    return samples.withColumn("__step", step).withColumn("rate", F.sum("__step").over(recent) / seconds).drop("__step")


def histogram_quantile(buckets: DataFrame, keys: list[str], le: str, count: str, q: float) -> DataFrame:
    """keys and quantile from cumulative buckets (upper bound le, infinite for the last): linear within the bucket that holds it.

    In the last bucket it is the bound before; in the first, from 0. Without counts, or without an infinite bucket, it is null.
    """
    b = F.sort_array(F.collect_list(F.struct(F.col(le).cast("double").alias("le"), F.col(count).cast("double").alias("n"))))
    d = buckets.groupBy(*keys).agg(b.alias("b"))  # the buckets of one series
    last = F.element_at("b", -1)
    place = F.lit(q) * last["n"]
    i = F.size(F.filter("b", lambda x: x["n"] < place))
    at, low, under = F.get("b", i), F.when(i > 0, F.get("b", i - 1)["le"]).otherwise(0.0), F.when(i > 0, F.get("b", i - 1)["n"]).otherwise(0.0)
    inside = low + (at["le"] - low) * (place - under) / F.nullif(at["n"] - under, F.lit(0.0))
    good = (last["le"] == F.lit(float("inf"))) & (last["n"] > 0)
    return d.select(*keys, F.when(good, F.when(i >= F.size("b") - 1, F.get("b", F.size("b") - 2)["le"]).otherwise(F.coalesce(inside, at["le"]))).alias("quantile"))


def sustained(samples: DataFrame, series: str, ts: str, breach: Column, seconds: int) -> DataFrame:
    """series, since, fired_at, until: every time that a condition has held at all samples of `seconds` seconds or more.

    since: its first sample; fired_at: the first sample at least `seconds` later; until: the first sample without it, null
    while it holds. A null condition doesn't hold. Samples of one time count together: all of them must hold.
    """
    one = samples.groupBy(series, ts).agg(F.bool_and(F.coalesce(breach, F.lit(False))).alias("on"))
    w = Window.partitionBy(series).orderBy(ts)
    d = one.withColumn("run", F.sum(F.when(F.col("on"), 0).otherwise(1)).over(w)).withColumn("next", F.lead(ts).over(w))
    held = d.filter("on").withColumn("since", F.min(ts).over(Window.partitionBy(series, "run")))
    due = F.unix_micros(ts) >= F.unix_micros("since") + seconds * 1_000_000
    out = held.groupBy(series, "since").agg(F.min(F.when(due, F.col(ts))).alias("fired_at"), F.max_by("next", ts).alias("until"))
    return out.filter("fired_at IS NOT NULL").select(series, "since", "fired_at", "until")
