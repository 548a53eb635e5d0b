"""Queries on logs and histories: rolling quantiles, cache replay, rates, alerts, versions, captured snapshots, published tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from firmscope.operators import history as H
from firmscope.operators import logs as G
from firmscope.operators.tables import shared_dir
from firmscope.plans.registry import Tables, query
from firmscope.sources import publishing as B

DAY = 86_400


def events(t: Tables):
    return t.events.withColumn("ts", F.col("ts").cast("timestamp"))


@query("WITH w AS (SELECT event_type, event_id, list(value) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW) AS l FROM events WHERE value IS NOT NULL) SELECT event_type, event_id, len(l) AS n, list_sort(l)[floor(len(l) * 0.95::DOUBLE)::INT + 1] AS nth FROM w")
def rolling_p95(t):
    return G.rolling_nth(events(t), "event_type", "event_id", "value", F.col("ts"))


CACHE = f"e AS (SELECT user_id, event_id, epoch_us(ts) AS us FROM events), m AS (SELECT user_id, min(us) AS us FROM e GROUP BY 1 UNION ALL SELECT m.user_id, (SELECT min(e.us) FROM e WHERE e.user_id = m.user_id AND e.us >= m.us + {DAY * 1_000_000}) FROM m WHERE m.us IS NOT NULL), r AS (SELECT e.user_id, event_id, NOT (e.us IN (SELECT m.us FROM m WHERE m.user_id = e.user_id AND m.us IS NOT NULL) AND event_id = min(event_id) OVER (PARTITION BY e.user_id, e.us)) AS hit FROM e)"


@query(f"WITH RECURSIVE {CACHE} SELECT user_id, event_id, hit FROM r")
def cache_hits(t):
    return G.cache_replay(events(t), "user_id", "event_id", F.col("ts"), DAY)


@query(f"WITH RECURSIVE {CACHE} SELECT count(*) FILTER (hit) AS hits, count(*) FILTER (NOT hit) AS misses, avg(hit::INT)::DOUBLE AS hit_rate FROM r")
def cache_hit_rate(t):
    return G.hit_rate(G.cache_replay(events(t), "user_id", "event_id", F.col("ts"), DAY))


@query(f"WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS us, CAST(event_id * 37 % 1009 AS DOUBLE) AS v FROM events), s AS (SELECT *, lag(v) OVER (PARTITION BY user_id ORDER BY us) AS b FROM e) SELECT event_id, sum(CASE WHEN b IS NULL THEN 0 WHEN v >= b THEN v - b ELSE v END) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN {5 * DAY * 1_000_000 - 1} PRECEDING AND CURRENT ROW) / {5 * DAY} AS rate FROM s")
def counter_rates(t):
    d = events(t).withColumn("v", (F.col("event_id") * 37 % 1009).cast("double"))
    return G.rates(d, "user_id", "ts", "v", 5 * DAY).select("event_id", "rate")


BOUNDS = [5, 10, 25, 50, 100, "inf"]


@query(
    "WITH b AS (SELECT user_id, le, count(*) FILTER (value <= le)::DOUBLE AS n FROM events, (SELECT unnest([5, 10, 25, 50, 100, 'inf'::DOUBLE]) AS le) GROUP BY ALL), w AS (SELECT *, lag(le) OVER o AS low, lag(n) OVER o AS under, max(n) OVER (PARTITION BY user_id) AS total, row_number() OVER o AS i FROM b WINDOW o AS (PARTITION BY user_id ORDER BY le)),"
    " h AS (SELECT * FROM w WHERE n >= 0.95 * total QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY le) = 1) SELECT user_id, CASE WHEN le = 'inf' THEN 100.0 ELSE coalesce(low, 0) + (le - coalesce(low, 0)) * (0.95 * total - coalesce(under, 0)) / (n - coalesce(under, 0)) END::DOUBLE AS quantile FROM h"
)
def latency_quantiles(t):
    le = F.explode(F.array(*(F.lit(float(x)) for x in BOUNDS))).alias("le")
    buckets = t.events.select("user_id", "value", le).groupBy("user_id", "le").agg(F.count(F.when(F.col("value") <= F.col("le"), 1)).alias("n"))
    return G.histogram_quantile(buckets, ["user_id"], "le", "n", 0.95)


@query(
    f"WITH s AS (SELECT user_id, ts, bool_and(value > 8) AS hold FROM events GROUP BY 1, 2), w AS (SELECT *, sum((NOT hold)::INT) OVER (PARTITION BY user_id ORDER BY ts) AS run, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS following FROM s),"
    f" h AS (SELECT user_id, run, min(ts) AS since, arg_max(following, ts) AS ended, list(ts) AS l FROM w WHERE hold GROUP BY 1, 2), f AS (SELECT user_id, since, list_min(list_filter(l, lambda x: epoch_us(x) >= epoch_us(since) + {2 * DAY * 1_000_000})) AS fired, (SELECT min(ts) FROM w WHERE w.user_id = h.user_id AND NOT w.hold AND w.ts > h.since) AS ended FROM h)"
    " SELECT user_id, epoch_us(since) AS since, epoch_us(fired) AS fired_at, epoch_us(ended) AS until FROM f WHERE fired IS NOT NULL"
)
def sustained_alerts(t):
    d = G.sustained(events(t), "user_id", "ts", F.col("value") > 8, 2 * DAY)
    return d.select("user_id", *(F.unix_micros(c).alias(c) for c in ("since", "fired_at", "until")))


_load = lambda k: f"SELECT c_custkey AS firm_id, CASE WHEN (c_custkey + {k}) % 5 < 2 THEN c_mktsegment END AS status, CAST(floor((c_custkey + {k}) / 3) AS BIGINT) % 4 AS tier FROM customer WHERE (c_custkey + {k}) % 11 > 1"


@query(
    f"WITH l AS ({' UNION ALL '.join(f'SELECT {k} AS k, * FROM ({_load(k)})' for k in (1, 2, 3, 4))}), s AS (SELECT c_custkey AS firm_id, k FROM customer, range(1, 5) r(k)), j AS (SELECT s.firm_id, s.k, l.k IS NOT NULL AS held, status, tier FROM s LEFT JOIN l ON l.firm_id = s.firm_id AND l.k = s.k),"
    " p AS (SELECT *, lag(held) OVER o AS b_held, lag(status) OVER o AS b_status, lag(tier) OVER o AS b_tier FROM j WINDOW o AS (PARTITION BY firm_id ORDER BY k)), c AS (SELECT *, NOT coalesce(b_held, false) OR NOT held OR status IS DISTINCT FROM b_status OR tier IS DISTINCT FROM b_tier AS change FROM p),"
    " e AS (SELECT *, (SELECT min(k) FROM c d WHERE d.firm_id = c.firm_id AND d.k > c.k AND d.change) AS valid_to FROM c) SELECT firm_id, status, tier, k AS valid_from, valid_to FROM e WHERE held AND change"
)
def version_history(t):
    """Four loads in a row, in which firms change, go and come back."""
    out = None
    for k in (1, 2, 3, 4):
        where = f"(c_custkey + {k}) % 11 > 1"
        load = t.customer.filter(where).selectExpr("c_custkey AS firm_id", f"CASE WHEN (c_custkey + {k}) % 5 < 2 THEN c_mktsegment END AS status", f"CAST(floor((c_custkey + {k}) / 3) AS BIGINT) % 4 AS tier")
        out = H.versions(out, load, "firm_id", ["status", "tier"], F.lit(k).cast("long"))
    return out.select("firm_id", "status", "tier", "valid_from", "valid_to")


@query(
    "WITH s AS (SELECT CASE WHEN c_custkey % 5 > 0 THEN 'f' || c_custkey END AS firm_id, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE c_name END AS name, CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE c_custkey % 101 / 1.0::DOUBLE END AS a, CASE WHEN c_custkey % 2 = 0 THEN (c_custkey % 10) / 10.0::DOUBLE END AS b, CASE WHEN c_custkey % 4 = 0 THEN 'high' END AS c FROM customer), f AS (SELECT firm_id, name AS firm_name, coalesce(nullif(a, 0), b) AS score, coalesce(c, 'medium') AS confidence FROM s)"
    " SELECT firm_id, firm_name, score, CASE WHEN score > 1 THEN score / 100 ELSE score END AS score_normalized, confidence, 'candidate' AS status FROM f WHERE firm_id IS NOT NULL AND coalesce(firm_name, '') <> '' AND score IS NOT NULL"
)
def captured_snapshot(t):
    k = F.col("c_custkey")
    firms = t.customer.select(
        F.when(k % 5 > 0, F.concat(F.lit("f"), k)).alias("firm_id"), F.when(k % 7 == 0, "").otherwise(F.col("c_name")).alias("name"), F.when(k % 3 == 0, 0.0).otherwise((k % 101).cast("double")).alias("score_0_100"),
        F.when(k % 2 == 0, (k % 10) / F.lit(10.0)).alias("integrity_score"), F.when(k % 4 == 0, "high").alias("confidence"),
    )
    return H.captured(firms, "s1", "0" * 64).select("firm_id", "firm_name", "score", "score_normalized", "confidence", "status")


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 2::BIGINT AS version FROM supplier WHERE s_acctbal > 0")
def published_version(t):
    """Two versions published one after the other, and the one that holds read back."""
    root = f"{shared_dir(t.spark).rstrip('/')}/published-{uuid.uuid4().hex}"
    B.publish(t.supplier, root, "2026-01-01T00:00:00")
    now = B.publish(t.supplier.filter("s_acctbal > 0"), root, "2026-01-02T00:00:00")
    return B.published(t.spark, root).withColumn("version", F.lit(now["version"]).cast("long"))


@query("WITH l AS (SELECT n_nationkey AS list_id, n_name AS name, CASE WHEN n_nationkey % 3 > 0 THEN TIMESTAMP '2026-01-01 00:00:00' + INTERVAL (n_nationkey) HOUR END AS updated_at FROM nation), e AS (SELECT c_nationkey AS list_id, count(*) AS entities, count(*) FILTER (c_custkey % 3 = 0) AS individuals FROM customer GROUP BY 1) SELECT l.list_id, name, coalesce(entities, 0) AS entities, coalesce(individuals, 0) AS individuals, updated_at IS NULL OR TIMESTAMP '2026-01-02 12:00:00' >= updated_at + INTERVAL 24 HOUR AS needs_update FROM l LEFT JOIN e USING (list_id)")
def list_statistics(t):
    lists = t.nation.select(F.col("n_nationkey").alias("list_id"), F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 3 > 0, F.lit("2026-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=F.col("n_nationkey"))).alias("updated_at"))
    entities = t.customer.select(F.col("c_nationkey").alias("list_id"), F.when(F.col("c_custkey") % 3 == 0, "individual").otherwise("entity").alias("entity_type"))
    return B.list_statistics(entities, lists, F.lit("2026-01-02 12:00:00")).drop("updated_at")
