"""Queries on firms, scores, gates, history and validation metrics.

Stand-ins: customer and supplier are firms, events are datapoints and agent logs, suppliers' quarters are snapshots.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from firmscope.functions import rules as L
from firmscope.functions import values as V
from firmscope.operators import relational as R
from firmscope.plans.registry import Tables, query

SCORES = """scores AS (SELECT l_suppkey AS firm_id, CAST(year(l_shipdate)*4 + quarter(l_shipdate) AS BIGINT) AS snapshot_id,
 round(avg(l_quantity)*2, 4) AS score, round(avg(l_discount)*10, 4) AS na_rate FROM lineitem GROUP BY 1, 2),
 ids AS (SELECT DISTINCT snapshot_id FROM scores), last2 AS (SELECT snapshot_id, row_number() OVER (ORDER BY snapshot_id DESC) AS rn FROM ids),
 cur AS (SELECT s.* FROM scores s JOIN last2 USING (snapshot_id) WHERE rn = 1), prev AS (SELECT s.* FROM scores s JOIN last2 USING (snapshot_id) WHERE rn = 2)"""


def scores(t: Tables, where: Column | None = None):
    lines = t.lineitem if where is None else t.lineitem.filter(where)
    return lines.groupBy(F.col("l_suppkey").alias("firm_id"), (F.year("l_shipdate") * 4 + F.quarter("l_shipdate")).cast("long").alias("snapshot_id")).agg(
        F.round(F.avg("l_quantity") * 2, 4).alias("score"), F.round(F.avg("l_discount") * 10, 4).alias("na_rate")
    )


def last_two(t: Tables):
    """Scores of the newest snapshot and of the one before.

    The two are found first, from one column; a range of dates for each then reaches the scan, so that no other
    snapshot is read or aggregated.
    """
    ids = [r["i"] for r in t.lineitem.select(F.trunc("l_shipdate", "quarter").alias("i")).distinct().orderBy(F.desc("i")).limit(2).collect()]
    day = lambda d: F.lit(d).cast("timestamp_ntz")

    def at(k: int):
        start = ids[k] if k < len(ids) else date(1, 1, 1)
        end = date(start.year + (start.month + 2) // 12, (start.month + 2) % 12 + 1, 1)
        return scores(t, (F.col("l_shipdate") >= day(start)) & (F.col("l_shipdate") < day(end)))

    return at(0), at(1)


@query("SELECT user_id AS firm_id, event_type AS key, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1")
def latest_datapoint(t):
    d = R.latest_by(t.events, ["user_id", "event_type"], "ts", "event_id")
    v = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return d.select(F.col("user_id").alias("firm_id"), F.col("event_type").alias("key"), v.alias("k"), "event_id")


@query("SELECT user_id AS firm_id, event_id, round(value, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_row_number(t):
    return R.latest_by(t.events, ["user_id"], "ts", "event_id").select(F.col("user_id").alias("firm_id"), "event_id", F.round("value", 6).alias("value"))


@query("SELECT c_custkey AS id, CASE WHEN r = 1 THEN base ELSE base || '-' || c_custkey END AS firm_id FROM (SELECT c_custkey, lower(c_mktsegment) || '-' || c_nationkey AS base, row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY c_custkey) AS r FROM customer)")
def dedupe_suffix_ids(t):
    base = F.concat(F.lower("c_mktsegment"), F.lit("-"), "c_nationkey")
    r = F.row_number().over(Window.partitionBy("c_mktsegment", "c_nationkey").orderBy("c_custkey"))
    return t.customer.select(F.col("c_custkey").alias("id"), F.when(r == 1, base).otherwise(F.concat(base, F.lit("-"), "c_custkey")).alias("firm_id"))


def firms(t):
    return t.customer.select(F.col("c_custkey").alias("firm_id"), F.round((F.col("c_acctbal") + 1000) / 110).cast("long").alias("score"), F.col("c_mktsegment").alias("model_type"), F.col("c_nationkey").alias("nation"))


FIRMS = "firms AS (SELECT c_custkey AS firm_id, CAST(round((c_acctbal + 1000) / 110) AS BIGINT) AS score, c_mktsegment AS model_type, c_nationkey AS nation FROM customer)"
PCT = "CAST(CASE WHEN count(*) OVER ({p}) = 1 THEN 50 ELSE round_even((1 - (count(*) OVER ({p} ORDER BY score RANGE UNBOUNDED PRECEDING) - 1) / (count(*) OVER ({p}) - 1)) * 100, 0) END AS BIGINT)"


@query(f"WITH {FIRMS} SELECT firm_id, score, {PCT.format(p='')} AS percentile FROM firms")
def percentile_universe(t):
    return R.percentile_best0(firms(t), "score", [], "percentile").select("firm_id", "score", "percentile")


@query(f"WITH {FIRMS} SELECT firm_id, model_type, {PCT.format(p='PARTITION BY model_type')} AS percentile FROM firms")
def percentile_by_model(t):
    return R.percentile_best0(firms(t), "score", ["model_type"], "percentile").select("firm_id", "model_type", "percentile")


@query(f"WITH {FIRMS} SELECT firm_id, nation, {PCT.format(p='PARTITION BY nation')} AS percentile FROM firms")
def percentile_by_jurisdiction(t):
    return R.percentile_best0(firms(t), "score", ["nation"], "percentile").select("firm_id", "nation", "percentile")


PILLARS = {"click": ("transparency", 0.25), "view": ("transparency", 0.25), "purchase": ("payout", 0.4), "error": ("risk", 0.35), "signup": ("risk", 0.35)}


def features(t):
    d = R.latest_by(t.events, ["user_id", "event_type"], "ts", "event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    d = d.select(F.col("user_id").alias("firm_id"), F.col("event_type").alias("metric"), F.when(k % 7 == 0, None).otherwise(k % 70).alias("v"))
    pillar, weight = F.lit("risk"), F.lit(0.35)
    for m, (p, w) in PILLARS.items():
        pillar, weight = F.when(F.col("metric") == m, p).otherwise(pillar), F.when(F.col("metric") == m, w).otherwise(weight)
    return d.withColumns({"pillar": pillar, "weight": weight, "s": V.bin_weight(F.col("v"), [0, 7, 14, 30, 60], [1, 0.9, 0.7, 0.5, 0.3]), "na": F.col("v").isNull().cast("int")})


FEATURES = """d AS (SELECT user_id AS firm_id, event_type AS metric, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1),
 f AS (SELECT firm_id, metric, CASE WHEN k % 7 = 0 THEN NULL ELSE k % 70 END AS v FROM d),
 m AS (SELECT firm_id, metric, CASE WHEN metric IN ('click', 'view') THEN 'transparency' WHEN metric = 'purchase' THEN 'payout' ELSE 'risk' END AS pillar, CASE WHEN metric IN ('click', 'view') THEN 0.25::DOUBLE WHEN metric = 'purchase' THEN 0.4::DOUBLE ELSE 0.35::DOUBLE END AS weight,
 CASE WHEN v IS NULL THEN 0.5::DOUBLE WHEN v <= 0 THEN 1::DOUBLE WHEN v <= 7 THEN 0.9::DOUBLE WHEN v <= 14 THEN 0.7::DOUBLE WHEN v <= 30 THEN 0.5::DOUBLE ELSE 0.3::DOUBLE END AS s, CASE WHEN v IS NULL THEN 1 ELSE 0 END AS na FROM f),
 p AS (SELECT firm_id, pillar, max(weight) AS weight, avg(s) AS ps, sum(na) AS n_na, count(*) AS n FROM m GROUP BY 1, 2),
 sc AS (SELECT firm_id, round(100 * sum(weight * ps) / sum(weight), 4) AS score, round(sum(n_na) / sum(n), 6) AS na_rate FROM p GROUP BY 1)"""


def pillars(t):
    return features(t).groupBy("firm_id", "pillar").agg(F.max("weight").alias("weight"), F.avg("s").alias("ps"), F.sum("na").alias("n_na"), F.count("*").alias("n"))


def scored(t):
    return pillars(t).groupBy("firm_id").agg(F.round(100 * F.sum(F.col("weight") * F.col("ps")) / F.sum("weight"), 4).alias("score"), F.round(F.sum("n_na") / F.sum("n"), 6).alias("na_rate"))


@query(f"WITH {FEATURES} SELECT firm_id, score, na_rate FROM sc")
def binned_score(t):
    return scored(t)


@query(f"WITH {FEATURES} SELECT firm_id, pillar, round(ps, 6) AS pillar_score, CAST(n_na AS BIGINT) AS n_na, CAST(n AS BIGINT) AS n FROM p")
def pillar_scores(t):
    return pillars(t).select("firm_id", "pillar", F.round("ps", 6).alias("pillar_score"), F.col("n_na").cast("long").alias("n_na"), "n")


@query("SELECT p_partkey, CAST(CASE WHEN p_size > 40 THEN 4 WHEN p_size > 20 THEN 3 WHEN p_size > 10 THEN 2 ELSE 1 END AS BIGINT) AS bin, round(least(1, greatest(0, (p_retailprice - 900) / 1000)), 6) AS clamped FROM part")
def bins_np1_score(t):
    return t.part.select("p_partkey", (V.bin_number(F.col("p_size"), [10, 20, 40]) + 1).cast("long").alias("bin"), F.round(V.clamp01((F.col("p_retailprice") - 900) / 1000), 6).alias("clamped"))


@query("WITH x AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value FROM events) SELECT event_id, round(CASE WHEN k % 3 <> 0 THEN k WHEN event_id % 2 = 0 THEN value END, 6)::DOUBLE AS resolved, CASE WHEN k % 3 <> 0 THEN 'primary' WHEN event_id % 2 = 0 THEN 'fallback' ELSE 'none' END AS source FROM x")
def fallback_chain(t):
    k = F.get_json_object("props", "$.k").cast("long")
    r = V.resolve(("primary", F.when(k % 3 != 0, k)), ("fallback", F.when(F.col("event_id") % 2 == 0, F.col("value"))))
    return t.events.select("event_id", r.alias("r")).select("event_id", F.round("r.value", 6).alias("resolved"), F.col("r.source").alias("source"))


@query("SELECT c_custkey AS firm_id, CASE WHEN n_nationkey % 5 = 0 THEN 'LOW' WHEN n_nationkey % 5 = 1 THEN 'MEDIUM' WHEN r_name = 'EUROPE' THEN 'LOW' ELSE 'OFFSHORE' END AS level, CASE WHEN n_nationkey % 5 = 0 THEN 0.9::DOUBLE WHEN n_nationkey % 5 = 1 THEN 0.6::DOUBLE WHEN r_name = 'EUROPE' THEN 0.9::DOUBLE ELSE 0.1::DOUBLE END AS score FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def jurisdiction_lookup(t):
    level = F.when(F.col("n_nationkey") % 5 == 0, "LOW").when(F.col("n_nationkey") % 5 == 1, "MEDIUM").when(F.col("r_name") == "EUROPE", "LOW").otherwise("OFFSHORE")
    dim = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", level.alias("level"))
    return t.customer.join(dim, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("firm_id"), "level", V.mapped(F.col("level"), {"LOW": 0.9, "MEDIUM": 0.6, "OFFSHORE": 0.1}).alias("score"))


@query("SELECT d.doc_id, round(((CASE WHEN trim(coalesce(text, '')) <> '' THEN 1 ELSE 0 END) + (CASE WHEN lang = 'en' THEN 1 ELSE 0 END) + (CASE WHEN quality IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN toxic = 0 THEN 1 ELSE 0 END)) / 4, 3) AS completeness, CASE WHEN quality IS NOT NULL AND toxic = 0 AND lang = 'en' THEN 'complete' WHEN quality IS NOT NULL OR lang = 'en' THEN 'partial' ELSE 'thin' END AS badge FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def completeness_badge(t):
    d = t.documents.join(t.labels, "doc_id", "left")
    flags = [~V.is_blank(F.col("text")), F.col("lang") == "en", F.col("quality").isNotNull(), F.col("toxic") == 0]
    n = sum((F.when(f, 1).otherwise(0) for f in flags), F.lit(0))
    badge = F.when(flags[1] & flags[2] & flags[3], "complete").when(flags[2] | flags[1], "partial").otherwise("thin")
    return d.select("doc_id", F.round(n / 4, 3).alias("completeness"), badge.alias("badge"))


def verdicts(t, limit=0.4, strict=True):
    err = features(t).groupBy("firm_id").agg(F.bool_or((F.col("metric") == "error") & (F.col("s") >= 0.9)).alias("technical"))
    s = scored(t).join(err, "firm_id")
    reasons = F.array_compact(F.array(F.when(F.col("na_rate") > limit, F.lit("na_rate_too_high")) if strict else F.lit(None).cast("string"), F.when(F.col("technical"), F.lit("technical_error")), F.when(F.col("score") < 55, F.lit("score_too_low")) if strict else F.lit(None).cast("string")))
    return s.withColumn("reasons", F.array_join(reasons, ",")).withColumn("verdict", F.when(F.col("reasons") == "", "pass").otherwise("review")).select("firm_id", "score", "verdict", "reasons")


TECH = "x AS (SELECT sc.*, technical FROM sc JOIN (SELECT firm_id, bool_or(metric = 'error' AND s >= 0.9) AS technical FROM m GROUP BY 1) USING (firm_id))"


@query(f"WITH {FEATURES}, {TECH}, y AS (SELECT firm_id, score, concat_ws(',', CASE WHEN na_rate > 0.4 THEN 'na_rate_too_high' END, CASE WHEN technical THEN 'technical_error' END, CASE WHEN score < 55 THEN 'score_too_low' END) AS reasons FROM x) SELECT firm_id, score, CASE WHEN reasons = '' THEN 'pass' ELSE 'review' END AS verdict, reasons FROM y")
def gate_verdicts(t):
    return verdicts(t)


@query(f"WITH {FEATURES}, {TECH} SELECT firm_id, score, CASE WHEN technical THEN 'review' ELSE 'pass' END AS verdict, CASE WHEN technical THEN 'technical_error' ELSE '' END AS reasons FROM x")
def gate_relaxed(t):
    return verdicts(t, strict=False)


@query(f"WITH {FEATURES} SELECT firm_id, score, na_rate, c_name AS brand, n_name AS jurisdiction FROM sc JOIN customer ON firm_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey WHERE na_rate <= 0.4 AND c_mktsegment IN ('BUILDING', 'MACHINERY')")
def publishable_join(t):
    d = scored(t).filter("na_rate <= 0.4").join(t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")), F.col("firm_id") == F.col("c_custkey"))
    return d.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("firm_id", "score", "na_rate", F.col("c_name").alias("brand"), F.col("n_name").alias("jurisdiction"))


@query("SELECT count(DISTINCT o_custkey) AS firms, round(count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) * 100.0 / nullif(count(DISTINCT o_custkey), 0), 4)::DOUBLE AS coverage_pct, count(*) FILTER (WHERE o_totalprice > 100000) AS large FROM orders")
def coverage_metrics(t):
    n, f = F.count_distinct("o_custkey"), F.count_distinct(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")))
    return t.orders.agg(n.alias("firms"), F.round(V.share(f * 100, n), 4).alias("coverage_pct"), F.count_if(F.col("o_totalprice") > 100000).alias("large"))


@query(f"WITH {SCORES} SELECT round(avg(abs(cur.score - prev.score)), 6) AS avg_change, count(*) AS firms FROM cur JOIN prev USING (firm_id)")
def avg_score_change(t):
    cur, prev = last_two(t)
    return cur.alias("c").join(prev.alias("p"), "firm_id").agg(F.round(F.avg(F.abs(F.col("c.score") - F.col("p.score"))), 6).alias("avg_change"), F.count("*").alias("firms"))


def turnover(t, k):
    cur, prev = last_two(t)
    top = lambda d: d.orderBy(F.desc_nulls_last("score"), "firm_id").limit(k).select("firm_id")
    a, b = top(cur), top(prev)
    return a.subtract(b).agg(F.count("*").alias("entered")).crossJoin(b.subtract(a).agg(F.count("*").alias("left_top")))  # one row each


def turnover_sql(k):
    top = lambda d: f"(SELECT firm_id FROM {d} ORDER BY score DESC NULLS LAST, firm_id LIMIT {k})"
    return f"WITH {SCORES} SELECT (SELECT count(*) FROM ({top('cur')} EXCEPT {top('prev')})) AS entered, (SELECT count(*) FROM ({top('prev')} EXCEPT {top('cur')})) AS left_top"


@query(turnover_sql(10))
def top10_turnover(t):
    return turnover(t, 10)


@query(turnover_sql(20))
def top20_turnover(t):
    return turnover(t, 20)


@query(f"WITH {SCORES} SELECT round(avg(CASE WHEN (cur.score >= 50) <> (prev.score >= 50) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS churn FROM cur JOIN prev USING (firm_id)")
def verdict_churn(t):
    cur, prev = last_two(t)
    changed = (F.col("c.score") >= 50) != (F.col("p.score") >= 50)
    return cur.alias("c").join(prev.alias("p"), "firm_id").agg(F.round(F.avg(F.when(changed, 1.0).otherwise(0.0)), 6).alias("churn"))


@query(f"WITH {FEATURES}, w AS (SELECT *, sum(weight * ps) OVER (PARTITION BY firm_id) AS sw, sum(weight) OVER (PARTITION BY firm_id) AS tw FROM p) SELECT pillar, round(avg(abs(100 * sw / tw - 100 * (sw - weight * ps) / (tw - weight))), 5) AS mean_shift, count(*) AS firms FROM w WHERE tw - weight > 0.001 GROUP BY 1")
def sensitivity_leave_one_out(t):
    w = Window.partitionBy("firm_id")
    d = pillars(t).withColumns({"sw": F.sum(F.col("weight") * F.col("ps")).over(w), "tw": F.sum("weight").over(w)}).filter("tw - weight > 0.001")
    return d.groupBy("pillar").agg(F.round(F.avg(F.abs(100 * F.col("sw") / F.col("tw") - 100 * (F.col("sw") - F.col("weight") * F.col("ps")) / (F.col("tw") - F.col("weight")))), 5).alias("mean_shift"), F.count("*").alias("firms"))


@query("SELECT c_mktsegment AS model_type, round(skewness(c_acctbal), 5) AS skew FROM customer GROUP BY 1")
def skew_sample(t):
    return t.customer.groupBy(F.col("c_mktsegment").alias("model_type")).agg(F.round(R.sample_skewness("c_acctbal"), 5).alias("skew"))


@query("SELECT round(skewness(c_acctbal) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0)), 5) AS skew, round(stddev_pop(c_acctbal), 4) AS sd FROM customer")
def skew_population(t):
    return t.customer.agg(F.round(F.skewness("c_acctbal"), 5).alias("skew"), F.round(F.stddev_pop("c_acctbal"), 4).alias("sd"))


@query("SELECT round(CASE WHEN count(*) < 2 THEN 0 ELSE max(m) - min(m) END, 4) AS bias_range FROM (SELECT avg(c_acctbal) AS m FROM customer GROUP BY c_mktsegment)")
def group_bias_range(t):
    g = t.customer.groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("m"))
    return g.agg(F.round(F.when(F.count("*") < 2, 0.0).otherwise(F.max("m") - F.min("m")), 4).alias("bias_range"))


@query("WITH g AS (SELECT c_nationkey AS tier, avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM customer GROUP BY 1), a AS (SELECT avg(m) AS gm, stddev_pop(m) AS gs FROM g) SELECT tier, round(m, 4) AS mean_score, round(sd, 4) AS sd FROM g, a WHERE abs(m - gm) > 1.5 * gs")
def tier_outliers(t):
    g = t.customer.groupBy(F.col("c_nationkey").alias("tier")).agg(F.avg("c_acctbal").alias("m"), F.stddev_pop("c_acctbal").alias("sd"))
    a = g.agg(F.avg("m").alias("gm"), F.stddev_pop("m").alias("gs"))
    return g.crossJoin(F.broadcast(a)).filter("abs(m - gm) > 1.5 * gs").select("tier", F.round("m", 4).alias("mean_score"), F.round("sd", 4).alias("sd"))  # a is one row


@query(f"WITH {FIRMS}, b AS (SELECT unnest(['0-20', '20-40', '40-60', '60-80', '80-100', 'none']) AS band), c AS (SELECT CASE WHEN score <= 20 THEN '0-20' WHEN score <= 40 THEN '20-40' WHEN score <= 60 THEN '40-60' WHEN score <= 80 THEN '60-80' ELSE '80-100' END AS band, count(*) AS n FROM firms GROUP BY 1) SELECT band, coalesce(n, 0) AS n FROM b LEFT JOIN c USING (band)")
def score_histogram(t):
    s = F.col("score")
    band = F.when(s <= 20, "0-20").when(s <= 40, "20-40").when(s <= 60, "40-60").when(s <= 80, "60-80").otherwise("80-100")
    bands = t.spark.createDataFrame([(x,) for x in ("0-20", "20-40", "40-60", "60-80", "80-100", "none")], "band string")
    return bands.join(firms(t).groupBy(band.alias("band")).agg(F.count("*").alias("n")), "band", "left").select("band", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"WITH {SCORES}, c AS (SELECT abs(cur.score - prev.score) AS d FROM cur JOIN prev USING (firm_id)), r AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i, count(*) OVER () AS n FROM c) SELECT round(d, 4) AS median_change FROM r WHERE i = n // 2")
def upper_median_change(t):
    cur, prev = last_two(t)
    d = cur.alias("c").join(prev.alias("p"), "firm_id").select(F.abs(F.col("c.score") - F.col("p.score")).alias("d"))
    return R.nth_smallest(d, "d", F.floor(F.col("n") / 2)).select(F.round("d", 4).alias("median_change"))


@query("SELECT round(value, 6) AS p95 FROM (SELECT value, row_number() OVER (ORDER BY value) - 1 AS i, count(*) OVER () AS n FROM events) WHERE i = floor(n * 0.95)")
def p95_nearest(t):
    return R.nth_smallest(t.events, "value", F.floor(F.col("n") * 0.95)).select(F.round("value", 6).alias("p95"))


@query("SELECT count(*) AS linked FROM (SELECT o_orderkey FROM orders WHERE o_totalprice > 300000 UNION SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49 AND l_orderkey IN (SELECT o_orderkey FROM orders))")
def evidence_linkage(t):
    a = t.orders.filter("o_totalprice > 300000").select("o_orderkey")
    b = t.lineitem.filter("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey")).join(t.orders.select("o_orderkey"), "o_orderkey", "left_semi")
    return a.union(b).distinct().agg(F.count("*").alias("linked"))


@query("SELECT o_orderpriority AS version, count(*) AS n FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def version_mode(t):
    return t.orders.groupBy(F.col("o_orderpriority").alias("version")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "version").limit(1)


@query("SELECT event_id FROM events e WHERE event_type = 'error' AND EXISTS (SELECT 1 FROM customer c WHERE (c.c_custkey = e.user_id AND c.c_acctbal < 0) OR (e.user_id % 10 = 0 AND c.c_name = 'Customer#' || lpad(CAST(e.user_id // 10 AS VARCHAR), 9, '0') AND c.c_acctbal < 2000))")
def events_predicted(t):
    e = t.events.filter("event_type = 'error'")
    by_id = e.join(t.customer.filter("c_acctbal < 0"), F.col("c_custkey") == F.col("user_id"), "left_semi")
    named = e.filter("user_id % 10 = 0").withColumn("nm", F.concat(F.lit("Customer#"), F.lpad(F.floor(F.col("user_id") / 10).cast("string"), 9, "0")))
    by_name = named.join(t.customer.filter("c_acctbal < 2000"), F.col("c_name") == F.col("nm"), "left_semi")
    return by_id.select("event_id").union(by_name.select("event_id")).distinct()


@query("SELECT event_type, count(*) AS n FROM events WHERE ts BETWEEN (SELECT max(ts) FROM events) - INTERVAL 7 DAY AND (SELECT max(ts) FROM events) GROUP BY 1")
def lookback_count(t):
    as_of = t.events.agg(F.max("ts").alias("as_of"))
    d = t.events.crossJoin(F.broadcast(as_of)).filter(F.col("ts").between(F.col("as_of") - F.expr("INTERVAL 7 DAYS"), F.col("as_of")))  # one row
    return d.groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT o_custkey AS firm_id, CAST(o_orderdate AS DATE) AS day, round(avg(o_totalprice), 4) AS avg_score, min(o_totalprice) AS low, max(o_totalprice) AS high, count(*) AS n FROM orders GROUP BY 1, 2")
def trajectory_daily(t):
    return t.orders.groupBy(F.col("o_custkey").alias("firm_id"), F.to_date("o_orderdate").alias("day")).agg(F.round(F.avg("o_totalprice"), 4).alias("avg_score"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"), F.count("*").alias("n"))


@query("SELECT o_custkey AS firm_id, count(*) AS n, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders GROUP BY 1 HAVING count(*) >= 2 ORDER BY 2 DESC, 1 LIMIT 20")
def having_topn_history(t):
    g = t.orders.groupBy(F.col("o_custkey").alias("firm_id")).agg(F.count("*").alias("n"), F.max(F.to_date("o_orderdate")).alias("last_day"))
    return g.filter("n >= 2").orderBy(F.desc("n"), "firm_id").limit(20)


@query("SELECT event_type AS agent, count(*) AS runs, round(count(*) FILTER (WHERE value < 10) / count(*), 6) AS failure_rate, round(avg(value), 4) AS quality, date_diff('second', max(ts), (SELECT max(ts) FROM events)) // 3600 AS hours_since FROM events GROUP BY 1")
def agent_health(t):
    as_of = t.events.agg(F.max("ts").alias("as_of"))
    g = t.events.groupBy(F.col("event_type").alias("agent")).agg(F.count("*").alias("runs"), F.round(F.count_if(F.col("value") < 10) / F.count("*"), 6).alias("failure_rate"), F.round(F.avg("value"), 4).alias("quality"), F.max("ts").alias("last"))
    sec = lambda c: F.unix_timestamp(F.date_trunc("second", c))
    return g.crossJoin(F.broadcast(as_of)).withColumn("hours_since", F.floor((sec(F.col("as_of")) - sec(F.col("last"))) / 3600)).drop("last", "as_of")  # one row


@query("WITH d AS (SELECT event_type AS agent, CAST(ts AS DATE) AS day, avg(CASE WHEN value < 10 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS rate FROM events GROUP BY 1, 2), r AS (SELECT *, dense_rank() OVER (PARTITION BY agent ORDER BY day DESC) AS k FROM d) SELECT agent, round(max(CASE WHEN k = 1 THEN rate END) - max(CASE WHEN k = 2 THEN rate END), 6) AS change FROM r WHERE k <= 2 GROUP BY 1")
def agent_degradation(t):
    d = t.events.groupBy(F.col("event_type").alias("agent"), F.to_date("ts").alias("day")).agg(F.avg(F.when(F.col("value") < 10, 1.0).otherwise(0.0)).alias("rate"))
    r = d.withColumn("k", F.dense_rank().over(Window.partitionBy("agent").orderBy(F.desc("day")))).filter("k <= 2")
    return r.groupBy("agent").agg(F.round(F.max(F.when(F.col("k") == 1, F.col("rate"))) - F.max(F.when(F.col("k") == 2, F.col("rate"))), 6).alias("change"))


@query("SELECT round(avg(CASE WHEN n > 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS multi_source_rate FROM (SELECT lang, n_chars % 97 AS topic, count(DISTINCT source) AS n FROM documents GROUP BY 1, 2)")
def multi_source_rate(t):
    g = t.documents.groupBy("lang", (F.col("n_chars") % 97).alias("topic")).agg(F.count_distinct("source").alias("n"))
    return g.agg(F.round(F.avg(F.when(F.col("n") > 1, 1.0).otherwise(0.0)), 6).alias("multi_source_rate"))


@query("WITH m AS (SELECT avg(c_acctbal) AS mean_score, stddev_pop(c_acctbal) AS sd, count(*) FILTER (WHERE c_acctbal < 0) * 1.0 / count(*) AS na FROM customer), u AS (SELECT 'mean_score' AS metric, mean_score AS v, 6000 AS lim, 'below' AS side FROM m UNION ALL SELECT 'sd', sd, 1000, 'above' FROM m UNION ALL SELECT 'na', na, 0.5, 'above' FROM m) SELECT metric, round(v::DOUBLE, 4) AS value, (side = 'below' AND v < lim) OR (side = 'above' AND v > lim) AS alert FROM u")
def alert_rules(t):
    m = t.customer.agg(F.avg("c_acctbal").alias("mean_score"), F.stddev_pop("c_acctbal").alias("sd"), (F.count_if(F.col("c_acctbal") < 0) / F.count("*")).alias("na"))
    u = m.unpivot([], ["mean_score", "sd", "na"], "metric", "v")
    rules = t.spark.createDataFrame([("mean_score", 6000.0, "below"), ("sd", 1000.0, "above"), ("na", 0.5, "above")], "metric string, lim double, side string")
    return u.join(rules, "metric").select("metric", F.round("v", 4).alias("value"), F.expr("(side = 'below' and v < lim) or (side = 'above' and v > lim)").alias("alert"))


@query("SELECT n_name AS list_name, count(s_suppkey) AS entities, count(CASE WHEN s_acctbal < 0 THEN 1 END) AS negative, count(DISTINCT s_acctbal) AS programs FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1")
def sanctions_statistics(t):
    d = t.nation.join(t.supplier, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return d.groupBy(F.col("n_name").alias("list_name")).agg(F.count("s_suppkey").alias("entities"), F.count(F.when(F.col("s_acctbal") < 0, 1)).alias("negative"), F.count_distinct("s_acctbal").alias("programs"))


@query("SELECT CASE WHEN value >= 50 THEN 'SANCTIONED' WHEN value >= 20 THEN 'REVIEW' ELSE 'CLEAR' END AS status, count(*) AS n, count(DISTINCT user_id) AS firms, round(avg(value), 4) AS mean_score FROM events GROUP BY 1")
def screening_status_rollup(t):
    status = V.band(F.col("value"), [(50, "SANCTIONED"), (20, "REVIEW")], "CLEAR")
    return t.events.groupBy(status.alias("status")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("firms"), F.round(F.avg("value"), 4).alias("mean_score"))


@query("SELECT source, sha256(text) AS sha, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1, 2")
def evidence_dedup_hash(t):
    return t.documents.groupBy("source", F.sha2("text", 256).alias("sha")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))


def old_new(t):
    c = t.customer.select(F.col("c_custkey").alias("firm_id"), F.col("c_name").alias("brand"), F.col("c_acctbal").alias("v"))
    old = c.filter("firm_id % 3 <> 0").withColumn("brand", F.when(F.col("firm_id") % 5 == 0, None).otherwise(F.col("brand")))
    return old, c.filter("firm_id % 2 = 0").withColumns({"brand": F.concat(F.lit("new "), "brand"), "v": F.when(F.col("firm_id") % 7 == 0, None).otherwise(F.col("v") + 1)})


OLDNEW = "o AS (SELECT c_custkey AS firm_id, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_name END AS brand, c_acctbal AS v FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT c_custkey AS firm_id, 'new ' || c_name AS brand, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal + 1 END AS v FROM customer WHERE c_custkey % 2 = 0)"


@query(f"WITH {OLDNEW} SELECT firm_id, coalesce(n.brand, o.brand) AS brand, round(coalesce(n.v, o.v), 4) AS v FROM o FULL JOIN n USING (firm_id)")
def upsert_coalesce(t):
    return R.upsert(*old_new(t), ["firm_id"]).withColumn("v", F.round("v", 4))


@query(f"WITH {OLDNEW} SELECT firm_id, coalesce(o.brand, n.brand) AS brand, round(coalesce(o.v, n.v), 4) AS v FROM o FULL JOIN n USING (firm_id)")
def upsert_fill_only(t):
    return R.upsert(*old_new(t), ["firm_id"], keep_old=True).withColumn("v", F.round("v", 4))


@query(f"WITH {OLDNEW} SELECT firm_id, brand, round(v, 4) AS v FROM o UNION ALL SELECT firm_id, brand, round(v, 4) FROM n WHERE firm_id NOT IN (SELECT firm_id FROM o)")
def insert_if_absent(t):
    old, new = old_new(t)
    return R.insert_absent(old, new, ["firm_id"], "brand").withColumn("v", F.round("v", 4))


@query("SELECT c_custkey AS firm_id, CASE WHEN c_acctbal < 0 AND c_mktsegment = 'BUILDING' THEN 'balance,segment' WHEN c_acctbal < 0 THEN 'balance' ELSE 'segment' END AS broken FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING'")
def assert_rules(t):
    d = R.broken_rules(t.customer, {"balance": F.col("c_acctbal") >= 0, "segment": F.col("c_mktsegment") != "BUILDING"})
    return d.select(F.col("c_custkey").alias("firm_id"), F.array_join("broken", ",").alias("broken"))


@query("WITH a AS (SELECT event_id, user_id, ts, CASE WHEN value < 30 THEN 1 ELSE 0 END AS f FROM events), b AS (SELECT *, sum(1 - f) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM a) SELECT event_id, CAST(sum(f) OVER (PARTITION BY user_id, i ORDER BY ts, event_id) AS BIGINT) AS streak FROM b")
def streak_islands(t):
    return R.streaks(t.events, "user_id", ["ts", "event_id"], F.col("value") < 30).select("event_id", "streak")


@query("SELECT p_brand, p_partkey, p_retailprice, CAST(rank AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part) WHERE rank <= 2")
def topk_per_group(t):
    d = R.top_per_group(t.part, ["p_brand"], 2, F.desc("p_retailprice"), F.col("p_partkey"))
    return d.select("p_brand", "p_partkey", "p_retailprice", F.col("rank").cast("long").alias("rank"))


@query("SELECT c_custkey AS firm_id FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def unscored_firms(t):
    return t.customer.select(F.col("c_custkey").alias("firm_id")).join(t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("firm_id")), "firm_id", "left_anti")


@query("SELECT n_nationkey, '{\"name\":\"' || n_name || '\",\"region\":\"' || r_name || '\"}' AS doc FROM nation JOIN region ON n_regionkey = r_regionkey")
def json_build_object(t):
    d = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return d.select("n_nationkey", F.to_json(F.struct(F.col("n_name").alias("name"), F.col("r_name").alias("region"))).alias("doc"))


Q = "q AS (SELECT o_custkey AS firm_id, CAST(year(o_orderdate) AS BIGINT) AS y, avg(o_totalprice) AS p, count(*) AS n, count(DISTINCT o_orderstatus) AS st FROM orders GROUP BY 1, 2), h AS (SELECT *, lag(p) OVER (PARTITION BY firm_id ORDER BY y) AS pp FROM q), v AS (SELECT firm_id, least(1, count(*) FILTER (WHERE abs(p - pp) > 20000) / 12.0::DOUBLE) AS f, least(1, avg(abs(p - pp)) / 200000) AS a, least(1, max(n) / 20.0::DOUBLE) AS i, avg(st) / 3 AS c, count(*) AS snaps FROM h GROUP BY 1)"


def volatility(t):
    q = t.orders.groupBy(F.col("o_custkey").alias("firm_id"), F.year("o_orderdate").cast("long").alias("y")).agg(F.avg("o_totalprice").alias("p"), F.count("*").alias("n"), F.count_distinct("o_orderstatus").alias("st"))
    h = q.withColumn("d", F.abs(F.col("p") - F.lag("p").over(Window.partitionBy("firm_id").orderBy("y"))))
    one = F.lit(1.0)
    v = h.groupBy("firm_id").agg(F.least(one, F.count_if(F.col("d") > 20000) / 12).alias("f"), F.least(one, F.avg("d") / 200000).alias("a"), F.least(one, F.max("n") / 20).alias("i"), (F.avg("st") / 3).alias("c"), F.count("*").alias("snaps"))
    return v.withColumn("rvi", F.when(F.col("snaps") < 3, None).otherwise(F.round(V.weighted({"f": 0.3, "a": 0.3, "i": 0.25, "c": 0.15}), 5)))


@query(f"WITH {Q} SELECT firm_id, CASE WHEN snaps < 3 THEN NULL ELSE round(0.3*f + 0.3*a + 0.25*i + 0.15*c, 5) END AS rvi FROM v")
def rule_volatility_index(t):
    return volatility(t).select("firm_id", "rvi")


@query(f"WITH {Q}, r AS (SELECT firm_id, f, a, i, c, round(0.3*f + 0.3*a + 0.25*i + 0.15*c, 5) AS rvi FROM v WHERE snaps >= 3), s AS (SELECT firm_id, round(0.25*(1-rvi) + 0.25*(1-a) + 0.2*i + 0.15*f + 0.15*c, 7) AS survivability FROM r) SELECT firm_id, survivability, CASE WHEN survivability >= 0.6 THEN 'strong' WHEN survivability >= 0.45 THEN 'moderate' ELSE 'weak' END AS band FROM s")
def survivability(t):
    d = volatility(t).filter("rvi is not null").withColumn("survivability", F.round(V.weighted({"rvi": 0.25, "a": 0.25, "i": 0.2, "f": 0.15, "c": 0.15}, invert=("rvi", "a")), 7))
    return d.select("firm_id", "survivability", V.band(F.col("survivability"), [(0.6, "strong"), (0.45, "moderate")], "weak").alias("band"))


@query(f"WITH {Q} SELECT firm_id, round(least(1, greatest(0, 0.3*(1-f) + 0.2*(1-a) + 0.2*i + 0.2*c + 0.1*(1-a) - CASE WHEN snaps < 3 THEN 0.30 ELSE 0 END - CASE WHEN f > 0.4 THEN 0.25 ELSE 0 END - CASE WHEN i > 0.9 THEN 0.40 ELSE 0 END - CASE WHEN c < 0.5 THEN 0.20 ELSE 0 END)), 5)::DOUBLE AS inclusion FROM v WHERE a IS NOT NULL")
def inclusion_probability(t):
    d, c = volatility(t).filter("a is not null"), F.col
    p = L.inclusion(1 - c("f"), 1 - c("a"), c("i"), 1 - c("c"), c("a"), c("snaps") < 3, c("f"), c("i") > 0.9, c("c") < 0.5)
    return d.select("firm_id", F.round(p, 5).alias("inclusion"))


@query(f"WITH {FEATURES} SELECT c.scenario, round(avg(CASE c.scenario WHEN 'drop_payout' THEN CASE WHEN pillar = 'payout' THEN NULL ELSE ps END WHEN 'na_shock' THEN (ps + 0.5) / 2 ELSE ps END), 6) AS mean_pillar FROM p, (SELECT unnest(['base', 'drop_payout', 'na_shock']) AS scenario) c GROUP BY 1")
def stress_scenarios(t):
    s = F.col("scenario")
    cases = F.explode(F.array(F.lit("base"), F.lit("drop_payout"), F.lit("na_shock")))
    v = F.when(s == "drop_payout", F.when(F.col("pillar") == "payout", None).otherwise(F.col("ps"))).when(s == "na_shock", (F.col("ps") + 0.5) / 2).otherwise(F.col("ps"))
    return pillars(t).select("pillar", "ps", cases.alias("scenario")).groupBy("scenario").agg(F.round(F.avg(v), 6).alias("mean_pillar"))


@query("SELECT o_custkey AS firm_id, string_agg(o_orderkey || ':' || o_orderstatus, ',' ORDER BY o_orderkey) AS trail FROM orders WHERE o_totalprice > 250000 GROUP BY 1")
def audit_trail(t):
    one = F.struct("o_orderkey", F.concat(F.col("o_orderkey"), F.lit(":"), F.col("o_orderstatus")).alias("x"))
    g = t.orders.filter("o_totalprice > 250000").groupBy(F.col("o_custkey").alias("firm_id")).agg(F.sort_array(F.collect_list(one)).alias("xs"))
    return g.select("firm_id", F.array_join(F.col("xs.x"), ",").alias("trail"))


@query("SELECT event_id, CASE event_type WHEN 'error' THEN -0.5::DOUBLE WHEN 'click' THEN -0.1::DOUBLE WHEN 'view' THEN 0.0::DOUBLE ELSE 0.3::DOUBLE END * CASE WHEN value > 50 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS impact, CASE WHEN value >= 95 THEN 'high' WHEN value >= 85 THEN 'medium' ELSE 'low' END AS confidence FROM events")
def evidence_impact(t):
    base = V.mapped(F.col("event_type"), {"error": -0.5, "click": -0.1, "view": 0.0}, 0.3)
    return t.events.select("event_id", (base * F.when(F.col("value") > 50, 0.5).otherwise(1.0)).alias("impact"), V.band(F.col("value"), [(95, "high"), (85, "medium")], "low").alias("confidence"))


@query("WITH d AS (SELECT user_id AS firm_id, CAST(ts AS DATE) AS day, count(*) AS n, avg(value) AS s FROM events GROUP BY 1, 2), l AS (SELECT *, lag(s, 4) OVER (PARTITION BY firm_id ORDER BY day) AS s4 FROM d) SELECT firm_id, day, round(s - s4, 5) AS trend, CASE WHEN s - s4 < -30 THEN 'falling' WHEN s - s4 < -15 THEN 'weak' WHEN s4 IS NULL THEN 'unknown' ELSE 'stable' END AS state FROM l")
def sentiment_trend(t):
    d = t.events.groupBy(F.col("user_id").alias("firm_id"), F.to_date("ts").alias("day")).agg(F.avg("value").alias("s"))
    x = d.withColumn("x", F.col("s") - F.lag("s", 4).over(Window.partitionBy("firm_id").orderBy("day")))
    return x.select("firm_id", "day", F.round("x", 5).alias("trend"), F.when(F.col("x") < -30, "falling").when(F.col("x") < -15, "weak").when(F.col("x").isNull(), "unknown").otherwise("stable").alias("state"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS period, CAST(floor(epoch(TIMESTAMP '2002-01-01' - o_orderdate) / 86400) AS BIGINT) AS age_days, o_orderdate < TIMESTAMP '2002-01-01' - INTERVAL 90 DAY AS stale FROM orders")
def staleness(t):
    as_of = F.lit("2002-01-01").cast("timestamp_ntz")
    return t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("period"), F.floor((F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("o_orderdate").cast("timestamp"))) / 86_400_000_000).alias("age_days"), (F.col("o_orderdate") < as_of - F.expr("INTERVAL 90 DAYS")).alias("stale"))
