"""Validation suites of snapshots, each one row of metrics, and the alerts that metrics raise.

Tables: scores (firm_id, score, na_rate as a share, confidence, pillar_scores), records (scores with jurisdiction_tier,
na_rate_pct), events (event_id, firm_id, firm_name, event_date, event_type, severity), signals (firm_id, source,
sentiment, date). Where a value is missing each suite has a default of its own, which is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmscope.functions import rules as L
from firmscope.operators import relational as R
from firmscope.operators.tables import kept

# Event types that speak against a firm, and the limits of alerts.
NEGATIVE = ["regulatory_action", "license_revoked", "fraud", "payout_failure"]
ALERTS = [
    ("NA_SPIKE", "avg_na_rate", "above", 25.0, "warning"),
    ("COVERAGE_DROP", "coverage_percent", "below", 70.0, "critical"),
    ("FAIL_RATE_UP", "agent_c_pass_rate", "below", 80.0, "warning"),
    ("TURNOVER_SPIKE", "top_10_turnover", "above", 5.0, "warning"),
    ("FALLBACK_USAGE_HIGH", "fallback_usage_percent", "above", 35.0, "warning"),
    ("STABILITY_SCORE_LOW", "stability_score", "below", 70.0, "warning"),
    ("MODEL_TYPE_BIAS", "model_type_bias_score", "above", 15.0, "warning"),
    ("EVIDENCE_LINKAGE_LOW", "evidence_linkage_rate", "below", 70.0, "warning"),
]


def pct(part: Column, whole: Column) -> Column:
    """100 part / whole rounded to 2 places; 0 for an empty whole."""
    return F.round(F.coalesce(F.try_divide(part.cast("double") * 100, whole.cast("double")), F.lit(0.0)), 2)


def many(c: Column) -> Column:
    return F.count_if(F.coalesce(c, F.lit(False)))


def coverage(scores: DataFrame, audit: DataFrame) -> DataFrame:
    """total_firms, coverage_percent (with a score), avg_na_rate (percent), agent_c_pass_rate."""
    firms = F.count_distinct("firm_id")
    a = scores.agg(firms.alias("total_firms"), pct(F.count_distinct(F.when(F.col("score").isNotNull(), F.col("firm_id"))), firms).alias("coverage_percent"), F.round(F.coalesce(F.avg("na_rate") * 100, F.lit(0.0)), 2).alias("avg_na_rate"))
    return a.crossJoin(F.broadcast(audit.agg(pct(many(F.col("verdict") == "pass"), F.count("*")).alias("agent_c_pass_rate"))))  # one row each


def stability(current: DataFrame, previous: DataFrame, verdicts: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """avg_score_change, top 10 and 20: firms that entered and that left, and verdict_churn_rate of firms in both."""
    both = current.select("firm_id", F.col("score").alias("s")).join(previous.select("firm_id", F.col("score").alias("p")), "firm_id")
    out = both.agg(F.round(F.coalesce(F.avg(F.abs(F.col("s") - F.col("p"))), F.lit(0.0)), 4).alias("avg_score_change"))
    for k in (10, 20):
        top = lambda d: d.orderBy(F.desc_nulls_last("score"), "firm_id").limit(k).select("firm_id")  # noqa: E731, B023
        now, then = top(current), top(previous)
        n = now.withColumn("now", F.lit(1)).join(then.withColumn("then", F.lit(1)), "firm_id", "full_outer").agg(many(F.col("then").isNull()).alias(f"top_{k}_turnover"), many(F.col("now").isNull()).alias(f"top_{k}_left"))
        out = out.crossJoin(F.broadcast(n))  # one row each
    if verdicts is not None:
        a, b = (v.select("firm_id", F.col("verdict").alias(n)) for v, n in zip(verdicts, "ab", strict=True))
        out = out.crossJoin(F.broadcast(a.join(b, "firm_id").agg(pct(many(F.col("a") != F.col("b")), F.count("*")).alias("verdict_churn_rate"))))
    return out


def ground_truth(events: DataFrame, scores: DataFrame, firms: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """events_in_period, events_predicted (a firm in trouble has the event's firm_id, or, without one, its name) and prediction_precision."""
    inside = events.filter(F.col("event_date").between(as_of - F.make_dt_interval(F.lit(days)), as_of))
    weak = scores.filter((F.col("na_rate") > 0.5) | (F.col("score") < 40)).select("firm_id").distinct()
    by_id = inside.filter("firm_id is not null").join(weak, "firm_id", "left_semi").select("event_id")
    named = firms.join(weak, "firm_id", "left_semi").select(F.col("brand_name").alias("firm_name")).distinct()
    by_name = inside.filter("firm_id is null and firm_name is not null").join(named, "firm_name", "left_semi").select("event_id")
    seen = by_id.unionByName(by_name).agg(F.count("*").alias("events_predicted"))
    return inside.agg(F.count("*").alias("events_in_period")).crossJoin(F.broadcast(seen)).withColumn("prediction_precision", pct(F.col("events_predicted"), F.col("events_in_period")))


def sensitivity(scores: DataFrame, weights: dict[str, float], neutral: float = 0.5) -> DataFrame:
    """pillar_sensitivity_mean (change of the score without one pillar), fallback_usage_percent (pillars at the neutral score) and stability_score."""
    w = F.create_map(*(F.lit(x) for kv in weights.items() for x in kv))
    rows = scores.filter("score is not null").select("firm_id", "score", F.explode("pillar_scores").alias("pillar", "p")).withColumn("w", F.coalesce(F.try_element_at(w, F.col("pillar")), F.lit(0.0)))
    firm = Window.partitionBy("firm_id")
    d = rows.withColumns({"tw": F.sum("w").over(firm), "ts": F.sum(F.col("w") * F.col("p")).over(firm)}).filter("tw > 0")
    rest = F.col("tw") - F.col("w")
    shift = F.when((F.col("w") > 0) & (rest > 1e-12), F.abs(F.try_divide(100 * (F.col("ts") - F.col("w") * F.col("p")), rest) - F.col("score")))
    a = d.agg(F.coalesce(F.avg(shift), F.lit(0.0)).alias("m"), F.coalesce(F.try_divide(many(F.col("p") == neutral) * 100.0, F.count("*")), F.lit(0.0)).alias("f"))
    return a.select(F.round("m", 4).alias("pillar_sensitivity_mean"), F.round("f", 2).alias("fallback_usage_percent"), F.round(L.stability_score(F.col("m"), F.col("f")), 2).alias("stability_score"))


def bias(scores: DataFrame, firms: DataFrame) -> DataFrame:
    """score_distribution_skew (of a sample) and model_type_bias_score (range of the model types' mean scores; 0 for fewer than two)."""
    d = scores.filter("score is not null").join(firms.select("firm_id", "model_type"), "firm_id")
    means = d.filter(F.coalesce("model_type", F.lit("")) != "").groupBy("model_type").agg(F.avg("score").alias("m"))
    gap = means.agg(F.round(F.when(F.count("*") >= 2, F.max("m") - F.min("m")).otherwise(0.0), 2).alias("model_type_bias_score"))
    return d.agg(F.round(F.coalesce(R.sample_skewness("score"), F.lit(0.0)), 4).alias("score_distribution_skew")).crossJoin(F.broadcast(gap))


def auditability(scores: DataFrame, datapoints: DataFrame, evidence: DataFrame) -> DataFrame:
    """evidence_linkage_rate (firms with a sourced datapoint or piece of evidence) and version_metadata (the commonest version, the first of equals)."""
    firms = scores.select("firm_id").distinct()
    sourced = datapoints.filter("source_url is not null or evidence_hash is not null").select("firm_id").unionByName(evidence.filter("source_url is not null or sha256 is not null").select("firm_id"))
    linked = firms.join(sourced, "firm_id", "left_semi").agg(F.count("*").alias("linked"))
    version = scores.groupBy("version_key").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "version_key").limit(1).select(F.col("version_key").alias("version_metadata"))
    a = firms.agg(F.count("*").alias("n")).crossJoin(F.broadcast(linked)).select(pct(F.col("linked"), F.col("n")).alias("evidence_linkage_rate"))
    return a.join(F.broadcast(version), F.lit(True), "left")


def alerts(metrics: DataFrame, rules: list[tuple[str, str, str, float, str]] = ALERTS) -> DataFrame:
    """alert_type, severity, metric_name, current_value, threshold_value of each limit that a row of metrics breaks. Missing metrics raise none."""
    rows = [F.struct(F.lit(t).alias("alert_type"), F.lit(s).alias("severity"), F.lit(m).alias("metric_name"), F.col(m).cast("double").alias("current_value"), F.lit(x).alias("threshold_value"), F.lit(side).alias("side")) for t, m, side, x, s in rules if m in metrics.columns]
    d = metrics.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return d.filter("(side = 'above' and current_value > threshold_value) or (side = 'below' and current_value < threshold_value)").drop("side")


def recent_alerts(log: DataFrame, limit: int = 10) -> DataFrame:
    """The newest open alerts, of equal times by type and then by the log's other columns, so that a cut among ties is always the same."""
    rest = [c for c in log.columns if c not in ("created_at", "alert_type", "resolved_at")]
    return log.filter("resolved_at is null").orderBy(F.desc("created_at"), "alert_type", *rest).limit(limit)


# suites over one snapshot's records


def record_coverage(records: DataFrame) -> DataFrame:
    """coverage_percent, avg_na_rate, agent_c_pass_rate (na_rate_pct up to 75), high_na_firms (over 40), four bands of the rate, completeness of three fields, passed."""
    na, n = F.coalesce("na_rate_pct", F.lit(0.0)), F.count("*")
    avg = F.coalesce(F.avg(na), F.lit(100.0))
    full = lambda c: pct(many(F.coalesce(F.col(c).cast("string"), F.lit("")) != ""), n)
    d = records.agg(
        F.round(100 - avg, 2).alias("coverage_percent"), F.round(avg, 2).alias("avg_na_rate"), pct(many(F.coalesce("na_rate_pct", F.lit(100.0)) <= 75), n).alias("agent_c_pass_rate"), many(na > 40).alias("high_na_firms"),
        many(na <= 10).alias("na_0_10"), many((na > 10) & (na <= 25)).alias("na_11_25"), many((na > 25) & (na <= 40)).alias("na_26_40"), many(na > 40).alias("na_over_40"),
        full("score").alias("score_full"), full("jurisdiction_tier").alias("tier_full"), full("confidence").alias("confidence_full"),
    )
    return d.withColumn("passed", (F.col("coverage_percent") > 85) & (F.col("avg_na_rate") < 25) & (F.col("agent_c_pass_rate") > 75))


def tier_coverage(records: DataFrame) -> DataFrame:
    """jurisdiction_tier (UNKNOWN for none), count, avg_na_rate, coverage_percent."""
    tier = F.coalesce("jurisdiction_tier", F.lit("UNKNOWN"))
    g = records.groupBy(tier.alias("jurisdiction_tier")).agg(F.count("*").alias("count"), F.round(F.avg(F.coalesce("na_rate_pct", F.lit(0.0))), 2).alias("avg_na_rate"))
    return g.withColumn("coverage_percent", F.round(100 - F.col("avg_na_rate"), 2))


def record_stability(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Mean, upper median and largest change of scores (missing ones 0), firms changed by over 10, firms that left the top 10 and 20, passed."""
    zero = lambda d: kept(d.select("firm_id", F.coalesce("score", F.lit(0.0)).alias("score")))  # noqa: E731  eight steps read them
    c, p = zero(current), zero(previous)
    change = F.abs(F.col("score") - F.col("before"))
    both = kept(c.join(p.withColumnRenamed("score", "before"), "firm_id").select(change.alias("change")))
    out = both.agg(F.round(F.avg("change"), 4).alias("avg_score_change"), F.round(F.max("change"), 4).alias("max_score_change"), many(F.col("change") > 10).alias("firms_with_major_changes"))
    median = R.nth_smallest(both, "change", F.floor(F.col("n") / 2)).select(F.round("change", 4).alias("median_score_change"))
    out = out.join(F.broadcast(median), F.lit(True), "left").crossJoin(F.broadcast(c.agg(F.count("*").alias("firms"))))
    for k in (10, 20):
        top = lambda d: d.orderBy(F.desc("score"), "firm_id").limit(k).select("firm_id")  # noqa: E731, B023
        out = out.crossJoin(F.broadcast(top(p).join(top(c), "firm_id", "left_anti").agg(F.count("*").alias(f"top_{k}_turnover"))))  # one row each
    passed = (F.col("avg_score_change") < 0.05) & (F.col("top_10_turnover") <= 2) & (F.col("top_20_turnover") <= 4) & (F.col("firms_with_major_changes") < 0.05 * F.col("firms"))
    return out.withColumn("passed", F.coalesce(passed, F.lit(False)))


def confidence_calibration(records: DataFrame) -> DataFrame:
    """confidence (high, medium, low; others count as medium), count, avg_na_rate, avg_score and accuracy: firms under 15 % of missing values."""
    kind = F.when(F.col("confidence").isin("high", "low"), F.col("confidence")).otherwise("medium")
    na = F.coalesce("na_rate_pct", F.lit(0.0))
    return records.groupBy(kind.alias("confidence")).agg(F.count("*").alias("count"), F.round(F.avg(na), 2).alias("avg_na_rate"), F.round(F.avg(F.coalesce("score", F.lit(0.0))), 2).alias("avg_score"), pct(many(F.coalesce("na_rate_pct", F.lit(100.0)) < 15), F.count("*")).alias("accuracy"))


def tier_bias(records: DataFrame, spread: float = 1.5) -> DataFrame:
    """jurisdiction_tier, count, avg_score, std_dev and outlier: its mean is over `spread` deviations of the tiers' means off their mean."""
    score = F.coalesce("score", F.lit(0.0))
    g = records.groupBy(F.coalesce("jurisdiction_tier", F.lit("UNKNOWN")).alias("jurisdiction_tier")).agg(F.count("*").alias("count"), F.round(F.avg(score), 2).alias("avg_score"), F.round(F.stddev_pop(score), 2).alias("std_dev"))
    a = g.agg(F.avg("avg_score").alias("gm"), F.stddev_pop("avg_score").alias("gs"))
    return g.crossJoin(F.broadcast(a)).withColumn("outlier", F.abs(F.col("avg_score") - F.col("gm")) > spread * F.col("gs")).drop("gm", "gs")  # a is one row


def score_distribution(records: DataFrame) -> DataFrame:
    """score_mean, score_std_dev, score_skewness (of all firms), five bands, and clustered: over two of the bands are empty."""
    s = F.coalesce("score", F.lit(0.0))
    edges = [(None, 20), (20, 40), (40, 60), (60, 80), (80, None)]
    band = lambda lo, hi: many((F.lit(True) if lo is None else s > lo) & (F.lit(True) if hi is None else s <= hi))
    d = records.agg(F.round(F.avg(s), 2).alias("score_mean"), F.round(F.stddev_pop(s), 2).alias("score_std_dev"), F.round(F.when(F.stddev_pop(s) > 0, F.skewness(s)).otherwise(0.0), 4).alias("score_skewness"), *(band(lo, hi).alias(f"upto_{hi or 100}") for lo, hi in edges))
    empty = sum((F.when(F.col(f"upto_{hi or 100}") == 0, 1).otherwise(0) for _, hi in edges), F.lit(0))
    return d.withColumn("clustered", empty > 2)


def days_since(as_of: Column, day: Column) -> Column:
    """Whole days of elapsed time between two timestamps, rounded down."""
    return F.floor((F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(day.cast("timestamp"))) / 86_400_000_000).cast("int")


def event_truth(events: DataFrame, records: DataFrame, as_of: Column) -> DataFrame:
    """Events against scores: detection, responsiveness (30 days), severity alignment, false_negatives, timeliness. Missing scores count 50."""
    r = records.select("firm_id", F.coalesce("score", F.lit(50.0)).alias("s"), "confidence", F.lit(True).alias("known"))
    e = events.join(r, "firm_id", "left").withColumns({"known": F.coalesce("known", F.lit(False)), "neg": F.coalesce(F.col("event_type").isin(NEGATIVE), F.lit(False)), "age": days_since(as_of, F.col("event_date")), "sev": F.coalesce("severity", F.lit("medium"))})
    known, neg, s, sev = F.col("known"), F.col("neg"), F.col("s"), F.col("sev")
    own, fits = F.col("firm_id").isNotNull(), F.when(F.col("neg"), F.col("s") < 50).otherwise(F.col("s") >= 50)
    hit = known & ((neg & (s < 40)) | (F.col("confidence") == "low"))
    recent, week, older = F.col("age").between(0, 30), F.col("age").between(0, 7), F.col("age") > 7
    timely, late = many(week & known & fits), many((week | older) & known & ~fits)
    return e.agg(
        many(own & hit).alias("events_detected"), many(own & ~F.coalesce(hit, F.lit(False))).alias("events_missed"), pct(many(own & hit), many(own)).alias("event_detection_rate"),
        many(recent).alias("recent_events"), pct(many(recent & known & fits), many(recent)).alias("score_responsiveness_rate"),
        pct(many(known & neg & (sev == "high") & (s < 30)), many(known & neg & (sev == "high"))).alias("high_alignment"), pct(many(known & neg & (sev == "medium") & s.between(30, 59.999999)), many(known & neg & (sev == "medium"))).alias("medium_alignment"),
        many((F.col("severity") == "high") & (~known | (neg & (s >= 40)))).alias("false_negatives"), pct(timely, timely + late).alias("timeliness_rate"),
    )


def soft_signals(signals: DataFrame, records: DataFrame, as_of: Column) -> DataFrame:
    """Sentiment signals against scores: counts, correlation, early warnings (1 to 30 days before), false positives, firms of several sources, passed."""
    r = records.select("firm_id", F.coalesce("score", F.lit(50.0)).alias("s"))
    d = signals.join(r, "firm_id", "left").withColumns({"age": days_since(as_of, F.col("date")), "m": F.coalesce("sentiment", F.lit("neutral"))})
    s, bad, good = F.col("s"), F.col("m") == "negative", F.col("m") == "positive"
    fits = (bad & (s < 50)) | (good & (s >= 50))
    early = bad & F.col("age").between(1, 30) & s.isNotNull()
    a = d.agg(
        F.count("*").alias("total_signals"), many(bad).alias("negative_signals"), many(good).alias("positive_signals"), many(F.col("m") == "neutral").alias("neutral_signals"), F.count_distinct("firm_id").alias("firms_with_signals"),
        pct(many(s.isNotNull() & fits), many(s.isNotNull() & (bad | good))).alias("correlation_accuracy"), many(early).alias("early_warnings"), pct(many(early & (s < 50)), many(early)).alias("early_warning_accuracy"),
        many(bad & (s >= 70)).alias("false_positives"), pct(many(bad & (s >= 70)), many(bad & s.isNotNull())).alias("false_positive_rate"),
    )
    sources = signals.filter("firm_id is not null").groupBy("firm_id").agg(F.count_distinct(F.coalesce("source", F.lit(""))).alias("k"))
    several = sources.agg(pct(many(F.col("k") > 1), F.count("*")).alias("multi_source_validation_rate"))
    return a.crossJoin(F.broadcast(several)).withColumn("passed", (F.col("correlation_accuracy") > 85) & (F.col("false_positive_rate") < 5) & (F.col("early_warning_accuracy") > 70))


def agent_health(logs: DataFrame, expected: list[str], as_of: Column) -> DataFrame:
    """One row for each expected or seen agent: runs, failures, failure_rate, avg_age_hours, hours_inactive, avg_quality, state.

    logs: agent, ts, status, quality_score. State: missing, inactive (over 24 hours), failing (over 5 %), stale (48 hours
    old on average), low_quality (under 70), or ok: the first that applies.
    """
    hours = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 3_600_000_000
    seen = logs.filter("agent is not null").groupBy("agent").agg(F.count("*").alias("runs"), many(F.col("status").isin("failure", "error", "failed")).alias("failures"), F.avg(hours).alias("age"), F.min(hours).alias("idle"), F.avg("quality_score").alias("q"))
    want = logs.sparkSession.createDataFrame([(x,) for x in expected], "agent string")
    d = want.join(seen, "agent", "full_outer")
    rate = F.try_divide(F.col("failures") * 100.0, F.col("runs"))
    state = F.when(F.col("runs").isNull(), "missing").when(F.col("idle") > 24, "inactive").when(rate > 5, "failing").when(F.col("age") > 48, "stale").when(F.col("q") < 70, "low_quality").otherwise("ok")
    return d.select("agent", F.coalesce("runs", F.lit(0)).alias("runs"), F.coalesce("failures", F.lit(0)).alias("failures"), F.round(rate, 2).alias("failure_rate"), F.round("age", 1).alias("avg_age_hours"), F.round("idle", 1).alias("hours_inactive"), F.round("q", 1).alias("avg_quality"), state.alias("state"))


def report(**suites: DataFrame) -> DataFrame:
    """suite, metric, value (text) of one-row suites, under each other; `passed` is a metric like the others."""
    out = None
    for name, d in suites.items():
        rows = d.select(*(F.col(c).cast("string").alias(c) for c in d.columns)).unpivot([], d.columns, "metric", "value").select(F.lit(name).alias("suite"), "metric", "value")
        out = rows if out is None else out.unionByName(rows)
    return out


def markdown(rows: DataFrame) -> str:
    """The report as Markdown: a heading for each suite and a line for each metric. It has as many rows as there are metrics."""
    lines, last = ["# Validation report"], None
    for r in rows.orderBy("suite", "metric").toLocalIterator():
        if r["suite"] != last:
            lines += ["", f"## {r['suite']}", ""]
            last = r["suite"]
        lines.append(f"- {r['metric']}: {r['value']}")
    return "\n".join(lines) + "\n"
