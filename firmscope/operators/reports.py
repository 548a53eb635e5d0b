"""Snapshots of firms as nested records, and the transparency report: summary, sections' verdicts, advice, and its text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmscope.operators import relational as R
from firmscope.operators.scoring import or_else

# Datapoints of a record by choice, limits of the sections' advice, and their texts.
RULES_FROM, PRICING_FROM = ("rules_extracted_v0", "rules_extracted_from_home_v0"), ("pricing_extracted_v0", "pricing_extracted_from_home_v0")
FIRM_FIELDS = ["name", "brand_name", "website_root", "model_type", "status", "jurisdiction", "jurisdiction_tier"]
FINE = {"coverage": "Coverage metrics meet targets - maintain current data collection", "stability": "Scores stable - no action required", "calibration": "Calibration metrics acceptable"}
MANY_ALERTS = 5


def internal_records(firms: DataFrame, datapoints: DataFrame) -> DataFrame:
    """firm_id, name, website_root, model_type, status, jurisdiction, jurisdiction_tier, rules, pricing of every firm.

    name is the brand's, else the firm's. rules and pricing are the payloads of the newest datapoint (created_at, id) of
    the first key that has one that isn't blank; only the four keys are read, and each firm's rows are cut to one a key
    before they meet. Columns that firms lacks are null; firms without datapoints have null payloads.
    """
    has = lambda c: F.col(c) if c in firms.columns else F.lit(None).cast("string")
    d = firms.select("firm_id", or_else(has("brand_name"), has("name")).alias("name"), *(has(c).alias(c) for c in FIRM_FIELDS[2:]))
    keys = [*RULES_FROM, *PRICING_FROM]
    new = R.latest_by(datapoints.filter(F.col("key").isin(keys)), ["firm_id", "key"], "created_at", "id")
    wide = new.groupBy("firm_id").agg(*(F.max(F.when(F.col("key") == k, F.col("value_json"))).alias(k) for k in keys))
    first = lambda names: or_else(*(F.nullif(F.col(n), F.lit("{}")) for n in names))
    return d.join(wide, "firm_id", "left").select(*d.columns, first(RULES_FROM).alias("rules"), first(PRICING_FROM).alias("pricing"))


def snapshot_meta(records: DataFrame, version: str, generated_at: str) -> DataFrame:
    """One row: snapshot_version, generated_at_utc, count."""
    return records.agg(F.count("*").alias("count")).select(F.lit(version).alias("snapshot_version"), F.lit(generated_at).alias("generated_at_utc"), "count")


def quality(records: DataFrame) -> DataFrame:
    """One row: avg_na_rate, avg_score (missing values count 0), high, medium, low (firms of each confidence), data_completeness; no rows without records."""
    avg = lambda c: F.avg(F.coalesce(c, F.lit(0.0)))
    n = lambda v: F.count(F.when(F.col("confidence") == v, 1)).alias(v)
    a = records.agg(F.count("*").alias("n"), avg("na_rate").alias("na"), avg("score").alias("s"), n("high"), n("medium"), n("low")).filter("n > 0")
    return a.select(F.bround("na", 2).alias("avg_na_rate"), F.bround("s", 2).alias("avg_score"), "high", "medium", "low", F.bround(100 - F.col("na"), 2).alias("data_completeness"))


def summary(results: DataFrame, firms: Column) -> DataFrame:
    """One row of results (suite, passed, alerts): total_tests, passed, failed, not_implemented (passed is null), total_alerts, overall_health, key_findings."""
    n = lambda c: F.count(F.when(c, 1))
    a = results.agg(F.count("*").alias("total_tests"), n(F.col("passed")).alias("passed"), n(~F.col("passed")).alias("failed"), F.coalesce(F.sum(F.size("alerts")), F.lit(0)).alias("total_alerts"))
    text = lambda *parts: F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    s = lambda c: F.col(c).cast("string")
    findings = F.array(text(s("passed"), "/", s("total_tests"), " validation tests passed"), text(s("total_alerts"), " alerts requiring attention"), text(firms.cast("string"), " firms monitored"))
    return a.select("total_tests", "passed", "failed", (F.col("total_tests") - F.col("passed") - F.col("failed")).alias("not_implemented"), "total_alerts", F.when(F.col("failed") <= 1, "GOOD").otherwise("NEEDS_ATTENTION").alias("overall_health"), findings.alias("key_findings"))


def verdicts(results: DataFrame) -> DataFrame:
    """suite, status (PASS, FAIL, NOT_RUN), alert_count and top_alerts (three at most) of every suite."""
    return results.select("suite", F.when(F.col("passed"), "PASS").when(~F.col("passed"), "FAIL").otherwise("NOT_RUN").alias("status"), F.size("alerts").alias("alert_count"), F.slice("alerts", 1, 3).alias("top_alerts"))


def advice(results: DataFrame) -> DataFrame:
    """suite and advice (array) of the coverage, stability and calibration suites, from their metrics (map of numbers; a missing one is 0)."""
    m = lambda k: F.coalesce(F.try_element_at("metrics", F.lit(k)), F.lit(0.0))
    number = lambda c: F.when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))
    text = lambda *parts: F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    skew = F.abs(m("score_skewness"))
    of = {
        "coverage": [F.when(m("coverage_pct") < 85, text("Increase data coverage from ", number(m("coverage_pct")), "% to target 85%")), F.when(m("avg_na_rate") > 25, text("Reduce NA rate from ", number(m("avg_na_rate")), "% to below 25%"))],
        "stability": [F.when(m("major_changes") > 5, text("Investigate ", number(m("major_changes")), " firms with major score changes")), F.when(m("top_10_turnover") > 2, text("High top-10 turnover (", number(m("top_10_turnover")), ") - review ranking stability"))],
        "calibration": [F.when(m("confidence_accuracy") < 80, text("Improve confidence calibration (current: ", number(m("confidence_accuracy")), "%, target: >80%)")), F.when(skew > 2, text("Address score distribution skewness (", F.format_string("%.2f", skew), ")"))],
    }
    out = F.lit(None).cast("array<string>")
    for name, lines in of.items():
        said = F.array_compact(F.array(*lines))
        out = F.when(F.col("suite") == name, F.when(F.size(said) > 0, said).otherwise(F.array(F.lit(FINE[name])))).otherwise(out)
    return results.select("suite", out.alias("advice")).filter("advice IS NOT NULL")


def recommendations(results: DataFrame) -> DataFrame:
    """priority, category, recommendation, impact: HIGH for each failed suite, MEDIUM for each with more than MANY_ALERTS alerts; one LOW row if there is neither."""
    failed = results.filter("NOT passed").select(F.lit("HIGH").alias("priority"), F.col("suite").alias("category"), F.concat(F.lit("Address failures in "), "suite", F.lit(" validation test")).alias("recommendation"), F.lit("Critical for IOSCO compliance").alias("impact"))
    noisy = results.filter(F.size("alerts") > MANY_ALERTS).select(F.lit("MEDIUM").alias("priority"), F.col("suite").alias("category"), F.concat(F.lit("Review and address "), F.size("alerts").cast("string"), F.lit(" alerts")).alias("recommendation"), F.lit("May affect data quality").alias("impact"))
    found = failed.unionByName(noisy)
    none = found.agg(F.count("*").alias("n")).filter("n = 0").select(F.lit("LOW").alias("priority"), F.lit("general").alias("category"), F.lit("Continue current validation practices").alias("recommendation"), F.lit("Maintain high quality standards").alias("impact"))
    return found.unionByName(none)


def transparency_report(results: DataFrame, records: DataFrame, period: str, firms: int) -> str:
    """The report as Markdown. results has a row for each suite, records any number; the driver sees the suites' rows and sums."""
    s = summary(results, F.lit(firms)).first()
    lines = ["# Monthly Transparency Report", "", f"This report covers validation testing for {firms} firms for {period}.", "", "## Summary", "", f"- Overall health: {s['overall_health']}", f"- Tests: {s['passed']} passed, {s['failed']} failed, {s['not_implemented']} not run"]
    lines += [f"- {x}" for x in s["key_findings"]] + ["", "## Results", ""]
    lines += [f"- {r['suite']}: {r['status']} ({r['alert_count']} alerts)" for r in verdicts(results).orderBy("suite").collect()]  # a row for each suite
    lines += ["", "## Data quality", ""] + [f"- {k}: {v}" for r in quality(records).collect() for k, v in r.asDict().items()]
    lines += ["", "## Advice", ""] + [f"- {r['suite']}: {x}" for r in advice(results).orderBy("suite").collect() for x in r["advice"]]
    lines += ["", "## Recommendations", ""] + [f"- {r['priority']} ({r['category']}): {r['recommendation']}" for r in recommendations(results).orderBy("priority", "category").collect()]
    return "\n".join(lines) + "\n"


def active_spec(versions: DataFrame) -> DataFrame:
    """version_key and spec (JSON text) of the active scoring version: its data dictionary with weights, hierarchy and version_key, which win over entries of these names."""
    entry = lambda c: F.from_json(F.coalesce(c, F.lit("{}")), "map<string,variant>")
    own = F.map_filter(entry("data_dictionary"), lambda k, v: ~k.isin("weights", "hierarchy", "version_key"))
    made = F.create_map(F.lit("weights"), F.parse_json(F.coalesce("weights", F.lit("{}"))), F.lit("hierarchy"), F.parse_json(F.coalesce("hierarchy", F.lit("{}"))), F.lit("version_key"), F.parse_json(F.concat(F.lit('"'), F.replace(F.replace("version_key", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))))
    return versions.filter("is_active").select("version_key", F.to_json(F.map_concat(own, made)).alias("spec"))


def crawl_queue(firms: DataFrame, statuses: list[str], limit: int) -> DataFrame:
    """The `limit` firms of these statuses that were updated longest ago, never updated ones last, of equal ones the least id; limit is the feature."""
    return firms.filter(F.col("status").isin(statuses)).orderBy(F.col("updated_at").asc_nulls_last(), "firm_id").limit(limit)
