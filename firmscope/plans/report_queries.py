"""Queries on records, the report's sections, news, links and confidences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscope.functions import extract as E
from firmscope.functions import pages as P
from firmscope.functions import payload as J
from firmscope.functions import rules as L
from firmscope.operators import links as K
from firmscope.operators import reports as O
from firmscope.plans.extract_queries import choose, when_in
from firmscope.plans.registry import Tables, query

_firm = "'f' || c_custkey AS firm_id, c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 'Brand ' || c_custkey WHEN c_custkey % 3 = 1 THEN '' END AS brand_name, 'https://f' || c_custkey || '.com' AS website_root, c_mktsegment AS model_type, CASE WHEN c_custkey % 4 = 0 THEN 'watchlist' ELSE 'candidate' END AS status, CAST(c_nationkey AS VARCHAR(9)) AS jurisdiction"
#: Datapoints of firms from orders: two of a key for some, blank payloads for others.
_point = f"o_orderkey AS id, 'f' || o_custkey AS firm_id, {choose('o_orderkey % 5', [*O.RULES_FROM, *O.PRICING_FROM, 'other'])} AS key, CASE o_orderkey % 4 WHEN 0 THEN '{{}}' WHEN 1 THEN '' ELSE '{{\"n\":' || o_orderkey || '}}' END AS value_json, CAST(floor(o_orderkey / 3) AS BIGINT) AS created_at".replace("{{", "{").replace("}}", "}")


@query(
    f"WITH f AS (SELECT {_firm} FROM customer), p AS (SELECT {_point} FROM orders), l AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY firm_id, key ORDER BY created_at DESC, id DESC) = 1), w AS (SELECT firm_id, "
    + ", ".join(f"any_value(nullif(nullif(value_json, ''), '{{}}')) FILTER (key = '{k}') AS k{i}" for i, k in enumerate((*O.RULES_FROM, *O.PRICING_FROM))).replace("{{}}", "{}")
    + " FROM l GROUP BY 1) SELECT f.firm_id, coalesce(nullif(brand_name, ''), name) AS name, website_root, model_type, status, jurisdiction, NULL::VARCHAR AS jurisdiction_tier, coalesce(k0, k1) AS rules, coalesce(k2, k3) AS pricing FROM f LEFT JOIN w USING (firm_id)"
)
def internal_snapshot(t):
    pick = lambda s: [x.strip() for x in _split(s)]
    return O.internal_records(t.customer.selectExpr(*pick(_firm)), t.orders.selectExpr(*pick(_point)))


def _split(s: str) -> list[str]:
    """A select list's entries: commas within quotes or parentheses don't part them."""
    out, depth, quoted, last = [], 0, False, 0
    for i, c in enumerate(s):
        quoted ^= c == "'"
        depth += (not quoted) * ((c == "(") - (c == ")"))
        if c == "," and not quoted and not depth:
            out.append(s[last:i])
            last = i + 1
    return [*out, s[last:]]


#: A suite for each brand of parts, with verdicts, alerts and metrics of its parts.
SUITES = ["coverage", "stability", "calibration", "ground_truth", "soft_signals", "agent_health"]
_suite = f"CASE WHEN CAST(substr(p_brand, 7) AS INT) <= 6 THEN {choose('CAST(substr(p_brand, 7) AS INT) - 1', SUITES)} ELSE 'suite ' || substr(p_brand, 7) END"
_metric = {"coverage_pct": "avg(p_size * 2.0)", "avg_na_rate": "avg(p_size * 1.0)", "major_changes": "count(*) FILTER (WHERE p_size > 40)", "top_10_turnover": "count(*) FILTER (WHERE p_size > 48)", "confidence_accuracy": "max(p_size) * 1.5", "score_skewness": "-min(p_retailprice) / 400"}
RESULTS = f"res AS (SELECT {_suite} AS suite, CASE WHEN min(p_partkey) % 4 > 0 THEN min(p_partkey) % 2 = 0 END AS passed, count(*) FILTER (p_size > 45) AS alert_count, " + ", ".join(f"round({m}, 2)::DOUBLE AS {k}" for k, m in _metric.items()) + " FROM part GROUP BY 1)"


def results(t: Tables) -> DataFrame:
    d = t.part.groupBy(F.expr(_suite).alias("suite")).agg(
        F.min("p_partkey").alias("k"), F.count(F.when(F.col("p_size") > 45, 1)).alias("n"), F.round(F.avg(F.col("p_size") * 2.0), 2).alias("coverage_pct"), F.round(F.avg(F.col("p_size") * 1.0), 2).alias("avg_na_rate"), F.count(F.when(F.col("p_size") > 40, 1)).cast("double").alias("major_changes"),
        F.count(F.when(F.col("p_size") > 48, 1)).cast("double").alias("top_10_turnover"), F.round(F.max("p_size") * 1.5, 2).alias("confidence_accuracy"), F.round(-F.min("p_retailprice") / 400, 2).alias("score_skewness"),
    )
    names = [x for k in _metric for x in (F.lit(k), F.col(k))]
    alerts = F.when(F.col("n") > 0, F.transform(F.sequence(F.lit(1), F.col("n").cast("int")), lambda i: F.concat(F.lit("alert "), i.cast("string")))).otherwise(F.array().cast("array<string>"))
    return d.select("suite", F.when(F.col("k") % 4 > 0, F.col("k") % 2 == 0).alias("passed"), alerts.alias("alerts"), F.create_map(*names).alias("metrics"))


@query(f"WITH {RESULTS}, a AS (SELECT count(*) AS total_tests, count(*) FILTER (passed) AS passed, count(*) FILTER (NOT passed) AS failed, sum(alert_count)::BIGINT AS total_alerts FROM res) SELECT total_tests, passed, failed, total_tests - passed - failed AS not_implemented, total_alerts, CASE WHEN failed <= 1 THEN 'GOOD' ELSE 'NEEDS_ATTENTION' END AS overall_health, passed || '/' || total_tests || ' validation tests passed; ' || total_alerts || ' alerts requiring attention; ' || (SELECT count(*) FROM customer) || ' firms monitored' AS key_findings FROM a")
def report_summary(t):
    return O.summary(results(t), F.lit(t.customer.count())).withColumn("key_findings", F.array_join("key_findings", "; "))


@query(f"WITH {RESULTS} SELECT suite, CASE WHEN passed THEN 'PASS' WHEN NOT passed THEN 'FAIL' ELSE 'NOT_RUN' END AS status, alert_count, CASE least(alert_count, 3) WHEN 0 THEN '' WHEN 1 THEN 'alert 1' WHEN 2 THEN 'alert 1,alert 2' ELSE 'alert 1,alert 2,alert 3' END AS top_alerts FROM res")
def report_verdicts(t):
    return O.verdicts(results(t)).withColumn("top_alerts", F.array_join("top_alerts", ","))


_num = lambda c: f"CASE WHEN {c} = floor({c}) THEN {c}::BIGINT::VARCHAR ELSE {c}::VARCHAR END"


@query(
    f"WITH {RESULTS} SELECT suite, coalesce(nullif(CASE suite WHEN 'coverage' THEN concat_ws('; ', CASE WHEN coverage_pct < 85 THEN 'Increase data coverage from ' || {_num('coverage_pct')} || '% to target 85%' END, CASE WHEN avg_na_rate > 25 THEN 'Reduce NA rate from ' || {_num('avg_na_rate')} || '% to below 25%' END)"
    f" WHEN 'stability' THEN concat_ws('; ', CASE WHEN major_changes > 5 THEN 'Investigate ' || {_num('major_changes')} || ' firms with major score changes' END, CASE WHEN top_10_turnover > 2 THEN 'High top-10 turnover (' || {_num('top_10_turnover')} || ') - review ranking stability' END)"
    f" ELSE concat_ws('; ', CASE WHEN confidence_accuracy < 80 THEN 'Improve confidence calibration (current: ' || {_num('confidence_accuracy')} || '%, target: >80%)' END, CASE WHEN abs(score_skewness) > 2 THEN 'Address score distribution skewness (' || printf('%.2f', abs(score_skewness)) || ')' END) END, ''),"
    f" CASE suite WHEN 'coverage' THEN '{O.FINE['coverage']}' WHEN 'stability' THEN '{O.FINE['stability']}' ELSE '{O.FINE['calibration']}' END) AS advice FROM res WHERE suite IN ('coverage', 'stability', 'calibration')"
)
def report_advice(t):
    return O.advice(results(t)).withColumn("advice", F.array_join("advice", "; "))


@query(f"WITH {RESULTS}, f AS (SELECT 'HIGH' AS priority, suite AS category, 'Address failures in ' || suite || ' validation test' AS recommendation, 'Critical for IOSCO compliance' AS impact FROM res WHERE NOT passed UNION ALL SELECT 'MEDIUM', suite, 'Review and address ' || alert_count || ' alerts', 'May affect data quality' FROM res WHERE alert_count > 5) SELECT * FROM f UNION ALL SELECT 'LOW', 'general', 'Continue current validation practices', 'Maintain high quality standards' WHERE NOT EXISTS (SELECT 1 FROM f)")
def report_recommendations(t):
    return O.recommendations(results(t))


@query("SELECT round_even(avg(coalesce(CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 61 / 1.0::DOUBLE END, 0)), 2) AS avg_na_rate, round_even(avg(coalesce(CASE WHEN c_custkey % 7 > 0 THEN c_acctbal END, 0)), 2) AS avg_score, count(*) FILTER (c_custkey % 4 = 0) AS high, count(*) FILTER (c_custkey % 4 = 1) AS medium, count(*) FILTER (c_custkey % 4 = 2) AS low, round_even(100 - avg(coalesce(CASE WHEN c_custkey % 5 > 0 THEN c_custkey % 61 / 1.0::DOUBLE END, 0)), 2) AS data_completeness FROM customer")
def report_quality(t):
    k = F.col("c_custkey")
    d = t.customer.select(F.when(k % 5 > 0, (k % 61).cast("double")).alias("na_rate"), F.when(k % 7 > 0, F.col("c_acctbal")).alias("score"), F.when(k % 4 == 0, "high").when(k % 4 == 1, "medium").when(k % 4 == 2, "low").alias("confidence"))
    return O.quality(d)


NEWS = ["Penalty for broker", "SECOND filing due", "Alert: fraud", "Investigation opened", "Licence revoked after violation", "Quarterly results", "Warning on clones", "Fine and enforcement"]
_title = f"event_type || ' ' || ({choose(f'event_id % {len(NEWS)}', NEWS)})"


@query(f"SELECT event_id, {when_in('lower(title)', E.NEWS_EVENTS, chr(39) + 'NEWS' + chr(39))} AS kind, {when_in('lower(concat_ws(chr(32), title, description))', E.NEWS_SEVERITIES, chr(39) + 'LOW' + chr(39))} AS severity FROM (SELECT event_id, {_title} AS title, CASE WHEN event_id % 3 = 0 THEN 'Suspended: ' || props WHEN event_id % 3 = 1 THEN props END AS description FROM events)")
def news_items(t):
    d = t.events.select("event_id", F.expr(_title).alias("title"), F.expr("CASE WHEN event_id % 3 = 0 THEN 'Suspended: ' || props WHEN event_id % 3 = 1 THEN props END").alias("description"))
    return d.select("event_id", E.news_event(F.col("title")).alias("kind"), E.news_severity(F.col("title"), F.col("description")).alias("severity"))


@query("WITH h AS (SELECT o_custkey AS id, list(round(0.5 + (o_orderkey % 50) / 100.0::DOUBLE, 2) ORDER BY o_orderkey) AS scores FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1), s AS (SELECT c_custkey AS id, coalesce(scores, []) AS scores FROM customer LEFT JOIN h ON h.id = c_custkey), t AS (SELECT *, CASE WHEN len(scores) = 0 THEN 'CLEAR' WHEN list_max(scores) >= 0.95 THEN 'SANCTIONED' ELSE 'REVIEW_REQUIRED' END AS status FROM s) SELECT id, CASE status WHEN 'CLEAR' THEN 0.95::DOUBLE WHEN 'SANCTIONED' THEN 0.99 ELSE round(list_avg(scores), 6) END AS sure, round(coalesce(list_avg(scores), 0), 6)::DOUBLE AS batch FROM t")
def screening_confidences(t):
    """The agent's and the batch report's confidence of a screening, from its matches' scores."""
    hits = t.orders.filter("o_orderkey % 3 = 0").groupBy(F.col("o_custkey").alias("id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("o_orderkey", F.round(0.5 + (F.col("o_orderkey") % 50) / 100, 2).alias("s")))), lambda x: x["s"]).alias("scores"))  # the matches of one screening
    d = t.customer.select(F.col("c_custkey").alias("id")).join(hits, "id", "left").withColumn("scores", F.coalesce("scores", F.array().cast("array<double>")))
    status = F.when(F.size("scores") == 0, "CLEAR").when(F.array_max("scores") >= 0.95, "SANCTIONED").otherwise("REVIEW_REQUIRED")
    return d.select("id", F.round(L.screening_confidence(status, F.col("scores")), 6).alias("sure"), F.round(F.coalesce(L.mean_of(F.col("scores")), F.lit(0.0)), 6).alias("batch"))


_paths = ["rules", "payout", "pricing", "fees", "about", "rules"]


@query(f"SELECT page_id, array_to_string(list_concat([url], list_transform({_paths[:5]}, lambda p: regexp_extract(url, '^[a-z]+://[^/?#]*') || '/' || p))[:4], ' ') AS urls FROM pages")
def page_candidates(t):
    return t.pages.select("page_id", F.array_join(P.candidates(F.col("url"), _paths, most=4), " ").alias("urls"))


@query(None)
def page_rule_links(t):
    """Links that speak of rules, then the usual paths; SQL has no parser for pages."""
    return K.rule_links(t.pages, "page_id", "url", "html")


@query("SELECT 'f' || c_custkey AS firm_id, c_name AS name, (c_custkey * 7919) % 997 AS updated_at FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') ORDER BY updated_at, firm_id LIMIT 50")
def crawl_queue(t):
    d = t.customer.select(F.concat(F.lit("f"), "c_custkey").alias("firm_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("status"), ((F.col("c_custkey") * 7919) % 997).alias("updated_at"))
    return O.crawl_queue(d, ["BUILDING", "MACHINERY"], 50).drop("status")


@query("SELECT o_orderkey AS id, '{\"id\":' || o_orderkey || ',\"total\":\"' || CAST(o_totalprice AS DECIMAL(12,2)) || '\",\"at\":\"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '\",\"status\":' || CASE WHEN o_orderstatus = 'F' THEN 'null' ELSE '\"' || o_orderstatus || '\"' END || '}' AS json FROM orders")
def audit_rows(t):
    d = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("decimal(12,2)").alias("total"), F.date_trunc("second", "o_orderdate").alias("at"), F.when(F.col("o_orderstatus") != "F", F.col("o_orderstatus")).alias("status"))
    return d.select("id", J.audit_json(d.schema).alias("json"))
