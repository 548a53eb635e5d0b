"""The report's text, records, the active specification, links and audit rows on hand cases."""

import json

from pyspark.sql import functions as F

from firmscope.functions import extract as E
from firmscope.functions import payload as J
from firmscope.functions import rules as L
from firmscope.operators import links as K
from firmscope.operators import reports as O

SUITES = [("coverage", True, [], {"coverage_pct": 80.0, "avg_na_rate": 30.5}), ("stability", False, [f"a{i}" for i in range(6)], {"major_changes": 2.0}), ("calibration", None, ["x"], {"confidence_accuracy": 90.0, "score_skewness": -2.345})]
REPORT = """# Monthly Transparency Report

This report covers validation testing for 3 firms for May 2026.

## Summary

- Overall health: GOOD
- Tests: 1 passed, 1 failed, 1 not run
- 1/3 validation tests passed
- 7 alerts requiring attention
- 3 firms monitored

## Results

- calibration: NOT_RUN (1 alerts)
- coverage: PASS (0 alerts)
- stability: FAIL (6 alerts)

## Data quality

- avg_na_rate: 10.0
- avg_score: 40.0
- high: 1
- medium: 0
- low: 1
- data_completeness: 90.0

## Advice

- calibration: Address score distribution skewness (2.35)
- coverage: Increase data coverage from 80% to target 85%
- coverage: Reduce NA rate from 30.5% to below 25%
- stability: Scores stable - no action required

## Recommendations

- HIGH (stability): Address failures in stability validation test
- MEDIUM (stability): Review and address 6 alerts
"""


def test_transparency_report(spark):
    d = spark.createDataFrame(SUITES, "suite string, passed boolean, alerts array<string>, metrics map<string,double>")
    records = spark.createDataFrame([(30.0, 50.0, "high"), (None, 70.0, "low"), (0.0, None, None)], "na_rate double, score double, confidence string")
    assert O.transparency_report(d, records, "May 2026", 3) == REPORT.replace("(2.35)", f"({2.345:.2f})")
    none = d.filter("suite = 'coverage'")
    assert [tuple(r)[:2] for r in O.recommendations(none).collect()] == [("LOW", "general")] and O.quality(records.limit(0)).collect() == []
    assert O.summary(d.limit(0), F.lit(0)).first()["overall_health"] == "GOOD"


def test_records(spark):
    firms = spark.createDataFrame([("a", "A", ""), ("b", None, "B"), ("c", "C", None)], "firm_id string, name string, brand_name string")
    points = [(1, "a", "rules_extracted_v0", '{"x":1}', 1), (2, "a", "rules_extracted_v0", "", 2), (3, "a", "rules_extracted_from_home_v0", '{"y":1}', 0), (4, "b", "pricing_extracted_from_home_v0", '{"p":1}', 5), (5, "b", "pricing_extracted_v0", "{}", 9), (6, "b", "other", "{}", 9)]
    d = O.internal_records(firms, spark.createDataFrame(points, "id long, firm_id string, key string, value_json string, created_at long"))
    assert {(r["firm_id"], r["name"], r["rules"], r["pricing"], r["status"]) for r in d.collect()} == {("a", "A", '{"y":1}', None, None), ("b", "B", None, '{"p":1}', None), ("c", "C", None, None, None)}
    assert tuple(O.snapshot_meta(d, "v0", "now").first()) == ("v0", "now", 3)


def test_active_spec(spark):
    rows = [('v"1', '{"a":[1,2],"weights":"old"}', '{"p":0.5}', None, True), ("v2", "{}", "{}", "{}", False)]
    got = O.active_spec(spark.createDataFrame(rows, "version_key string, data_dictionary string, weights string, hierarchy string, is_active boolean")).collect()
    assert len(got) == 1 and json.loads(got[0]["spec"]) == {"a": [1, 2], "weights": {"p": 0.5}, "hierarchy": {}, "version_key": 'v"1'}


def test_rule_links(spark):
    html = '<a href="/x">x</a><a href="https://else.com/Payout-policy">p</a><a href="faq#top">f</a><a href="/x">x</a><a href="mailto:rules@x">m</a><a href="/rules">r</a><a href="https://else.com/Payout-policy">again</a>'
    d = spark.createDataFrame([(1, "https://a.com/b/", html), (2, None, None)], "id long, url string, html string")
    got = [(r["id"], r["link"]) for r in K.rule_links(d, "id", "url", "html", most=5).orderBy("id", "rank").collect()]
    assert got == [(1, "https://else.com/Payout-policy"), (1, "https://a.com/b/faq#top"), (1, "https://a.com/rules"), (1, "https://a.com/trading-rules"), (1, "https://a.com/rulebook")]
    assert K.rule_links(d, "id", "url", "html", most=None).count() == 2 + len(K.FALLBACKS)


def test_small(spark):
    one = lambda **c: spark.range(1).select(*(v.alias(k) for k, v in c.items())).first().asDict()
    lit, nums = F.lit, lambda *x: F.array(*map(F.lit, x)).cast("array<double>")
    assert one(a=E.news_event(lit("SECOND Penalty")), b=E.news_event(lit("Sector news")), c=E.news_severity(lit("x"), lit(None).cast("string")), d=E.news_severity(lit("a"), lit("Revoked"))) == {"a": "ENFORCEMENT", "b": "FILING", "c": "LOW", "d": "CRITICAL"}
    got = one(a=L.screening_confidence(lit("CLEAR"), nums()), b=L.screening_confidence(lit("SANCTIONED"), nums(0.9)), c=L.screening_confidence(lit("REVIEW"), nums(0.5, 1)), d=L.screening_confidence(lit("REVIEW"), nums()), e=L.mean_of(nums()))
    assert got == {"a": 0.95, "b": 0.99, "c": 0.75, "d": 0.95, "e": None}


def test_audit_json(spark):
    d = spark.sql("SELECT CAST('1.10' AS DECIMAL(5,2)) AS a, TIMESTAMP '2026-01-02 03:04:05.5' AS b, DATE '2026-01-02' AS c, array(struct(CAST(2 AS DECIMAL(3,1)) AS x, CAST(NULL AS STRING) AS y)) AS d, CAST(NULL AS INT) AS e")
    assert json.loads(d.select(J.audit_json(d.schema)).first()[0]) == {"a": "1.10", "b": "2026-01-02T03:04:05.500000", "c": "2026-01-02", "d": [{"x": "2.0", "y": None}], "e": None}
