"""Agents' rules, findings and principles on hand cases."""

import hashlib
import json

from pyspark.sql import functions as F

from firmscope.operators import agents as A

GOOD = {
    "RVI": {"license_number": "1", "status": "active", "source": "FCA"},
    "SSS": {"matches": [{"match_score": 0.5, "name": "a", "type": "x"}]},
    "REM": {"event_type": "warning", "severity": "low", "event_date": "2026-01-02", "announced_date": "2026-01-02T03:04:05", "source_url": "u"},
    "IRS": {"submission_id": "s", "claim": "c", "claim_type": "other", "severity": "high", "supporting_evidence": ["a"]},
    "FRP": {"a": 1}, "MIS": {"a": None}, "IIP": {"report_id": None, "risk_level": "x", "compliance_status": "y", "overall_score": 100},
}
BAD = [
    ("RVI", {"status": "gone", "source": None}, ["license_number", "status", "source"]), ("SSS", {"matches": [{"match_score": 2, "name": "a", "type": None}]}, ["match_score", "match_fields"]), ("SSS", {}, []), ("SSS", {"matches": None}, []),
    ("REM", {**GOOD["REM"], "event_date": "soon", "source_url": ""}, ["dates", "source_url"]), ("IRS", {**GOOD["IRS"], "supporting_evidence": [], "claim": ""}, ["required", "supporting_evidence"]), ("IRS", {"severity": "low"}, ["required", "claim_type", "supporting_evidence"]),
    ("FRP", {}, ["required"]), ("IIP", {"report_id": 1, "overall_score": 101}, ["fields", "overall_score"]), ("IIP", [1], ["required", "fields", "overall_score"]), ("nobody", {"a": 1}, ["agent"]),
]


def test_rules_of_agents(spark):
    rows = [(i, a, "f", json.dumps(v), 0.5, 0.0) for i, (a, v) in enumerate(GOOD.items())]
    rows += [(100 + i, a, "f", json.dumps(v), 0.5, 0.0) for i, (a, v, _) in enumerate(BAD)]
    rows += [(200, "MIS", "", '{"a":1}', 1.1, None), (201, "REM", "f", "{", 0.5, 0.0), (202, "REM", "f", json.dumps(GOOD["REM"]), None, 0.0), (203, "FRP", None, None, 0.5, -1.5)]
    d = A.checked(spark.createDataFrame(rows, "id long, agent string, firm_id string, raw string, confidence_score double, impact_score double"))
    got = {r["id"]: (r["broken"], r["valid"]) for r in d.collect()}
    assert all(got[i] == ([], True) for i in range(len(GOOD)))
    assert [got[100 + i][0] for i in range(len(BAD))] == [b for _, _, b in BAD]
    assert got[200][0] == ["required", "confidence", "impact"] and got[201][0][0] == "payload" and got[202][0] == ["confidence"] and got[203][0] == ["payload", "required", "impact"]


def test_evidence_is_recorded(spark):
    raw = '{"b":1,\n"a":"é"}'
    d = spark.createDataFrame([("SSS", "f", raw, 0.85, -0.5), ("REM", "f", raw, 0.8, 0.0), ("FRP", "f", raw, 1.0, 0.0)], "agent string, firm_id string, raw string, confidence_score double, impact_score double")
    got = {r["affects_metric"]: r for r in A.recorded(d).collect()}
    text = json.dumps(json.loads(raw))
    assert set(got) == {"sanctions_screening", "regulatory_event"} and got["sanctions_screening"]["content_json"] == text
    assert got["sanctions_screening"]["evidence_hash"] == hashlib.sha256(text.encode()).hexdigest()
    assert (got["sanctions_screening"]["confidence_level"], got["regulatory_event"]["confidence_level"]) == ("high", "medium")


def test_findings_kinds_and_principles(spark):
    one = lambda **c: spark.range(1).select(*(v.alias(k) for k, v in c.items())).first().asDict()
    arr, lit = lambda *x: F.array(*map(F.lit, x)).cast("array<string>"), F.lit
    got = one(a=A.findings_risk(arr("a PONZI")), b=A.findings_risk(arr("x", "Warning")), c=A.findings_risk(arr("x", "y", "z")), d=A.findings_risk(arr()))
    assert got == {"a": "CRITICAL", "b": "HIGH", "c": "MEDIUM", "d": "LOW"}
    assert one(a=A.complaint_tags(lit("Support lost my WITHDRAWAL")), b=A.complaint_tags(lit("ok"))) == {"a": ["payout issues", "customer service"], "b": []}
    assert one(a=A.model_type(lit(" fut ")), b=A.model_type(lit("futures and forex")), c=A.model_type(lit(None).cast("string")), d=A.firm_status(lit("Set_Aside"))) == {"a": "FUTURES", "b": "CFD_FX", "c": "HYBRID", "d": "watchlist"}
    full = A.principles(lit(70.0), F.create_map(lit("risk_model"), lit(0.7), lit("payout_reliability"), lit(0.9), lit("legal_compliance"), lit(1.0)), lit("active"))
    none = A.principles(lit(None).cast("double"), F.create_map().cast("map<string,double>"), lit("candidate"))
    got = one(a=A.principles_score(full), b=A.principles_advice(full), c=A.principles_score(none), d=F.size(A.principles_advice(none)), e=F.element_at(A.principles_advice(none), -1))
    assert got == {"a": 100, "b": A.KEEP_ON, "c": 10, "d": 5, "e": "Enhance Regulatory Compliance to reach full compliance"}
