"""Queries on what the agents check and report, over events and orders as evidence and conversations as reviews."""

from __future__ import annotations

from pyspark.sql import functions as F

from firmscope.operators import agents as A
from firmscope.plans.extract_queries import choose
from firmscope.plans.registry import query

K = "o_orderkey"
_q = lambda *parts: " || ".join(parts)
_pick = lambda n, values: f"({choose(f'CAST(floor({K} / {n}) AS BIGINT) % {len(values)}', values)})"
#: Payloads of the seven agents, in which each rule is broken now and then.
_raw = {
    "RVI": _q("'{\"license_number\":\"'", _pick(7, ["L1", "", "L2", "L3"]), "'\",\"status\":\"'", _pick(11, [*A.LICENSE_STATES, "odd"]), "'\",\"source\":\"'", _pick(13, ["FCA", "CySEC", "Companies House", "Nobody"]), "'\"}'"),
    "SSS": _q("'{\"matches\":['", _pick(7, ['{"match_score":0.5,"name":"a","type":"x"}', "", '{"match_score":1.5,"name":"a","type":"x"}', '{"name":"","type":"x"}', '{"match_score":1,"name":"b","type":"y"},{"match_score":-0.1,"name":"c"}']), "']}'"),
    "REM": _q("'{\"event_type\":\"'", _pick(7, [*A.EVENT_TYPES, "rumour"]), "'\",\"severity\":\"'", _pick(11, [*A.SEVERITIES, "none"]), "'\",\"event_date\":\"'", _pick(13, ["2026-01-02", "2026-01-02T03:04:05", "soon"]), "'\",\"announced_date\":\"2026-01-03\",\"source_url\":\"'", _pick(17, ["https://x", ""]), "'\"}'"),
    "IRS": _q("'{\"submission_id\":\"s\",\"claim\":\"'", _pick(7, ["c", ""]), "'\",\"claim_type\":\"'", _pick(11, [*A.CLAIM_TYPES, "odd"]), "'\",\"severity\":\"'", _pick(13, [*A.SEVERITIES, ""]), "'\",\"supporting_evidence\":'", _pick(17, ['["a"]', "[]", '"b"', "null"]), "'}'"),
    "FRP": _pick(7, ['{"a":1}', "{}", '{"b":[]}']),
    "MIS": _pick(7, ['{"a":1}', "{broken", "[1]"]),
    "IIP": _q("'{\"report_id\":\"r\",\"risk_level\":\"low\",'", _pick(7, ['"compliance_status":"x",', ""]), "'\"overall_score\":'", _pick(11, ["50", "101", "0", "-1", "99.5"]), "'}'"),
}
_names = [*A.AGENTS, "XXX"]
EVIDENCE = [
    f"{K} AS evidence_id", f"{choose(f'{K} % {len(_names)}', _names)} AS agent", f"CASE WHEN {K} % 19 > 0 THEN 'f' || o_custkey ELSE '' END AS firm_id", f"CASE {K} % {len(_names)} " + " ".join(f"WHEN {i} THEN {_raw[a]}" for i, a in enumerate(A.AGENTS)) + " ELSE '{}' END AS raw",
    f"CASE WHEN {K} % 23 > 0 THEN ({K} % 110) / CAST(100 AS DOUBLE) END AS confidence_score", f"({K} % 230 - 115) / CAST(100 AS DOUBLE) AS impact_score",
]


def evidence(t):
    return t.orders.selectExpr(*EVIDENCE)


_at = lambda k: f"json_extract_string(j, '$.{k}')"
_in = lambda k, values: f"coalesce({_at(k)} IN ({', '.join(repr(x) for x in values)}), false)"
_given = lambda k: f"coalesce({_at(k)} <> '', false)"
_object = "coalesce(firm_id <> '', false) AND json_type(j) = 'OBJECT' AND len(json_keys(j)) > 0"
_sure = "coalesce(confidence_score BETWEEN 0 AND 1, false)"
_day = lambda k: f"(try_cast({_at(k)} AS TIMESTAMP) IS NOT NULL)"
_list = "CASE WHEN json_type(j, '$.matches') = 'ARRAY' THEN json_extract(j, '$.matches[*]') ELSE [] END"
_sql = {
    "RVI": {"license_number": _given("license_number"), "status": _in("status", A.LICENSE_STATES), "source": _in("source", A.REGULATORS)},
    "SSS": {"match_score": f"len(list_filter({_list}, lambda m: NOT coalesce(try_cast(json_extract_string(m, '$.match_score') AS DOUBLE), 0) BETWEEN 0 AND 1)) = 0", "match_fields": f"len(list_filter({_list}, lambda m: coalesce(json_extract_string(m, '$.name'), '') = '' OR coalesce(json_extract_string(m, '$.type'), '') = '')) = 0"},
    "REM": {"event_type": _in("event_type", A.EVENT_TYPES), "severity": _in("severity", A.SEVERITIES), "dates": f"{_day('event_date')} AND {_day('announced_date')}", "source_url": _given("source_url"), "confidence": _sure},
    "IRS": {"required": f"{_given('submission_id')} AND {_given('claim')}", "claim_type": _in("claim_type", A.CLAIM_TYPES), "severity": _in("severity", A.SEVERITIES), "supporting_evidence": "coalesce(CAST(json_extract(j, '$.supporting_evidence') AS VARCHAR), 'null') NOT IN ('null', '[]', '\"\"', '{}')"},
    "FRP": {"required": _object, "confidence": _sure, "impact": "impact_score BETWEEN -1 AND 1"},
    "MIS": {"required": _object, "confidence": _sure, "impact": "impact_score BETWEEN -1 AND 1"},
    "IIP": {"required": _object, "fields": " AND ".join(f"list_contains(json_keys(j), '{k}')" for k in ("report_id", "risk_level", "compliance_status", "overall_score")), "overall_score": "coalesce(try_cast(json_extract_string(j, '$.overall_score') AS DOUBLE) BETWEEN 0 AND 100, false)"},
}
_broken = " ".join(f"WHEN '{a}' THEN concat_ws(',', CASE WHEN NOT json_valid(raw) THEN 'payload' END, {', '.join(f'CASE WHEN NOT ({ok}) THEN {n!r} END' for n, ok in rules.items())})" for a, rules in _sql.items())


@query(f"WITH e AS (SELECT {', '.join(EVIDENCE)} FROM orders), v AS (SELECT *, CASE WHEN json_valid(raw) THEN raw ELSE 'null' END AS j FROM e), b AS (SELECT *, CASE agent {_broken} ELSE 'agent' END AS broken FROM v) SELECT evidence_id, agent, broken, broken = '' AS valid FROM b")
def agent_evidence(t):
    return A.checked(evidence(t)).select("evidence_id", "agent", F.array_join("broken", ",").alias("broken"), "valid")


_payload = f"'{{\"b\": ' || o_custkey || ', \"a\": \"' || o_orderstatus || '\"}}'"


@query(f"SELECT 'f' || o_custkey AS firm_id, CASE o_orderkey % 4 WHEN 0 THEN 'registry_entry' WHEN 1 THEN 'api_response' ELSE 'document' END AS evidence_type, sha256({_payload}) AS evidence_hash, CASE o_orderkey % 4 WHEN 0 THEN 'license_verification' WHEN 1 THEN 'sanctions_screening' ELSE 'regulatory_event' END AS affects_metric, CASE WHEN (o_orderkey % 101) / 100.0::DOUBLE >= 0.85 THEN 'high' ELSE 'medium' END AS confidence_level FROM orders WHERE o_orderkey % 4 < 3")
def evidence_records(t):
    """Of four agents three record their evidence."""
    d = t.orders.selectExpr("'f' || o_custkey AS firm_id", f"{choose('o_orderkey % 4', ['RVI', 'SSS', 'REM', 'FRP'])} AS agent", f"replace({_payload}, ': ', ':   ') AS raw", "(o_orderkey % 101) / CAST(100 AS DOUBLE) AS confidence_score", "CAST(0 AS DOUBLE) AS impact_score")
    return A.recorded(d).select("firm_id", "evidence_type", "evidence_hash", "affects_metric", "confidence_level")


WORDS = ["Payout delayed, support silent", "a SCAM", "withdrawal refused: fraud", "fine", "customer service was kind", "warning of an investigation", "ponzi complaint"]
_review = f"text || ' ' || ({choose(f'(conv_id + turn) % {len(WORDS)}', WORDS)})"
_says = lambda words: "(" + " OR ".join(f"contains(l, '{w}')" for w in words) + ")"


@query(f"WITH r AS (SELECT role, lower({_review}) AS l FROM conversations), g AS (SELECT role, unnest([{', '.join(f'CASE WHEN {_says(w)} THEN {t!r} END' for t, w in A.COMPLAINTS.items())}]) AS tag FROM r) SELECT role, tag, count(*) AS n FROM g WHERE tag IS NOT NULL GROUP BY 1, 2")
def complaint_counts(t):
    return A.complaints(t.conversations.selectExpr("role", f"{_review} AS review"), "role", "review")


@query(f"WITH f AS (SELECT conv_id, count(*) AS n, lower(string_agg({_review}, ' ' ORDER BY turn)) AS l FROM conversations WHERE turn % 2 = 0 GROUP BY 1) SELECT conv_id, CASE WHEN {_says(A.CRITICAL_WORDS)} THEN 'CRITICAL' WHEN {_says(A.HIGH_WORDS)} THEN 'HIGH' WHEN n > 2 THEN 'MEDIUM' ELSE 'LOW' END AS risk FROM f")
def findings_risks(t):
    d = t.conversations.filter("turn % 2 = 0").selectExpr("conv_id", "turn", f"{_review} AS x").groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "x"))), lambda x: x["x"]).alias("findings"))  # of one firm
    return d.select("conv_id", A.findings_risk(F.col("findings")).alias("risk"))


KINDS = ["fx_cfd", " CFD ", "Forex & crypto", "fut", "Micro Futures", "multi-asset", "", None, "hybrid", "cfd futures"]
STATES = ["Candidate", "set_aside", " EXCLUDE", "excluded", "", None, "active", "watchlist"]


@query(f"WITH d AS (SELECT c_custkey, upper(trim(coalesce({choose(f'c_custkey % {len(KINDS)}', KINDS)}, ''))) AS k, lower(trim(coalesce({choose(f'CAST(floor(c_custkey / 3) AS BIGINT) % {len(STATES)}', STATES)}, ''))) AS s FROM customer) SELECT c_custkey AS firm_id, CASE WHEN k IN ('FX_CFD', 'CFD', 'FX', 'CFD_FX') THEN 'CFD_FX' WHEN k IN ('FUTURES', 'FUT') THEN 'FUTURES' WHEN contains(k, 'FOREX') OR contains(k, 'CFD') THEN 'CFD_FX' WHEN contains(k, 'FUTURES') THEN 'FUTURES' ELSE 'HYBRID' END AS model_type, CASE WHEN s IN ('set_aside', 'watchlist') THEN 'watchlist' WHEN s IN ('exclude', 'excluded') THEN 'excluded' ELSE 'candidate' END AS status FROM d")
def firm_kinds(t):
    d = t.customer.selectExpr("c_custkey AS firm_id", f"{choose(f'c_custkey % {len(KINDS)}', KINDS)} AS k", f"{choose(f'CAST(floor(c_custkey / 3) AS BIGINT) % {len(STATES)}', STATES)} AS s")
    return d.select("firm_id", A.model_type(F.col("k")).alias("model_type"), A.firm_status(F.col("s")).alias("status"))


_grade = lambda c, full, part: f"CASE WHEN {c} >= {full} THEN 2 WHEN {c} >= {part} THEN 1 ELSE 0 END"


@query(
    f"WITH d AS (SELECT c_custkey AS firm_id, [{_grade('coalesce(CASE WHEN c_custkey % 6 > 0 THEN c_custkey % 101 END, 0)', 70, 50)}, {_grade('(c_custkey % 11) / 10.0::DOUBLE', 0.7, 0.5)}, {_grade('coalesce(CASE WHEN c_custkey % 4 > 0 THEN (c_custkey % 9) / 8.0::DOUBLE END, 0)', 0.7, 0.5)}, 0, CASE c_custkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END] AS g FROM customer)"
    f" SELECT firm_id, (10 * list_sum(g))::BIGINT AS score, array_to_string(list_filter(list_transform(range(1, 6), lambda i: CASE g[i] WHEN 1 THEN 'Enhance ' || ({A.PRINCIPLES})[i] || ' to reach full compliance' WHEN 0 THEN 'Improve ' || ({A.PRINCIPLES})[i] || ' - currently non-compliant' END), lambda x: x IS NOT NULL), '; ') AS advice FROM d"
)
def oversight_principles(t):
    k = F.col("c_custkey")
    pillars = F.create_map(F.lit("risk_model"), (k % 11) / 10, F.lit("payout_reliability"), F.when(k % 4 > 0, (k % 9) / 8))
    found = A.principles(F.when(k % 6 > 0, (k % 101).cast("double")), pillars, F.when(k % 3 == 0, "active").when(k % 3 == 1, "candidate"))
    return t.customer.select(k.alias("firm_id"), A.principles_score(found).cast("long").alias("score"), F.array_join(A.principles_advice(found), "; ").alias("advice"))
