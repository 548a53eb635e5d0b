"""What the agents check and report: valid evidence, its record, findings, complaints, and the principles of oversight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmscope.functions import payload as J

# Allowed values, required fields, limits, words and texts.
LICENSE_STATES = ["active", "suspended", "revoked", "expired"]
REGULATORS = ["FCA", "CySEC", "ASIC", "Companies House"]
EVENT_TYPES = ["warning", "enforcement", "suspension", "revocation", "settlement"]
SEVERITIES = ["critical", "high", "medium", "low"]
CLAIM_TYPES = ["license_issue", "payout_problem", "customer_complaint", "regulatory_approval", "fund_segregation", "other"]
CRITICAL_WORDS, HIGH_WORDS = ["scam", "fraud", "ponzi", "suspended"], ["complaint", "warning", "investigation"]
COMPLAINTS = {"payout issues": ["payout", "withdrawal"], "fraud allegations": ["scam", "fraud"], "customer service": ["customer service", "support"]}
PRINCIPLES = ["Transparency and Disclosure", "Risk Management", "Investor Protection", "Market Integrity", "Regulatory Compliance"]
KEEP_ON = ["Maintain current compliance standards", "Continue regular monitoring and reporting"]
#: How each agent records its evidence: type, method, metric that it affects.
RECORDED = {"RVI": ("registry_entry", "api_fetch", "license_verification"), "SSS": ("api_response", "api_fetch", "sanctions_screening"), "REM": ("document", "rss_fetch", "regulatory_event")}
SURE = 0.85


def _given(c: Column) -> Column:
    return F.coalesce(c.cast("string") != "", F.lit(False))


def _within(c: Column, low: float, high: float) -> Column:
    return F.coalesce(c.between(low, high) & ~F.isnan(c.cast("double")), F.lit(False))


def _one_of(c: Column, allowed: list[str]) -> Column:
    return F.coalesce(c.isin(allowed), F.lit(False))


def rules_of(agent: str, data: Column) -> dict[str, Column]:
    """The rules that evidence of an agent must keep, by name; data: its payload as a variant.

    The row's own columns are firm_id, confidence_score, impact_score and source (null where an agent has none).
    """
    at = lambda k: F.try_variant_get(data, f"$.{k}", "string")
    number = lambda k: F.try_variant_get(data, f"$.{k}", "double")
    confidence, impact = F.col("confidence_score"), F.col("impact_score")
    day = lambda k: F.coalesce(F.try_to_timestamp(at(k)), F.try_to_timestamp(at(k), F.lit("yyyy-MM-dd"))).isNotNull()
    if agent == "RVI":
        return {"license_number": _given(at("license_number")), "status": _one_of(at("status"), LICENSE_STATES), "source": _one_of(at("source"), REGULATORS)}
    if agent == "SSS":
        matches = F.coalesce(F.try_variant_get(data, "$.matches", "array<struct<match_score:double,name:string,type:string>>"), F.array().cast("array<struct<match_score:double,name:string,type:string>>"))
        return {"match_score": F.forall(matches, lambda m: _within(F.coalesce(m["match_score"], F.lit(0.0)), 0, 1)), "match_fields": F.forall(matches, lambda m: _given(m["name"]) & _given(m["type"]))}
    if agent == "REM":
        return {"event_type": _one_of(at("event_type"), EVENT_TYPES), "severity": _one_of(at("severity"), SEVERITIES), "dates": day("event_date") & day("announced_date"), "source_url": _given(at("source_url")), "confidence": _within(confidence, 0, 1)}
    if agent == "IRS":
        proof = F.coalesce(F.schema_of_variant(F.try_variant_get(data, "$.supporting_evidence", "variant")), F.lit("VOID"))
        some = ~proof.isin("VOID", "OBJECT<>", "ARRAY<VOID>") & (at("supporting_evidence") != "[]") & _given(at("supporting_evidence"))
        return {"required": _given(at("submission_id")) & _given(at("claim")), "claim_type": _one_of(at("claim_type"), CLAIM_TYPES), "severity": _one_of(at("severity"), SEVERITIES), "supporting_evidence": F.coalesce(some, F.lit(False))}
    filled = _given(F.col("firm_id")) & F.coalesce(F.schema_of_variant(data).startswith("OBJECT<") & (F.schema_of_variant(data) != "OBJECT<>"), F.lit(False))
    if agent in ("FRP", "MIS"):
        return {"required": filled, "confidence": _within(confidence, 0, 1), "impact": _within(impact, -1, 1)}
    if agent == "IIP":
        there = lambda k: F.try_variant_get(data, f"$.{k}", "variant").isNotNull()  # noqa: E731  a null value counts as there
        return {"required": filled, "fields": there("report_id") & there("risk_level") & there("compliance_status") & there("overall_score"), "overall_score": _within(number("overall_score"), 0, 100)}
    raise ValueError(f"no such agent: {agent}")


AGENTS = ["RVI", "SSS", "REM", "IRS", "FRP", "MIS", "IIP"]


def checked(evidence: DataFrame) -> DataFrame:
    """evidence (agent, firm_id, raw, confidence_score, impact_score and others) with `broken`, the names of the rules of its agent that it breaks, and `valid`.

    raw is JSON text; what can't be read breaks "payload", and an unknown agent breaks "agent". All payloads are read once.
    """
    d = evidence.withColumn("__v", F.try_parse_json("raw"))
    out = F.array(F.lit("agent"))
    for agent in AGENTS:
        names = F.array_compact(F.array(F.when(F.col("__v").isNull(), F.lit("payload")), *(F.when(~F.coalesce(ok, F.lit(False)), F.lit(n)) for n, ok in rules_of(agent, F.col("__v")).items())))
        out = F.when(F.col("agent") == agent, names).otherwise(out)
    return d.withColumn("broken", out).withColumn("valid", F.size("broken") == 0).drop("__v")


def recorded(evidence: DataFrame) -> DataFrame:
    """Rows of the evidence table: firm_id, evidence_type, evidence_hash, content_json, collection_method, relevance_score, affects_metric, impact_weight, confidence_level.

    content_json is the payload as the standard library writes it, and the hash is that text's SHA-256; confidence is high
    from 0.85 on, else medium. Only agents that record evidence have rows.
    """
    of = F.create_map(*(x for k, v in RECORDED.items() for x in (F.lit(k), F.struct(*map(F.lit, v)))))
    d = evidence.withColumn("__of", F.try_element_at(of, F.col("agent"))).filter("__of IS NOT NULL").withColumn("content_json", J.json_text(F.col("raw"), (1 << 31) - 1))
    level = F.when(F.col("confidence_score") >= SURE, "high").otherwise("medium")
    return d.select(
        "firm_id", F.col("__of.col1").alias("evidence_type"), F.sha2("content_json", 256).alias("evidence_hash"), "content_json", F.col("__of.col2").alias("collection_method"), F.col("confidence_score").alias("relevance_score"),
        F.col("__of.col3").alias("affects_metric"), F.col("impact_score").alias("impact_weight"), level.alias("confidence_level"),
    )


def findings_risk(findings: Column) -> Column:
    """CRITICAL or HIGH by words in the findings (array), MEDIUM for more than two of them, else LOW."""
    text = F.lower(F.array_join(findings, " "))
    says = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: text.contains(w))
    return F.when(says(CRITICAL_WORDS), "CRITICAL").when(says(HIGH_WORDS), "HIGH").when(F.size(findings) > 2, "MEDIUM").otherwise("LOW")


def complaint_tags(text: Column) -> Column:
    """The kinds of complaint that a review's words speak of."""
    low = F.lower(text)
    says = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: low.contains(w))
    return F.array_compact(F.array(*(F.when(says(words), tag) for tag, words in COMPLAINTS.items())))


def complaints(reviews: DataFrame, key: str, text: str) -> DataFrame:
    """key, tag and n: how many reviews speak of each kind."""
    return reviews.select(key, F.explode(complaint_tags(F.col(text))).alias("tag")).groupBy(key, "tag").agg(F.count("*").alias("n"))


def model_type(c: Column) -> Column:
    """CFD_FX, FUTURES or HYBRID from a text; whole names before words in it."""
    v = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(v.isin("FX_CFD", "CFD", "FX", "CFD_FX"), "CFD_FX").when(v.isin("FUTURES", "FUT"), "FUTURES").when(v.contains("FOREX") | v.contains("CFD"), "CFD_FX").when(v.contains("FUTURES"), "FUTURES").otherwise("HYBRID")


def firm_status(c: Column) -> Column:
    v = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(v.isin("set_aside", "watchlist"), "watchlist").when(v.isin("exclude", "excluded"), "excluded").otherwise("candidate")


def principles(score: Column, pillars: Column, status: Column) -> Column:
    """Array of struct(principle, status): COMPLIANT, PARTIAL or NON_COMPLIANT by score, pillar scores (map) and status; missing ones are 0."""
    level = lambda c, full, part: F.when(c >= full, "COMPLIANT").when(c >= part, "PARTIAL").otherwise("NON_COMPLIANT")
    pillar = lambda k: level(F.coalesce(F.try_element_at(pillars, F.lit(k)), F.lit(0.0)), 0.7, 0.5)
    held = F.when(status == "active", "COMPLIANT").when(status == "candidate", "PARTIAL").otherwise("NON_COMPLIANT")
    levels = [level(F.coalesce(score, F.lit(0.0)), 70, 50), pillar("risk_model"), pillar("payout_reliability"), pillar("legal_compliance"), held]
    return F.array(*(F.struct(F.lit(p).alias("principle"), s.alias("status")) for p, s in zip(PRINCIPLES, levels, strict=True)))


def principles_score(found: Column) -> Column:
    """20 for each principle that is kept and 10 for each in part."""
    return F.aggregate(found, F.lit(0), lambda n, p: n + F.when(p["status"] == "COMPLIANT", 20).when(p["status"] == "PARTIAL", 10).otherwise(0))


def principles_advice(found: Column) -> Column:
    """What to do about each principle that isn't kept; to go on, if all are."""
    said = F.transform(F.filter(found, lambda p: p["status"] != "COMPLIANT"), lambda p: F.when(p["status"] == "PARTIAL", F.concat(F.lit("Enhance "), p["principle"], F.lit(" to reach full compliance"))).otherwise(F.concat(F.lit("Improve "), p["principle"], F.lit(" - currently non-compliant"))))
    return F.when(F.size(said) > 0, said).otherwise(F.array(*map(F.lit, KEEP_ON)))
