"""Rules of the agents as columns: struct(has_issue, confidence, impact), impacts, levels and composite indices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firmscope.functions.values import band, clamp01, mapped

# Limits, impacts and confidences.
LICENSE_IMPACT = {"active": 0.2, "suspended": -0.7, "revoked": -1.0, "expired": -0.8, "unknown": 0.0}
SEVERITY_IMPACT = {"critical": -0.8, "high": -0.5, "medium": -0.25, "low": -0.1}
SUBMISSION_IMPACT = {"critical": -0.9, "high": -0.5, "medium": -0.2, "low": 0.1}
REPORT_IMPACT = {"compliant": 0.0, "conditional": -0.4, "non_compliant": -0.8}
HIGH_RISK_COUNTRIES = ["BZ", "VG", "KY"]
REGULATORY_EXPOSURE = {"registration_risk": 0.30, "client_jurisdiction_risk": 0.25, "regulatory_mentions": 0.25, "model_compatibility": 0.20}
INSTITUTIONAL_READINESS = {"governance": 0.25, "legal_clarity": 0.20, "operations": 0.20, "transparency": 0.20, "compliance": 0.15}
READINESS_BANDS = [(0.85, "Institution-grade"), (0.70, "Institutional-ready"), (0.50, "Emerging institutional"), (0.30, "Semi-professional")]
INTEGRITY_BANDS = [(0.60, "Solid"), (0.40, "Fragile")]
INCLUSION = {"score": 0.30, "survivability": 0.20, "readiness": 0.20, "regulatory_safety": 0.20, "stability": 0.10}
INCLUSION_BANDS = [(0.85, "Very high"), (0.65, "High"), (0.45, "Moderate"), (0.25, "Low")]


def ruled(*steps: tuple[Column, float, float], confidence: float, further: tuple[tuple[Column, float, float, float], ...] = ()) -> Column:
    """struct(has_issue, confidence, impact).

    steps: (condition, impact, confidence), of which the first that holds applies; without one impact is 0 and
    confidence the default. further: (condition, less, most, confidence), each in turn: the impact falls by `less`, to
    `most` at least, and the confidence becomes that one.
    """
    issue, sure, impact = F.lit(False), F.lit(confidence), F.lit(0.0)
    for c, i, s in reversed(steps):
        c = F.coalesce(c, F.lit(False))
        issue, sure, impact = c | issue, F.when(c, s).otherwise(sure), F.when(c, i).otherwise(impact)
    for c, less, most, s in further:
        c = F.coalesce(c, F.lit(False))
        issue, sure, impact = issue | c, F.when(c, s).otherwise(sure), F.when(c, F.least(impact - less, F.lit(most))).otherwise(impact)
    return F.struct(issue.alias("has_issue"), sure.alias("confidence"), impact.alias("impact"))


def review_surge(negative_share: Column) -> Column:
    return ruled((negative_share > 0.25, -0.6, 0.9), (negative_share > 0.15, -0.35, 0.85), confidence=0.8)


def payout_complaints(complaints: Column, success_rate: Column) -> Column:
    return ruled((complaints > 15, -0.75, 0.95), (complaints > 8, -0.45, 0.90), confidence=0.85, further=((success_rate < 0.90, 0.3, -0.5, 0.92),))


def sentiment_trend(current: Column, four_weeks_ago: Column) -> Column:
    trend = current - four_weeks_ago
    return ruled((trend < -0.30, -0.55, 0.88), (trend < -0.15, -0.30, 0.85), confidence=0.80, further=((-trend / 4 > 0.08, 0.2, -0.4, 0.90),))


def domain(days_to_expiry: Column, ssl_valid: Column, dns_ok: Column) -> Column:
    return ruled((days_to_expiry < 0, -0.80, 0.99), (days_to_expiry < 30, -0.50, 0.95), confidence=0.85, further=((~ssl_valid, 0.3, -0.6, 0.98), (~dns_ok, 0.25, -0.5, 0.90)))


def company(registered: Column, status: Column, filings: Column, country: Column) -> Column:
    return ruled((~registered, -0.85, 0.99), (status == "flagged", -0.60, 0.90), confidence=0.80, further=((filings == "incomplete", 0.25, -0.4, 0.85), (country.isin(HIGH_RISK_COUNTRIES), 0.20, -0.35, 0.80)))


def news(positive: Column, negative: Column, neutral: Column, recent_negative: Column) -> Column:
    total = positive + negative + neutral
    share = F.when(total > 0, negative / total).otherwise(0.0)
    return ruled((share > 0.30, -0.55, 0.85), (share > 0.15, -0.30, 0.80), confidence=0.80, further=((recent_negative > 5, 0.25, -0.5, 0.90),))


def patterns(similarity: Column, flags: list[Column]) -> Column:
    n = sum((F.coalesce(f, F.lit(False)).cast("int") for f in flags), F.lit(0))
    return ruled((similarity > 0.60, -0.85, 0.92), (similarity > 0.40, -0.55, 0.88), confidence=0.85, further=((n >= 3, 0.30, -0.6, 0.90), (n == 2, 0.20, -0.4, 0.85)))


def license_impact(status: Column, restrictions: Column) -> Column:
    """By status; a positive impact is halved where there are restrictions (an array)."""
    base = mapped(status, LICENSE_IMPACT, 0.0)
    return F.when((base > 0) & (F.coalesce(F.size(restrictions), F.lit(0)) > 0), base * 0.5).otherwise(base)


def watchlist_impact(types: Column, best: Column) -> Column:
    """-1 with any match of OFAC or UN, else by the best score of the matches; 0 without a match (no types)."""
    scaled = F.when(best > 0.90, -0.7).when(best > 0.75, -0.4).otherwise(-0.1)
    return F.when(F.coalesce(F.size(types), F.lit(0)) <= 0, 0.0).when(F.array_contains(types, "OFAC") | F.array_contains(types, "UN"), -1.0).otherwise(scaled)


def severity_impact(severity: Column) -> Column:
    return mapped(severity, SEVERITY_IMPACT, -0.1)


def submission_impact(severity: Column, kind: Column) -> Column:
    base = F.when(kind == "regulatory_approval", 0.3).otherwise(mapped(severity, SUBMISSION_IMPACT, 0.0))
    return base * F.when(kind.isin("payout_problem", "fund_segregation"), 1.2).otherwise(1.0)


def report_impact(status: Column) -> Column:
    return mapped(status, REPORT_IMPACT, -0.8)


def compliance(critical: Column) -> Column:
    """struct(risk, status, score) from the number of critical issues."""
    of = lambda a, b, c, d: F.when(critical >= 5, a).when(critical >= 3, b).when(critical >= 1, c).otherwise(d)
    return F.struct(of("critical", "high", "medium", "low").alias("risk"), of("non_compliant", "conditional", "conditional", "compliant").alias("status"), of(20, 40, 65, 85).alias("score"))


def match_confidence(score: Column) -> Column:
    return band(score, [(0.95, "high"), (0.85, "medium")], "low")


def screening_status(confidences: Column) -> Column:
    """SANCTIONED with any match of high confidence, REVIEW with any other match, else CLEAR."""
    n = F.coalesce(F.size(confidences), F.lit(0))
    return F.when(n <= 0, "CLEAR").when(F.array_contains(confidences, "high"), "SANCTIONED").otherwise("REVIEW")


def screening_level(confidences: Column) -> Column:
    """As screening_status, with REVIEW_REQUIRED for a best match of medium confidence and POTENTIAL_MATCH for one of low."""
    status = screening_status(confidences)
    return F.when(status != "REVIEW", status).when(F.array_contains(confidences, "medium"), "REVIEW_REQUIRED").otherwise("POTENTIAL_MATCH")


def screening_confidence(status: Column, scores: Column) -> Column:
    """How sure a screening is: 0.95 if clear or without matches, 0.99 if sanctioned, else the mean score of its matches."""
    return F.when(status == "CLEAR", 0.95).when(status == "SANCTIONED", 0.99).otherwise(F.coalesce(mean_of(scores), F.lit(0.95)))


def mean_of(scores: Column) -> Column:
    """Mean of an array of numbers; null for none."""
    n = F.size(scores)
    return F.when(n > 0, F.aggregate(scores, F.lit(0.0), lambda s, x: s + x) / n)


def rating_sentiment(rating: Column) -> Column:
    return band(rating, [(4.0, "positive"), (3.0, "neutral")], "negative")


def as_share(score: Column) -> Column:
    """A score above 1 is taken as percent."""
    return F.when(score > 1, score / 100).otherwise(score)


def stability_score(sensitivity: Column, fallback_share: Column) -> Column:
    return F.greatest(F.lit(0.0), 100 - (sensitivity + fallback_share))


def weighted_index(weights: dict[str, float]) -> Column:
    """Sum of weight times column; null if any is."""
    return sum((F.lit(w) * F.col(c) for c, w in weights.items()), F.lit(0.0))


def model_integrity(*parts: Column) -> Column:
    return sum(parts, F.lit(0.0)) / len(parts)


def stress(*impacts: Column) -> Column:
    return 1 - sum(impacts, F.lit(0.0)) / len(impacts)


def inclusion(score: Column, survivability: Column, readiness: Column, rem: Column, rvi: Column, review: Column, na_rate: Column, tier5: Column, inconsistent: Column) -> Column:
    """Probability of inclusion: a weighted sum less four penalties, within 0 and 1. na_rate is a share."""
    w = INCLUSION
    raw = w["score"] * score + w["survivability"] * survivability + w["readiness"] * readiness + w["regulatory_safety"] * (1 - rem) + w["stability"] * (1 - rvi)
    off = lambda c, x: F.when(F.coalesce(c, F.lit(False)), x).otherwise(0.0)
    return clamp01(raw - off(review, 0.30) - off(na_rate > 0.40, 0.25) - off(tier5, 0.40) - off(inconsistent, 0.20))
