"""Scores of firms, the oversight gate, and the public snapshot, on tables of the domain.

A record is one row a firm with rules and pricing as JSON text. Specifications of scores are plain dictionaries, so
scoring is a chain of projections over the records, without joins or shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmscope.functions import extract as E
from firmscope.functions import values as V
from firmscope.operators import relational as R
from firmscope.operators.tables import kept

# Keys that count for completeness, the live specification with its weights, and country scores.
COMPLETE_KEYS = ["payout_frequency", "max_drawdown_rule", "daily_drawdown_rule", "rule_changes_frequency", "jurisdiction", "jurisdiction_tier", "headquarters", "founded_year"]
PRICING_KEYS = ["payout_frequency", "payout_split_pct", "refund_policy", "kyc_required", "challenge_fee_min", "challenge_fee_max"]
PRICING_KEYS_OF_RULES = ["payout_split", "payout_frequency", "fees", "profit_target"]
RULE_KEYS = ["brand_name", "platform", "instruments", "account_sizes", "profit_target", "daily_drawdown", "max_drawdown", "consistency_rule", "news_trading", "weekend_holding", "min_trading_days", "max_trading_days", "payout_split", "payout_frequency", "fees", "leverage", "notes"]
_QUALITY = ([0, 0.3, 0.6, 0.8, 1.0], [0.2, 0.5, 0.7, 0.9, 1.0])
PILLARS = {
    "A_transparency": {"payout_delay_days": ([0, 7, 14, 30, 60], [1.0, 0.9, 0.7, 0.5, 0.3]), "payout_text_quality": _QUALITY},
    "B_payout_reliability": {"rules_page_quality": _QUALITY, "rules_length_signal": ([0, 100, 500, 1000, 2000], [0.3, 0.6, 0.8, 0.9, 1.0])},
    "C_risk_model": {"registry_country": "jurisdiction"},
    "D_legal_compliance": {"reviews_sentiment": ([0, 0.2, 0.4, 0.6, 0.8], [0.1, 0.3, 0.5, 0.8, 1.0])},
    "E_reputation_support": {"support_quality": _QUALITY},
}
WEIGHTS = {"A_transparency": 0.25, "B_payout_reliability": 0.25, "C_risk_model": 0.20, "D_legal_compliance": 0.20, "E_reputation_support": 0.10}
COUNTRY_SCORES = {
    "US": 1.0, "UK": 1.0, "EU": 0.95, "DE": 0.95, "FR": 0.95, "NL": 0.95, "SE": 0.95, "AU": 0.95, "SG": 0.95, "JP": 0.90, "CA": 0.90,
    "AE": 0.75, "CY": 0.70, "MT": 0.70, "EE": 0.70, "LT": 0.70, "PL": 0.65, "RO": 0.65, "BG": 0.60, "TR": 0.60, "ZA": 0.55,
    "KY": 0.40, "VG": 0.40, "SC": 0.40, "MU": 0.40, "BS": 0.35, "PA": 0.35, "CR": 0.35, "IN": 0.30, "PH": 0.30, "VN": 0.30,
    "RU": 0.20, "BY": 0.20, "CN": 0.20, "HK": 0.20, "NG": 0.15, "KE": 0.15, "TZ": 0.15, "UNKNOWN": 0.10, "OFFSHORE": 0.10,
}
REGIONS = {
    "united states": 0.9, "usa": 0.9, "us": 0.9, "united kingdom": 0.9, "uk": 0.9, "france": 0.9, "germany": 0.9, "netherlands": 0.9,
    "spain": 0.9, "italy": 0.9, "canada": 0.9, "australia": 0.9, "singapore": 0.9, "switzerland": 0.9,
    "uae": 0.75, "dubai": 0.75, "hong kong": 0.75, "new zealand": 0.75,
    "seychelles": 0.6, "st vincent": 0.6, "st. vincent": 0.6, "bvi": 0.6, "british virgin islands": 0.6, "cayman": 0.6,
    "cayman islands": 0.6, "belize": 0.6, "vanuatu": 0.6, "marshall islands": 0.6,
}
ERROR_KEYS = {"crawl_error": "crawl_error", "http_error": "crawl_error", "rules_extract_error": "extraction_error", "pricing_extract_error": "extraction_error"}
DATA_KEYS = ["rules_extracted_v0", "rules_extracted_from_home_v0", "pricing_extracted_v0", "pricing_extracted_from_home_v0", "discovered_links"]


def unwrapped(json: Column, *inside: str) -> Column:
    """The JSON object in the first of these fields that holds one, else the text itself; null unless it is an object."""
    whole = F.when(F.trim(json).startswith("{"), json)
    found = [F.get_json_object(whole, f"$.{k}") for k in inside]
    return F.coalesce(*(F.when(x.startswith("{"), x) for x in found), whole)


def field(json: Column, key: str) -> Column:
    return F.get_json_object(json, f"$.{key}")


def fields(json: Column) -> Column:
    """An object's values as a map of text; lists and objects in it stay JSON."""
    return F.from_json(json, "map<string,string>")


def at(m: Column, key: str) -> Column:
    return F.try_element_at(m, F.lit(key))


def present(c: Column) -> Column:
    """Neither null, nor empty text, list or object."""
    return c.isNotNull() & ~c.cast("string").isin("", "[]", "{}")


def ratio(m: Column, keys: list[str]) -> Column:
    """Part of the keys that are present in a map; null for a map without keys and for none."""
    n = F.size(F.filter(F.array(*map(F.lit, keys)), lambda k: F.coalesce(present(F.try_element_at(m, k)), F.lit(False))))
    return F.when(F.coalesce(F.size(m), F.lit(0)) > 0, n / len(keys))


def text_length(m: Column, skip: tuple[str, ...] = ("_audit", "source_urls")) -> Column:
    """Letters in all values of a map, joined by blanks, items of lists one by one; null if there are none."""
    own = F.map_filter(m, lambda k, v: ~k.isin(*skip) & v.isNotNull() & (v != ""))
    items = lambda v: F.filter(F.from_json(v, "array<string>"), lambda x: x.isNotNull() & (x != ""))
    parts = F.flatten(F.transform(F.map_values(own), lambda v: F.when(v.startswith("["), F.coalesce(items(v), F.array(v))).otherwise(F.array(v))))
    return F.nullif(F.length(F.trim(F.array_join(parts, " "))), F.lit(0))


def or_else(*cols: Column) -> Column:
    """The first text that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cols))


def derived(records: DataFrame) -> DataFrame:
    """records with the features that scores read, from rules and pricing (JSON text) and the record's own fields."""
    d = R.once(records, __r=fields(unwrapped(F.col("rules"), "value")), __p=fields(unwrapped(F.col("pricing"), "value")))
    rules, pricing = F.col("__r"), F.col("__p")
    own = lambda c: F.col(c).cast("string")
    return R.once(
        d,
        payout_delay_days=E.delay_days(or_else(at(pricing, "payout_frequency"), at(rules, "payout_frequency"))),
        payout_text_quality=F.bround(F.coalesce(ratio(pricing, PRICING_KEYS), ratio(rules, PRICING_KEYS_OF_RULES)), 3),
        rules_page_quality=F.bround(ratio(rules, RULE_KEYS), 3),
        rules_length_signal=text_length(rules),
        risk_max_daily_loss=E.first_number(or_else(own("daily_drawdown_rule"), at(rules, "daily_drawdown"))),
        risk_max_total_loss=E.first_number(or_else(own("max_drawdown_rule"), at(rules, "max_drawdown"))),
        rules_change_level=E.change_level(or_else(own("rule_changes_frequency"), at(rules, "rule_changes_frequency"))),
        registry_country=or_else(own("jurisdiction"), own("jurisdiction_tier")),
    ).drop("__r", "__p")


def completeness(keys: list[str] = COMPLETE_KEYS) -> Column:
    return sum((F.when(present(F.col(k)), 1).otherwise(0) for k in keys), F.lit(0)) / len(keys)


def confidence_of_completeness(c: Column) -> Column:
    return F.when(c.isNull(), "medium").otherwise(V.band(c, [(0.75, "high"), (0.45, "medium")], "low"))


def confidence_of_na_rate(c: Column, limit: float = 0.40) -> Column:
    return F.when(c <= 0.20, "high").when(c <= limit, "medium").otherwise("low")


def country_score(c: Column, table: dict[str, float] = COUNTRY_SCORES) -> Column:
    """By code, whatever its case; blank reads as UNKNOWN, an unknown code as OFFSHORE."""
    of = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.when(F.coalesce(c, F.lit("")) == "", table.get("UNKNOWN", 0.10)).otherwise(F.coalesce(F.try_element_at(of, F.upper(c)), F.lit(table.get("OFFSHORE", 0.10))))


def region_score(c: Column, table: dict[str, float] = REGIONS, na: float = 0.5) -> Column:
    """By name: an equal one, else the first of the table that lies in it."""
    low = F.lower(F.trim(c))
    of = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.when(F.coalesce(c, F.lit("")) == "", na).otherwise(F.coalesce(F.try_element_at(of, low), E.first_word(low, list(table.items())), F.lit(na)))


def scored(records: DataFrame, pillars: dict = PILLARS, weights: dict[str, float] = WEIGHTS, na_value: float = 0.6) -> DataFrame:
    """firm_id, score (0 to 100), na_rate (a share), na_rate_pct, completeness, confidence, pillar_scores and metric_scores.

    Metrics are binned, or looked up by country; those without a value count na_value. A pillar is the mean of its
    metrics, the score their weighted mean. records has a column for each metric; missing ones are without values.
    """
    metric, missing = {}, {}
    for of in pillars.values():
        for m, how in of.items():
            c = F.col(m) if m in records.columns else F.lit(None).cast("double")
            metric[m] = country_score(c.cast("string")) if how == "jurisdiction" else V.bin_weight(c, *how, na=na_value)
            missing[m] = c.isNull().cast("int")
    na = sum(missing.values(), F.lit(0)) / max(1, len(missing))
    d = R.once(records, __m=F.struct(*(c.alias(m) for m, c in metric.items())), __na=na, __full=completeness())
    pillar = {p: sum((F.col("__m")[m] for m in of), F.lit(0.0)) / len(of) for p, of in pillars.items()}
    d = R.once(d, __s=F.struct(*(c.alias(p) for p, c in pillar.items())))
    total = sum(weights.get(p, 0.0) for p in pillars)
    overall = 100 * sum((F.lit(weights.get(p, 0.0)) * F.col("__s")[p] for p in pillars), F.lit(0.0)) / total if total > 0 else F.lit(0.0)
    of_map = lambda s, names: F.create_map(*(x for k in names for x in (F.lit(k), F.bround(F.col(s)[k], 3))))
    return R.once(
        d.select("firm_id", "__m", "__s", "__na", "__full"), score=F.bround(overall, 2), na_rate=F.col("__na"), na_rate_pct=F.bround(100 * F.col("__na"), 2), completeness=F.bround("__full", 3),
        confidence=confidence_of_completeness(F.col("__full")), pillar_scores=of_map("__s", pillars), metric_scores=of_map("__m", metric),
    ).drop("__m", "__s", "__na", "__full")


def run_summary(scores: DataFrame) -> DataFrame:
    """One row: firms, avg, min and max of the scores; 0 without any."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return scores.agg(F.count("*").alias("firms"), F.round(zero(F.avg("score")), 2).alias("avg_score"), zero(F.min("score")).alias("min_score"), zero(F.max("score")).alias("max_score"))


def spec_metric(value: Column, kind: str, score_map, bins: list[float] | None = None, labels: list[float] | None = None, na: float = 0.5) -> Column:
    """Score of a metric's text value: identity, inverse, jurisdiction, a table of names, true and false, or bins with a score each."""
    number = value.try_cast("double")
    if score_map == "identity":
        return V.clamp01(number, 0.5)
    if score_map == "inverse":
        return V.clamp01(1 - V.clamp01(number, 0.5))
    if score_map == "jurisdiction_matrix_v1":
        return region_score(value)
    low = F.lower(F.trim(value))
    if isinstance(score_map, dict) and kind == "bool" and {"true", "false"} <= set(score_map):
        return F.when(low.isin("true", "1", "yes", "y"), float(score_map["true"])).when(low.isin("false", "0", "no", "n"), float(score_map["false"])).otherwise(0.5)
    if isinstance(score_map, dict):
        out = F.lit(0.5)
        for k, s in reversed(list(score_map.items())):
            out = F.when(low == k.lower(), float(min(1.0, max(0.0, s)))).otherwise(out)
        return out
    if kind in ("int", "hours", "pct", "usd") and bins is not None and labels is not None:
        at = V.bin_number(number, bins)
        out = F.lit(0.5)
        for i, s in enumerate(labels):
            out = F.when(at == i, float(min(1.0, max(0.0, s)))).otherwise(out)
        return F.when(number.isNull(), 0.5).otherwise(out)
    return F.lit(float(na))


def scored_by_spec(features: DataFrame, spec: dict, weights: dict[str, float]) -> DataFrame:
    """firm_id, score, na_rate, confidence, verdict, pillar_scores, pillar_na, sources of features (firm_id, f: map of text).

    spec: na_policy and pillars; a metric has type, score_map, and maybe fallback, bins and labels. Values come from the
    metric, else from its fallbacks in turn; the score of a missing one is na_value. Weights aren't normalised: a pillar
    that a weight names and the specification lacks counts 0.5.
    """
    na_value, limit = float(spec["na_policy"]["na_value"]), float(spec["na_policy"]["firm_na_rate_review_threshold"])
    get = lambda k: F.try_element_at("f", F.lit(k))
    pillar, pillar_na, sources, missing = {}, {}, {}, []
    for p, of in spec["pillars"].items():
        scores, none = [], []
        for m, meta in of["metrics"].items():
            chain = [m, *meta.get("fallback", [])]
            value = F.coalesce(*(get(k) for k in chain))
            source = F.lit("NA")
            for k in reversed(chain):
                source = F.when(get(k).isNotNull(), "primary" if k == m else f"fallback:{k}").otherwise(source)
            scores.append(F.when(value.isNull(), na_value).otherwise(spec_metric(value, meta["type"], meta.get("score_map"), meta.get("bins"), meta.get("labels"), na_value)))
            none.append(value.isNull().cast("int"))
            sources[m] = source
        pillar[p] = sum(scores, F.lit(0.0)) / max(1, len(scores))
        pillar_na[p] = sum(none, F.lit(0)) / max(1, len(none))
        missing += none
    score = 100 * sum((w * pillar.get(p, F.lit(0.5)) for p, w in weights.items()), F.lit(0.0))
    na = sum(missing, F.lit(0)) / max(1, len(missing))
    sure = confidence_of_na_rate(na, limit)
    of_map = lambda d: F.create_map(*(x for k, c in d.items() for x in (F.lit(k), c)))
    return features.select("firm_id", score.alias("score"), na.alias("na_rate"), sure.alias("confidence"), F.when(sure == "low", "review").otherwise("pass").alias("verdict"), of_map(pillar).alias("pillar_scores"), of_map(pillar_na).alias("pillar_na"), of_map(sources).alias("sources"))


def gate(scores: DataFrame, datapoints: DataFrame, mode: str = "relaxed", limit: float = 0.40) -> DataFrame:
    """firm_id, verdict (pass or review), confidence, na_rate and reasons (array) of each row of scores.

    scores: firm_id, na_rate (a share), confidence; datapoints: firm_id, key, value_json. soft passes all without
    reasons; relaxed reviews firms with technical errors only; strict reviews firms with any reason. Reasons come in the
    order of the rules; each technical error is named once, however many datapoints have it.
    """
    if mode not in ("soft", "relaxed", "strict"):
        raise ValueError(f"no such mode: {mode}")
    key = F.col("key")
    broken = (key == "rules_extracted_v0") & present(F.get_json_object("value_json", "$.error"))
    has = lambda name: key.isin([k for k, v in ERROR_KEYS.items() if v == name])
    seen = datapoints.groupBy("firm_id").agg(F.bool_or(has("crawl_error")).alias("crawl"), F.bool_or(has("extraction_error") | F.coalesce(broken, F.lit(False))).alias("extract"), F.bool_or(key.isin(DATA_KEYS)).alias("data"))
    d = scores.join(seen, "firm_id", "left")
    no = lambda c: F.coalesce(F.col(c), F.lit(False))
    na, sure = F.coalesce("na_rate", F.lit(0.0)), F.coalesce("confidence", F.lit("high"))
    if mode == "soft":
        return d.select("firm_id", F.lit("pass").alias("verdict"), sure.alias("confidence"), na.alias("na_rate"), F.array().cast("array<string>").alias("reasons"))
    reasons = F.array_compact(
        F.array(
            F.when(sure == "low", F.lit("low_confidence")),
            F.when(na > limit, F.concat(F.lit("na_rate_too_high_"), F.format_string("%.2f", na))),
            F.when(no("crawl"), F.lit("crawl_error")),
            F.when(no("extract"), F.lit("extraction_error")),
            F.when(~no("data"), F.lit("missing_key_data")),
        )
    )
    review = (no("crawl") | no("extract")) if mode == "relaxed" else F.size("reasons") > 0
    d = d.withColumn("reasons", reasons)
    return d.select("firm_id", F.when(review, "review").otherwise("pass").alias("verdict"), sure.alias("confidence"), na.alias("na_rate"), "reasons")


def audited(rules: Column) -> Column:
    """struct(status, confidence, red_flags) of rules (JSON text): how many required fields are there, and four warning signs."""
    value = lambda k: F.lower(F.coalesce(field(rules, k), F.lit("")))
    filled = lambda k: present(field(rules, k)) & ~field(rules, k).isin("0", "0.0", "false")
    required = ["profit_target", "daily_drawdown", "max_drawdown", "payout_split", "min_trading_days"]
    any_of = lambda c, *words: sum((c.contains(w).cast("int") for w in words), F.lit(0)) > 0
    ok = unwrapped(rules).isNotNull() & field(rules, "error").isNull()
    flags = F.array_compact(
        F.array(
            F.when(any_of(value("max_drawdown"), "unlimited", "no limit"), F.lit("max_drawdown_unlimited_claim")),
            F.when(value("news_trading").contains("always allowed") & value("notes").contains("spread"), F.lit("news_trading_may_be_marketing")),
            F.when(any_of(value("profit_target"), "0%", "zero", "no target"), F.lit("profit_target_unrealistic")),
            F.when(any_of(value("payout_split"), "100%", "100 %"), F.lit("payout_split_marketing_claim")),
        )
    )
    n = sum((F.when(filled(k), 1).otherwise(0) for k in required), F.lit(0))
    return F.struct(F.when(ok, "ok").otherwise("failed").alias("status"), F.when(ok, F.bround(n / len(required), 3)).otherwise(0.0).alias("confidence"), F.when(ok, flags).otherwise(F.array().cast("array<string>")).alias("red_flags"))


def pick(scores: Column, parts: list[str], exact: bool = False) -> Column:
    """The value of the first key, in lower case, that equals or holds one of these parts, part by part."""
    entries = F.map_entries(scores)
    of = lambda part: F.get(F.filter(entries, lambda e: ((F.lower(e["key"]) == part) if exact else F.lower(e["key"]).contains(part)) & e["value"].isNotNull()), 0)["value"]
    return F.coalesce(*(of(p) for p in parts))


def public_fields(records: DataFrame) -> DataFrame:
    """records with derived fields: four scores picked from pillars or metrics, jurisdiction, tier, headquarters, completeness and badge."""
    p, m = F.col("pillar_scores"), F.col("metric_scores")
    first = lambda a, b: F.coalesce(F.nullif(a, F.lit(0.0)), b)  # noqa: E731  a pillar of 0 gives way to the metric
    d = R.once(
        records,
        payout_reliability=first(pick(p, ["payout"]), pick(m, ["payout_reliability", "payout.reliability"], True)),
        risk_model_integrity=first(pick(p, ["risk"]), pick(m, ["risk_model_integrity", "risk.model_integrity"], True)),
        operational_stability=first(pick(p, ["operational", "stability", "reputation", "support"]), pick(m, ["operational_stability", "operational.stability"], True)),
        historical_consistency=first(pick(p, ["historical", "consistency"]), pick(m, ["historical_consistency", "historical.consistency"], True)),
        jurisdiction=or_else(F.col("jurisdiction"), E.url_country(F.col("website_root"))),
    )
    place = F.when(F.lower("jurisdiction").contains("global"), None).otherwise(F.col("jurisdiction"))
    d = R.once(d, headquarters=or_else(F.col("headquarters"), place))
    d = R.once(d, jurisdiction_tier=F.coalesce("jurisdiction_tier", E.jurisdiction_tier(F.col("jurisdiction")), E.jurisdiction_tier(F.col("headquarters"))))
    full = completeness()
    return d.withColumns({"data_completeness": F.bround(full, 3), "data_badge": V.band(full, [(0.75, "complete"), (0.45, "partial")], "incomplete")})


def overridden(records: DataFrame, overrides: DataFrame, fields: list[str]) -> DataFrame:
    """records with the fields that overrides (firm_id in lower case, and these fields) fill: blank ones replace nothing."""
    o = overrides.select(F.col("firm_id").alias("__o"), *(F.col(c).alias(f"__o_{c}") for c in fields))
    d = records.join(o, F.lower("firm_id") == F.col("__o"), "left")
    return d.withColumns({c: F.coalesce(F.when(F.trim(F.col(f"__o_{c}").cast("string")) != "", F.col(f"__o_{c}")), F.col(c)) for c in fields}).drop("__o", *(f"__o_{c}" for c in fields))


def public_snapshot(scores: DataFrame, audit: DataFrame, firms: DataFrame, datapoints: DataFrame, overrides: DataFrame | None = None, verdicts: tuple[str, ...] = ("pass",)) -> DataFrame:
    """Firms of a snapshot that the gate lets through, with their fields, scores and percentiles.

    scores and audit share snapshot_key, firm_id and version_key. Rules and pricing are each firm's newest datapoints, by
    created_at and id. The percentile is 0 for the best; firms without a model type or jurisdiction have none there.
    """
    keys = ["snapshot_key", "firm_id", "version_key"]
    d = scores.join(audit.filter(F.col("verdict").isin(list(verdicts))).select(*keys, "verdict", "reasons"), keys)
    new = R.latest_by(datapoints.filter(F.col("key").isin(DATA_KEYS[:4])), ["firm_id", "key"], "created_at", "id")
    wide = new.groupBy("firm_id").agg(*(F.max(F.when(F.col("key") == k, F.col("value_json"))).alias(k) for k in DATA_KEYS[:4]))
    d = d.join(firms, "firm_id", "left").join(wide, "firm_id", "left")
    made = {n: fields(unwrapped(or_else(F.col(a), F.col(b)), "rules", "value")) for n, (a, b) in {"__r": DATA_KEYS[:2], "__p": DATA_KEYS[2:4]}.items()}
    d, rules, pricing = R.once(d, **made), F.col("__r"), F.col("__p")
    d = R.once(
        d,
        display_name=or_else(F.col("brand_name"), F.col("name")),
        payout_frequency=or_else(at(pricing, "payout_frequency"), at(rules, "payout_frequency")),
        max_drawdown_rule=or_else(at(rules, "max_drawdown_rule"), at(rules, "max_drawdown")),
        daily_drawdown_rule=or_else(at(rules, "daily_drawdown_rule"), at(rules, "daily_drawdown")),
        rule_changes_frequency=or_else(at(rules, "rule_changes_frequency"), at(rules, "rule_change_frequency")),
    ).drop(*DATA_KEYS[:4], "__r", "__p")
    if overrides is not None:
        d = overridden(d, overrides, [c for c in overrides.columns if c != "firm_id"])
    d = kept(public_fields(d))  # read by each of the percentiles
    with_score = d.filter("score is not null")
    out = R.percentile_best0(with_score, "score", [], "percentile_vs_universe")
    for by, name in (("model_type", "percentile_vs_model_type"), ("jurisdiction", "percentile_vs_jurisdiction")):
        named = R.percentile_best0(with_score.filter(F.trim(by) != "").select("firm_id", by, "score"), "score", [by], name)
        out = out.join(named.select("firm_id", name), "firm_id", "left")
    return out.unionByName(d.filter("score is null"), allowMissingColumns=True)
