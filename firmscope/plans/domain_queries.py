"""Queries on the domain's own tables: records, scores, gate, public snapshot, agents' rules, validation, indices.

The tables are built from those at hand by SQL that both engines read alike (columns, concatenation, CASE, %); what is
under test is written once as DataFrame functions and once as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscope.functions import extract as E
from firmscope.functions import rules as L
from firmscope.functions import values as V
from firmscope.operators import relational as R
from firmscope.operators import scoring as C
from firmscope.operators import validation as A
from firmscope.operators.tables import kept
from firmscope.plans.extract_queries import choose, tier_sql, values, when_in
from firmscope.plans.firm_queries import PCT
from firmscope.plans.registry import Tables, query

K = "c_custkey"
FREQ = ["weekly", "monthly", "on demand", "bi-weekly", "", "sometimes"]
PLACES = ["US", "de", "KY", "", "Global", None, "XX", "United Kingdom"]
SITES = ["https://www.acme.co.uk", "acme.de", "https://x.io/a", None, "https://firm.com", "https://a.b.eu", ""]
RULES = (
    f"CASE {K} % 9 WHEN 0 THEN NULL WHEN 1 THEN '{{}}' ELSE CASE WHEN {K} % 2 = 0 THEN '{{\"value\":' ELSE '' END || '{{\"payout_frequency\":\"' || ({choose(f'{K} % 6', FREQ)}) || '\",\"max_drawdown\":\"' || ({K} % 13) || ' % of equity\",\"daily_drawdown\":\"' || ({choose(f'{K} % 4', ['5%', '', '4.5 %', 'none'])}) || '\",\"platform\":[\"mt' || ({K} % 5) || '\",\"x\"],\"notes\":\"' || c_mktsegment || '\",\"news_trading\":\"' || ({choose(f'{K} % 3', ['Always allowed', 'no', ''])}) || '\",\"profit_target\":\"' || ({choose(f'{K} % 5', ['10%', '8 %', 'zero', 'No target', ''])}) || '\",\"payout_split\":\"' || ({choose(f'{K} % 3', ['80%', '100%', ''])}) || '\"}}' || CASE WHEN {K} % 2 = 0 THEN '}}' ELSE '' END END"
).replace("{{", "{").replace("}}", "}")
PRICING = f"CASE WHEN {K} % 4 = 0 THEN NULL ELSE '{{\"payout_frequency\":\"' || ({choose(f'{K} % 6', ['', 'weekly', 'daily', '', 'biweekly', 'monthly'])}) || '\",\"payout_split_pct\":' || (60 + {K} % 40) || ',\"refund_policy\":\"' || ({choose(f'{K} % 2', ['', 'full'])}) || '\"}}' END".replace("{{", "{").replace("}}", "}")
RECORD = [
    f"'f' || {K} AS firm_id", f"{RULES} AS rules", f"{PRICING} AS pricing", f"{choose(f'{K} % 8', PLACES)} AS jurisdiction", f"CASE WHEN {K} % 3 = 0 THEN 'Tier 1' END AS jurisdiction_tier",
    f"CASE WHEN {K} % 5 = 0 THEN 'London' END AS headquarters", f"CASE WHEN {K} % 4 <> 1 THEN 2000 + {K} % 20 END AS founded_year", f"CASE WHEN {K} % 3 = 1 THEN 'weekly' END AS payout_frequency",
    f"CASE WHEN {K} % 7 = 1 THEN '9%' END AS max_drawdown_rule", f"CASE WHEN {K} % 7 = 2 THEN '3.5%' END AS daily_drawdown_rule", f"{choose(f'{K} % 6', ['monthly', None, 'rare', '', 'daily', 'odd'])} AS rule_changes_frequency",
    f"CASE WHEN {K} % 6 <> 0 THEN ({K} % 11) / CAST(10 AS DOUBLE) END AS reviews_sentiment", f"CASE WHEN {K} % 5 <> 0 THEN ({K} % 9) / CAST(8 AS DOUBLE) END AS support_quality",
]
RECORDS = f"records AS (SELECT {', '.join(RECORD)} FROM customer)"


def records(t: Tables) -> DataFrame:
    d = t.customer.selectExpr(*RECORD)
    return R.once(d, rules=F.col("rules"), pricing=F.col("pricing"))


def _j(c: str, k: str) -> str:
    return f"json_extract_string({c}, '$.{k}')"


def _present(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL AND CAST({c} AS VARCHAR) NOT IN ('', '[]', '{{}}') THEN 1 ELSE 0 END"


def _ratio(c: str, keys: list[str]) -> str:
    return f"CASE WHEN len(json_keys({c})) > 0 THEN ({' + '.join(_present(_j(c, k)) for k in keys)}) / {len(keys)}.0::DOUBLE END"


def _num(c: str) -> str:
    return f"try_cast(nullif(regexp_extract({c}, '([0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE)"


_else = lambda *cs: "coalesce(" + ", ".join(f"nullif({c}, '')" for c in cs) + ")"
DERIVED = (
    f"{RECORDS}, u AS (SELECT *, CASE WHEN json_type(rules, '$.value') = 'OBJECT' THEN CAST(json_extract(rules, '$.value') AS VARCHAR) ELSE rules END AS r, pricing AS p FROM records), derived AS (SELECT *, {when_in('lower(' + _else(_j('p', 'payout_frequency'), _j('r', 'payout_frequency')) + ')', E.DELAYS)} AS payout_delay_days,"
    f" round_even(coalesce({_ratio('p', C.PRICING_KEYS)}, {_ratio('r', C.PRICING_KEYS_OF_RULES)}), 3) AS payout_text_quality, round_even({_ratio('r', C.RULE_KEYS)}, 3) AS rules_page_quality,"
    f" nullif(length(trim(concat_ws(' ', nullif({_j('r', 'payout_frequency')}, ''), nullif({_j('r', 'max_drawdown')}, ''), nullif({_j('r', 'daily_drawdown')}, ''), array_to_string(json_extract_string(r, '$.platform[*]'), ' '), nullif({_j('r', 'notes')}, ''), nullif({_j('r', 'news_trading')}, ''), nullif({_j('r', 'profit_target')}, ''), nullif({_j('r', 'payout_split')}, '')))), 0) AS rules_length_signal,"
    f" {_num(_else('daily_drawdown_rule', _j('r', 'daily_drawdown')))} AS risk_max_daily_loss, {_num(_else('max_drawdown_rule', _j('r', 'max_drawdown')))} AS risk_max_total_loss, {when_in('lower(trim(' + _else('rule_changes_frequency', _j('r', 'rule_changes_frequency')) + '))', E.CHANGE_LEVELS)} AS rules_change_level, {_else('jurisdiction', 'jurisdiction_tier')} AS registry_country FROM u)"
)
FEATURES = ["payout_delay_days", "payout_text_quality", "rules_page_quality", "rules_length_signal", "risk_max_daily_loss", "risk_max_total_loss", "rules_change_level", "registry_country"]


@query(f"WITH {DERIVED} SELECT firm_id, {', '.join(FEATURES)} FROM derived")
def derived_features(t):
    return C.derived(records(t)).select("firm_id", *FEATURES)


def _bin(c: str, bins: list, weights: list, na: float) -> str:
    return f"CASE WHEN {c} IS NULL THEN {na}::DOUBLE " + " ".join(f"WHEN {c} <= {b} THEN {w}::DOUBLE" for b, w in zip(bins, weights, strict=True)) + f" ELSE {weights[-1]}::DOUBLE END"


def _country(c: str) -> str:
    return f"CASE WHEN coalesce({c}, '') = '' THEN 0.1::DOUBLE " + " ".join(f"WHEN upper({c}) = '{k}' THEN {v}::DOUBLE" for k, v in C.COUNTRY_SCORES.items()) + " ELSE 0.1::DOUBLE END"


_metric = {m: _country(m) if how == "jurisdiction" else _bin(m, *how, 0.6) for of in C.PILLARS.values() for m, how in of.items()}
_pillar = {p: f"(({' + '.join(_metric[m] for m in of)}) / {len(of)})" for p, of in C.PILLARS.items()}
_full = "((" + " + ".join(_present(k) for k in C.COMPLETE_KEYS) + ") / 8.0::DOUBLE)"
SCORED = (
    f"{DERIVED}, scored AS (SELECT firm_id, jurisdiction_tier, jurisdiction, founded_year, 100 * ({' + '.join(f'{C.WEIGHTS[p]}::DOUBLE * {x}' for p, x in _pillar.items())}) / {sum(C.WEIGHTS.values())} AS raw, ({' + '.join(f'CASE WHEN {m} IS NULL THEN 1 ELSE 0 END' for m in _metric)}) / {len(_metric)}.0::DOUBLE AS na_rate, {_full} AS full_, {_pillar['A_transparency']} AS pa, {_pillar['B_payout_reliability']} AS pb, {_pillar['C_risk_model']} AS pc, {_pillar['D_legal_compliance']} AS pd, {_pillar['E_reputation_support']} AS pe FROM derived),"
    " scores AS (SELECT firm_id, jurisdiction_tier, jurisdiction, round_even(raw, 2) AS score, na_rate, round_even(full_, 3) AS completeness, CASE WHEN full_ >= 0.75 THEN 'high' WHEN full_ >= 0.45 THEN 'medium' ELSE 'low' END AS confidence, pa, pb, pc, pd, pe FROM scored)"
)


def scores(t: Tables) -> DataFrame:
    return C.scored(C.derived(records(t)))


@query(f"WITH {SCORED} SELECT firm_id, round(score, 1) AS score, round(na_rate, 6) AS na_rate, completeness, confidence, round(pa, 3) AS transparency, round(pc, 3) AS risk_model FROM scores")
def score_live(t):
    p = F.col("pillar_scores")
    return scores(t).select("firm_id", F.round("score", 1).alias("score"), F.round("na_rate", 6).alias("na_rate"), "completeness", "confidence", F.round(p["A_transparency"], 3).alias("transparency"), F.round(p["C_risk_model"], 3).alias("risk_model"))


@query(f"WITH {SCORED} SELECT count(*) AS firms, round(avg(score), 2) AS avg_score, min(score) AS min_score, max(score) AS max_score FROM scores")
def score_run_summary(t):
    return C.run_summary(scores(t))


@query(f"WITH {SCORED} SELECT count(*) AS firms, coalesce(round(avg(score), 2), 0) AS avg_score, coalesce(min(score), 0) AS min_score, coalesce(max(score), 0) AS max_score FROM scores WHERE score > 100")
def score_run_empty(t):
    """A run without firms: no score is above 100."""
    return C.run_summary(scores(t).filter("score > 100"))


SPEC = {
    "na_policy": {"na_value": 0.5, "pillar_na_rate_review_threshold": 0.45, "firm_na_rate_review_threshold": 0.40},
    "pillars": {
        "payout": {"metrics": {"delay": {"type": "int", "score_map": "bins", "bins": [3, 7, 14, 30], "labels": [1.0, 0.8, 0.6, 0.4, 0.2], "fallback": ["hint"]}, "open": {"type": "bool", "score_map": {"true": 1.0, "false": 0.4}}}},
        "legal": {"metrics": {"where": {"type": "text", "score_map": "jurisdiction_matrix_v1", "fallback": ["seat", "hint"]}, "kind": {"type": "enum", "score_map": {"Strong": 1.2, "weak": 0.3}}}},
        "trust": {"metrics": {"risk": {"type": "pct", "score_map": "inverse"}, "trust": {"type": "pct", "score_map": "identity"}}},
    },
}
SPEC_WEIGHTS = {"payout": 0.4, "legal": 0.3, "trust": 0.2, "other": 0.1}
FEATURE = {
    "delay": choose(f"{K} % 7", ["2", None, "8", "31", "x", None, "7"]), "hint": choose(f"{K} % 3", ["5", None, "14"]), "open": choose(f"{K} % 5", ["Yes", "no", None, "maybe", "1"]), "where": choose(f"{K} % 6", ["usa", None, "Dubai Marina", "Grand Cayman", "", "Mars"]),
    "seat": choose(f"{K} % 4", [None, "St. Vincent", "uk", None]), "kind": choose(f"{K} % 4", ["STRONG", "weak ", None, "other"]), "risk": choose(f"{K} % 5", ["0.25", "1.5", None, "-1", "abc"]), "trust": choose(f"{K} % 3", ["0.9", None, "NaN"]),
}
_feats = "fx AS (SELECT 'f' || c_custkey AS firm_id, " + ", ".join(f"{e} AS f_{k}" for k, e in FEATURE.items()) + " FROM customer)"
_dbl = lambda c: f"try_cast({c} AS DOUBLE)"
_unit = lambda c: f"CASE WHEN {c} IS NULL OR isnan({c}) THEN 0.5::DOUBLE ELSE greatest(0, least(1, {c})) END"
_delay, _where = "coalesce(f_delay, f_hint)", "coalesce(f_where, f_seat, f_hint)"
_region = f"CASE WHEN {_where} = '' THEN 0.5::DOUBLE " + " ".join(f"WHEN lower(trim({_where})) = '{k}' THEN {v}::DOUBLE" for k, v in C.REGIONS.items()) + " " + " ".join(f"WHEN contains(lower(trim({_where})), '{k}') THEN {v}::DOUBLE" for k, v in C.REGIONS.items()) + " ELSE 0.5::DOUBLE END"
_spec = {
    "payout": [
        f"CASE WHEN {_delay} IS NULL OR {_dbl(_delay)} IS NULL THEN 0.5::DOUBLE WHEN {_dbl(_delay)} <= 3 THEN 1.0 WHEN {_dbl(_delay)} <= 7 THEN 0.8 WHEN {_dbl(_delay)} <= 14 THEN 0.6 WHEN {_dbl(_delay)} <= 30 THEN 0.4 ELSE 0.2 END",
        "CASE WHEN lower(f_open) IN ('yes', '1') THEN 1.0::DOUBLE WHEN lower(f_open) = 'no' THEN 0.4 ELSE 0.5 END",
    ],
    "legal": [f"CASE WHEN {_where} IS NULL THEN 0.5::DOUBLE ELSE {_region} END", "CASE lower(trim(f_kind)) WHEN 'strong' THEN 1.0::DOUBLE WHEN 'weak' THEN 0.3 ELSE 0.5 END"],
    "trust": [f"CASE WHEN f_risk IS NULL THEN 0.5::DOUBLE ELSE 1 - ({_unit(_dbl('f_risk'))}) END", f"CASE WHEN f_trust IS NULL THEN 0.5::DOUBLE ELSE {_unit(_dbl('f_trust'))} END"],
}
_none = [f"({c} IS NULL)::INT" for c in (_delay, "f_open", _where, "f_kind", "f_risk", "f_trust")]


@query(
    f"WITH {_feats}, s AS (SELECT firm_id, 100 * (0.4 * (({_spec['payout'][0]}) + ({_spec['payout'][1]})) / 2 + 0.3 * (({_spec['legal'][0]}) + ({_spec['legal'][1]})) / 2 + 0.2 * (({_spec['trust'][0]}) + ({_spec['trust'][1]})) / 2 + 0.1 * 0.5) AS score, ({' + '.join(_none)}) / 6.0::DOUBLE AS na_rate, CASE WHEN f_delay IS NOT NULL THEN 'primary' WHEN f_hint IS NOT NULL THEN 'fallback:hint' ELSE 'NA' END AS source, ({_none[2]} + {_none[3]}) / 2.0::DOUBLE AS legal_na FROM fx)"
    " SELECT firm_id, round(score, 6)::DOUBLE AS score, round(na_rate, 6) AS na_rate, CASE WHEN na_rate <= 0.2 THEN 'high' WHEN na_rate <= 0.4 THEN 'medium' ELSE 'low' END AS confidence, CASE WHEN na_rate <= 0.4 THEN 'pass' ELSE 'review' END AS verdict, source, legal_na FROM s"
)
def score_spec(t):
    f = F.create_map(*(x for k, e in FEATURE.items() for x in (F.lit(k), F.expr(e))))
    d = C.scored_by_spec(t.customer.select(F.concat(F.lit("f"), K).alias("firm_id"), f.alias("f")), SPEC, SPEC_WEIGHTS)
    return d.select("firm_id", F.round("score", 6).alias("score"), F.round("na_rate", 6).alias("na_rate"), "confidence", "verdict", F.col("sources")["delay"].alias("source"), F.col("pillar_na")["legal"].alias("legal_na"))


DP_KEYS = ["rules_extracted_v0", "pricing_extracted_v0", "crawl_error", "discovered_links", "rules_extract_error", "other", "http_error", "rules_extracted_from_home_v0"]
POINT = ["event_id AS id", "'f' || (1 + user_id % 400) AS firm_id", f"{choose('event_id % 23', [*DP_KEYS[:2], *DP_KEYS[:2], 'other', 'other', *DP_KEYS[:2], 'other', 'other', 'other', *DP_KEYS, 'other', 'other', 'other', 'other'])} AS key", "CASE WHEN event_id % 50 = 0 THEN '{\"error\":\"x\"}' WHEN event_id % 3 = 0 THEN '{\"rules\":{\"payout_frequency\":\"weekly\",\"max_drawdown\":\"' || (event_id % 10) || '%\"}}' ELSE '{\"payout_frequency\":\"\",\"daily_drawdown\":\"4%\",\"rule_change_frequency\":\"monthly\"}' END AS value_json", "ts AS created_at", "CASE WHEN event_id % 4 = 0 THEN 'u' END AS source_url", "CASE WHEN event_id % 5 = 0 THEN 'h' END AS evidence_hash"]
POINTS = f"points AS (SELECT {', '.join(POINT)} FROM events)"


def points(t: Tables) -> DataFrame:
    return t.events.selectExpr(*POINT)


FLAGS = f"{SCORED}, {POINTS}, fl AS (SELECT firm_id, bool_or(key IN ('crawl_error', 'http_error')) AS c, bool_or(key IN ('rules_extract_error', 'pricing_extract_error') OR (key = 'rules_extracted_v0' AND coalesce(json_extract_string(value_json, '$.error'), '') <> '')) AS x, bool_or(key IN ('rules_extracted_v0', 'rules_extracted_from_home_v0', 'pricing_extracted_v0', 'pricing_extracted_from_home_v0', 'discovered_links')) AS d FROM points GROUP BY 1), g AS (SELECT s.firm_id, s.na_rate, s.confidence, coalesce(c, false) AS c, coalesce(x, false) AS x, concat_ws(',', CASE WHEN s.confidence = 'low' THEN 'low_confidence' END, CASE WHEN s.na_rate > 0.4 THEN 'na_rate_too_high_' || printf('%.2f', s.na_rate) END, CASE WHEN c THEN 'crawl_error' END, CASE WHEN x THEN 'extraction_error' END, CASE WHEN NOT coalesce(d, false) THEN 'missing_key_data' END) AS reasons FROM scores s LEFT JOIN fl USING (firm_id))"


def _gate(mode: str):
    return lambda t: C.gate(scores(t), points(t), mode).select("firm_id", "verdict", "confidence", F.round("na_rate", 6).alias("na_rate"), F.array_join("reasons", ",").alias("reasons"))


@query(f"WITH {FLAGS} SELECT firm_id, CASE WHEN reasons = '' THEN 'pass' ELSE 'review' END AS verdict, confidence, round(na_rate, 6) AS na_rate, reasons FROM g")
def oversight_strict(t):
    return _gate("strict")(t)


@query(f"WITH {FLAGS} SELECT firm_id, CASE WHEN c OR x THEN 'review' ELSE 'pass' END AS verdict, confidence, round(na_rate, 6) AS na_rate, reasons FROM g")
def oversight_relaxed(t):
    return _gate("relaxed")(t)


@query(f"WITH {SCORED} SELECT firm_id, 'pass' AS verdict, confidence, round(na_rate, 6) AS na_rate, '' AS reasons FROM scores")
def oversight_soft(t):
    return _gate("soft")(t)


@query(f"WITH {RECORDS}, n AS (SELECT firm_id, rules, {', '.join(f'lower(coalesce({_j(chr(114) + chr(117) + chr(108) + chr(101) + chr(115), k)}, {chr(39) * 2})) AS {k}_' for k in ('max_drawdown', 'news_trading', 'notes', 'profit_target', 'payout_split', 'daily_drawdown', 'min_trading_days'))} FROM records) SELECT firm_id, CASE WHEN rules IS NULL THEN 'failed' ELSE 'ok' END AS status, CASE WHEN rules IS NULL THEN 0 ELSE round_even(((profit_target_ <> '')::INT + (daily_drawdown_ <> '')::INT + (max_drawdown_ <> '')::INT + (payout_split_ <> '')::INT + (min_trading_days_ <> '')::INT) / 5.0, 3) END::DOUBLE AS confidence, CASE WHEN rules IS NULL THEN '' ELSE concat_ws(',', CASE WHEN contains(max_drawdown_, 'unlimited') OR contains(max_drawdown_, 'no limit') THEN 'max_drawdown_unlimited_claim' END, CASE WHEN contains(news_trading_, 'always allowed') AND contains(notes_, 'spread') THEN 'news_trading_may_be_marketing' END, CASE WHEN contains(profit_target_, '0%') OR contains(profit_target_, 'zero') OR contains(profit_target_, 'no target') THEN 'profit_target_unrealistic' END, CASE WHEN contains(payout_split_, '100%') OR contains(payout_split_, '100 %') THEN 'payout_split_marketing_claim' END) END AS red_flags FROM n")
def rules_audit(t):
    return records(t).select("firm_id", C.audited(F.col("rules")).alias("a")).select("firm_id", "a.status", "a.confidence", F.array_join("a.red_flags", ",").alias("red_flags"))


FIRM = ["'f' || c_custkey AS firm_id", f"CASE WHEN {K} % 6 = 0 THEN '' ELSE c_name END AS brand_name", "'Firm ' || c_custkey AS name", f"{choose(f'{K} % 7', SITES)} AS website_root", "CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE c_mktsegment END AS model_type", f"{choose(f'{K} % 8', ['', None, 'Global', 'Singapore', 'Cayman Islands', None, 'Neuchatel', 'uk'])} AS jurisdiction", "CASE WHEN c_custkey % 4 = 0 THEN 'Tier 9' END AS jurisdiction_tier", "CASE WHEN c_custkey % 3 = 0 THEN 'Town' END AS headquarters", "CASE WHEN c_custkey % 2 = 0 THEN 2001 END AS founded_year"]
OVER = ["'f' || c_custkey AS firm_id", "CASE WHEN c_custkey % 20 = 0 THEN ' ' ELSE 'Berlin' END AS headquarters", "CASE WHEN c_custkey % 30 = 0 THEN 'Renamed ' || c_custkey END AS display_name"]
_tld = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in E.COUNTRY_OF_TLD.items()) + "}"
_url = "lower(regexp_extract(CASE WHEN website_root LIKE 'http%' THEN website_root ELSE 'https://' || website_root END, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1))"
_obj = lambda c: f"CASE WHEN json_type({c}, '$.rules') = 'OBJECT' THEN CAST(json_extract({c}, '$.rules') AS VARCHAR) ELSE {c} END"
PUBLIC = (
    f"{FLAGS}, firms AS (SELECT {', '.join(FIRM)} FROM customer), ov AS (SELECT {', '.join(OVER)} FROM customer WHERE c_custkey % 10 = 0), lp AS (SELECT firm_id, key, value_json FROM points WHERE key IN ('rules_extracted_v0', 'rules_extracted_from_home_v0', 'pricing_extracted_v0', 'pricing_extracted_from_home_v0') QUALIFY row_number() OVER (PARTITION BY firm_id, key ORDER BY created_at DESC, id DESC) = 1),"
    " w AS (SELECT firm_id, max(CASE WHEN key = 'rules_extracted_v0' THEN value_json END) AS r0, max(CASE WHEN key = 'rules_extracted_from_home_v0' THEN value_json END) AS r1, max(CASE WHEN key = 'pricing_extracted_v0' THEN value_json END) AS p0, max(CASE WHEN key = 'pricing_extracted_from_home_v0' THEN value_json END) AS p1 FROM lp GROUP BY 1),"
    f" b AS (SELECT s.firm_id, s.score, s.pa, s.pb, s.pc, s.pe, f.brand_name, f.name, f.website_root, f.model_type, f.jurisdiction, f.jurisdiction_tier, f.headquarters, f.founded_year, {_obj('coalesce(r0, r1)')} AS r, {_obj('coalesce(p0, p1)')} AS p FROM scores s JOIN g USING (firm_id) JOIN firms f USING (firm_id) LEFT JOIN w USING (firm_id) WHERE NOT (g.c OR g.x)),"
    f" c1 AS (SELECT b.*, {_else(_j('p', 'payout_frequency'), _j('r', 'payout_frequency'))} AS payout_frequency, {_else(_j('r', 'max_drawdown_rule'), _j('r', 'max_drawdown'))} AS max_drawdown_rule, {_else(_j('r', 'daily_drawdown_rule'), _j('r', 'daily_drawdown'))} AS daily_drawdown_rule, {_else(_j('r', 'rule_changes_frequency'), _j('r', 'rule_change_frequency'))} AS rule_changes_frequency, coalesce(CASE WHEN trim(o.display_name) <> '' THEN o.display_name END, nullif(b.brand_name, ''), b.name) AS display_name, coalesce(CASE WHEN trim(o.headquarters) <> '' THEN o.headquarters END, b.headquarters) AS hq0 FROM b LEFT JOIN ov o ON lower(b.firm_id) = o.firm_id),"
    f" c2 AS (SELECT *, coalesce(nullif(jurisdiction, ''), coalesce(({_tld})[array_to_string(string_split({_url}, '.')[greatest(len(string_split({_url}, '.')) - 1, 1):], '.')], ({_tld})[string_split({_url}, '.')[-1]])) AS j FROM c1), c3 AS (SELECT *, coalesce(nullif(hq0, ''), CASE WHEN lower(j) LIKE '%global%' THEN NULL ELSE j END) AS hq FROM c2), c4 AS (SELECT *, coalesce(jurisdiction_tier, {tier_sql('j', True)}, {tier_sql('hq', True)}) AS tier FROM c3),"
    f" c5 AS (SELECT *, ({' + '.join(_present(x) for x in ('payout_frequency', 'max_drawdown_rule', 'daily_drawdown_rule', 'rule_changes_frequency', 'j', 'tier', 'hq', 'founded_year'))}) / 8.0::DOUBLE AS full_ FROM c4)"
)
_pct = lambda by: PCT.format(p=f"PARTITION BY {by}" if by else "")


@query(
    f"WITH {PUBLIC} SELECT firm_id, display_name, payout_frequency, daily_drawdown_rule, rule_changes_frequency, j AS jurisdiction, tier AS jurisdiction_tier, hq AS headquarters, round_even(full_, 3) AS data_completeness, CASE WHEN full_ >= 0.75 THEN 'complete' WHEN full_ >= 0.45 THEN 'partial' ELSE 'incomplete' END AS data_badge, round(pb, 2) AS payout_reliability, round(pe, 2) AS operational_stability, {_pct('')} AS percentile_vs_universe, CASE WHEN trim(model_type) <> '' THEN {_pct('model_type')} END AS percentile_vs_model_type, CASE WHEN trim(coalesce(j, '')) <> '' THEN {_pct('j')} END AS percentile_vs_jurisdiction FROM c5"
)
def public_snapshot(t):
    key = {"snapshot_key": F.lit("s1"), "version_key": F.lit("v1")}
    s = kept(scores(t).withColumns(key))
    audit = C.gate(s, points(t)).withColumns(key)
    d = C.public_snapshot(s, audit, t.customer.selectExpr(*FIRM), points(t), t.customer.filter("c_custkey % 10 = 0").selectExpr(*OVER))
    keep = ["firm_id", "display_name", "payout_frequency", "daily_drawdown_rule", "rule_changes_frequency", "jurisdiction", "jurisdiction_tier", "headquarters", "data_completeness", "data_badge"]
    return d.select(*keep, F.round("payout_reliability", 2).alias("payout_reliability"), F.round("operational_stability", 2).alias("operational_stability"), "percentile_vs_universe", "percentile_vs_model_type", "percentile_vs_jurisdiction")


# rules of the agents, over a grid of cases

GRID = ["event_id AS id", "(event_id % 40) / CAST(100 AS DOUBLE) AS share", "CAST(event_id % 20 AS INT) AS n", "CAST(0.8 + (event_id % 21) / CAST(100 AS DOUBLE) AS DOUBLE) AS rate", "CAST(event_id % 50 - 10 AS INT) AS days", "event_id % 3 <> 0 AS a", "event_id % 7 <> 0 AS b", f"{choose('event_id % 4', ['active', 'flagged', None, 'ok'])} AS status", f"{choose('event_id % 3', ['complete', 'incomplete', None])} AS filings", f"{choose('event_id % 5', ['BZ', 'US', 'KY', None, 'VG'])} AS country", "(event_id % 13) / CAST(10 AS DOUBLE) AS x"]
_grid = f"g AS (SELECT {', '.join(GRID)} FROM events)"
RULE_SQL = {
    "surge": ["share > 0.25", -0.6, 0.9, "share > 0.15", -0.35, 0.85, 0.8, []],
    "payout": ["n > 15", -0.75, 0.95, "n > 8", -0.45, 0.90, 0.85, [("rate < 0.90", 0.3, -0.5, 0.92)]],
    "trend": ["x - rate < -0.30", -0.55, 0.88, "x - rate < -0.15", -0.30, 0.85, 0.80, [("(rate - x) / 4 > 0.08", 0.2, -0.4, 0.90)]],
    "domain": ["days < 0", -0.80, 0.99, "days < 30", -0.50, 0.95, 0.85, [("NOT a", 0.3, -0.6, 0.98), ("NOT b", 0.25, -0.5, 0.90)]],
    "company": ["NOT a", -0.85, 0.99, "status = 'flagged'", -0.60, 0.90, 0.80, [("filings = 'incomplete'", 0.25, -0.4, 0.85), ("country IN ('BZ', 'VG', 'KY')", 0.20, -0.35, 0.80)]],
    "news": ["CASE WHEN n + days + 10 > 0 THEN n / (n + days + 10.0) ELSE 0 END > 0.30", -0.55, 0.85, "CASE WHEN n + days + 10 > 0 THEN n / (n + days + 10.0) ELSE 0 END > 0.15", -0.30, 0.80, 0.80, [("n > 5", 0.25, -0.5, 0.90)]],
    "patterns": ["x > 0.60", -0.85, 0.92, "x > 0.40", -0.55, 0.88, 0.85, [("a::INT + b::INT + (n > 10)::INT >= 3", 0.30, -0.6, 0.90), ("a::INT + b::INT + (n > 10)::INT = 2", 0.20, -0.4, 0.85)]],
}


def _rule_sql(name: str) -> str:
    c1, i1, s1, c2, i2, s2, base, more = RULE_SQL[name]
    impact, sure, issue = f"CASE WHEN {c1} THEN {i1}::DOUBLE WHEN {c2} THEN {i2}::DOUBLE ELSE 0::DOUBLE END", f"CASE WHEN {c1} THEN {s1}::DOUBLE WHEN {c2} THEN {s2}::DOUBLE ELSE {base}::DOUBLE END", f"coalesce({c1}, false) OR coalesce({c2}, false)"
    for c, less, most, s in more:
        impact, sure, issue = f"CASE WHEN {c} THEN least({impact} - {less}, {most}) ELSE {impact} END", f"CASE WHEN {c} THEN {s}::DOUBLE ELSE {sure} END", f"{issue} OR coalesce({c}, false)"
    return f"SELECT id, '{name}' AS rule, {issue} AS has_issue, {sure} AS confidence, round({impact}, 4)::DOUBLE AS impact FROM g"


@query(f"WITH {_grid} " + " UNION ALL ".join(_rule_sql(n) for n in RULE_SQL))
def agent_rules(t):
    c = F.col
    rules = {
        "surge": L.review_surge(c("share")), "payout": L.payout_complaints(c("n"), c("rate")), "trend": L.sentiment_trend(c("x"), c("rate")), "domain": L.domain(c("days"), c("a"), c("b")),
        "company": L.company(c("a"), c("status"), c("filings"), c("country")), "news": L.news(c("days") + 10, c("n"), F.lit(0), c("n")), "patterns": L.patterns(c("x"), [c("a"), c("b"), c("n") > 10]),
    }
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("rule"), v.alias("r")) for k, v in rules.items())))
    return t.events.selectExpr(*GRID).select("id", rows.alias("x")).select("id", "x.rule", "x.r.has_issue", "x.r.confidence", F.round("x.r.impact", 4).alias("impact"))


_lic, _sev, _kind, _rep = ["active", "suspended", "revoked", "expired", "unknown", "x"], ["critical", "high", "medium", "low", "x"], ["payout_problem", "regulatory_approval", "other", "fund_segregation"], ["compliant", "conditional", "non_compliant"]
IMPACT = ["event_id AS id", f"{choose('event_id % 6', _lic)} AS lic", f"{choose('event_id % 5', _sev)} AS sev", f"{choose('event_id % 4', _kind)} AS kind", f"{choose('event_id % 3', _rep)} AS rep", "CAST(event_id % 7 AS INT) AS n", "event_id % 4 AS m", "value / 100 AS best"]


@query(
    f"WITH i AS (SELECT {', '.join(IMPACT)} FROM events) SELECT id, CASE lic WHEN 'active' THEN CASE WHEN n > 3 THEN 0.1::DOUBLE ELSE 0.2 END WHEN 'suspended' THEN -0.7 WHEN 'revoked' THEN -1.0 WHEN 'expired' THEN -0.8 ELSE 0.0 END AS license, CASE WHEN m = 0 THEN 0.0::DOUBLE WHEN m = 1 THEN -1.0 WHEN best > 0.9 THEN -0.7 WHEN best > 0.75 THEN -0.4 ELSE -0.1 END AS watchlist,"
    " round(CASE WHEN kind = 'regulatory_approval' THEN 0.3::DOUBLE WHEN sev = 'critical' THEN -0.9 WHEN sev = 'high' THEN -0.5 WHEN sev = 'medium' THEN -0.2 WHEN sev = 'low' THEN 0.1 ELSE 0 END * CASE WHEN kind IN ('payout_problem', 'fund_segregation') THEN 1.2 ELSE 1 END, 6)::DOUBLE AS submission, CASE rep WHEN 'compliant' THEN 0.0::DOUBLE WHEN 'conditional' THEN -0.4 ELSE -0.8 END AS report,"
    " CASE WHEN n >= 5 THEN 'critical' WHEN n >= 3 THEN 'high' WHEN n >= 1 THEN 'medium' ELSE 'low' END AS risk, CASE WHEN n >= 5 THEN 20 WHEN n >= 3 THEN 40 WHEN n >= 1 THEN 65 ELSE 85 END AS score FROM i"
)
def agent_impacts(t):
    c = F.col
    types = F.when(c("m") == 0, F.array().cast("array<string>")).when(c("m") == 1, F.array(F.lit("PEP"), F.lit("UN"))).otherwise(F.array(F.lit("EU")))
    limits = F.when(c("n") > 3, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    d = t.events.selectExpr(*IMPACT)
    k = L.compliance(c("n"))
    return d.select("id", L.license_impact(c("lic"), limits).alias("license"), L.watchlist_impact(types, c("best")).alias("watchlist"), F.round(L.submission_impact(c("sev"), c("kind")), 6).alias("submission"), L.report_impact(c("rep")).alias("report"), k["risk"].alias("risk"), k["score"].alias("score"))


# validation

PREV = "prev AS (SELECT firm_id, greatest(0, least(100, score + (CAST(substr(firm_id, 2) AS INT) % 9) - 4)) AS score, jurisdiction_tier FROM scores WHERE CAST(substr(firm_id, 2) AS INT) % 11 <> 0)"


def previous(s: DataFrame) -> DataFrame:
    k = F.substr("firm_id", F.lit(2)).cast("int")
    return s.filter(k % 11 != 0).withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("score") + k % 9 - 4)))


def with_tier(t: Tables) -> DataFrame:
    return scores(t).join(records(t).select("firm_id", "jurisdiction_tier"), "firm_id")


@query(f"WITH {FLAGS}, v AS (SELECT firm_id, CASE WHEN c OR x THEN 'review' ELSE 'pass' END AS verdict FROM g) SELECT (SELECT count(DISTINCT firm_id) FROM scores) AS total_firms, 100.0::DOUBLE AS coverage_percent, (SELECT round(avg(na_rate) * 100, 2) FROM scores) AS avg_na_rate, (SELECT round(100.0 * count(*) FILTER (WHERE verdict = 'pass') / count(*), 2)::DOUBLE FROM v) AS agent_c_pass_rate")
def validate_coverage(t):
    return A.coverage(scores(t), C.gate(scores(t), points(t)))


def _entered(k: int, a: str, b: str) -> str:
    top = lambda d: f"(SELECT firm_id FROM {d} ORDER BY score DESC NULLS LAST, firm_id LIMIT {k})"
    return f"(SELECT count(*) FROM ({top(a)} EXCEPT {top(b)}))"


@query(f"WITH {SCORED}, {PREV} SELECT (SELECT round(avg(abs(s.score - p.score)), 4) FROM scores s JOIN prev p USING (firm_id)) AS avg_score_change, {_entered(10, 'scores', 'prev')} AS top_10_turnover, {_entered(10, 'prev', 'scores')} AS top_10_left, {_entered(20, 'scores', 'prev')} AS top_20_turnover, {_entered(20, 'prev', 'scores')} AS top_20_left, (SELECT round(100.0 * count(*) FILTER (WHERE (s.score >= 50) <> (p.score >= 50)) / count(*), 2)::DOUBLE FROM scores s JOIN prev p USING (firm_id)) AS verdict_churn_rate")
def validate_stability(t):
    s = scores(t)
    verdict = lambda d: d.select("firm_id", F.when(F.col("score") >= 50, "pass").otherwise("review").alias("verdict"))
    return A.stability(s, previous(s), (verdict(s), verdict(previous(s))))


TRUTH = ["o_orderkey AS event_id", "CASE WHEN o_orderkey % 3 <> 0 THEN 'f' || o_custkey END AS firm_id", "CASE WHEN o_orderkey % 5 <> 0 THEN 'Firm ' || o_custkey END AS firm_name", "o_orderdate AS event_date", f"{choose('o_orderkey % 6', ['regulatory_action', 'fraud', 'award', 'payout_failure', None, 'license_revoked'])} AS event_type", f"{choose('o_orderkey % 4', ['high', 'medium', 'low', None])} AS severity"]
_truth = f"ev AS (SELECT {', '.join(TRUTH)} FROM orders), asof_ AS (SELECT max(o_orderdate) AS d FROM orders)"


def as_of(t: Tables):
    return F.lit(t.orders.agg(F.max("o_orderdate")).first()[0])


@query(f"WITH {SCORED}, {_truth}, i AS (SELECT ev.* FROM ev, asof_ WHERE event_date BETWEEN d - INTERVAL 90 DAY AND d), weak AS (SELECT firm_id, 'Firm ' || substr(firm_id, 2) AS nm FROM scores WHERE na_rate > 0.5 OR score < 40), p AS (SELECT count(*) AS n FROM i WHERE EXISTS (SELECT 1 FROM weak w WHERE (i.firm_id IS NOT NULL AND i.firm_id = w.firm_id) OR (i.firm_id IS NULL AND i.firm_name IS NOT NULL AND i.firm_name = w.nm))) SELECT (SELECT count(*) FROM i) AS events_in_period, (SELECT n FROM p) AS events_predicted, round(100.0 * (SELECT n FROM p) / (SELECT count(*) FROM i), 2)::DOUBLE AS prediction_precision")
def validate_ground_truth(t):
    firms = t.customer.select(F.concat(F.lit("f"), K).alias("firm_id"), F.concat(F.lit("Firm "), K).alias("brand_name"))
    return A.ground_truth(t.orders.selectExpr(*TRUTH), scores(t), firms, as_of(t))


@query(f"WITH {SCORED}, p AS (SELECT firm_id, score, unnest(['A_transparency', 'B_payout_reliability', 'C_risk_model', 'D_legal_compliance', 'E_reputation_support']) AS k, unnest([0.25, 0.25, 0.2, 0.2, 0.1]::DOUBLE[]) AS w, unnest([round_even(pa, 3), round_even(pb, 3), round_even(pc, 3), round_even(pd, 3), round_even(pe, 3)]) AS p FROM scores), q AS (SELECT *, sum(w) OVER (PARTITION BY firm_id) AS tw, sum(w * p) OVER (PARTITION BY firm_id) AS ts FROM p), a AS (SELECT avg(abs(100 * (ts - w * p) / (tw - w) - score)) AS m, 100.0 * count(*) FILTER (WHERE p = 0.5) / count(*) AS f FROM q) SELECT round(m, 4) AS pillar_sensitivity_mean, round(f, 2)::DOUBLE AS fallback_usage_percent, round(greatest(0, 100 - (m + f)), 2)::DOUBLE AS stability_score FROM a")
def validate_sensitivity(t):
    return A.sensitivity(scores(t), C.WEIGHTS)


@query(f"WITH {SCORED}, firms AS (SELECT 'f' || c_custkey AS firm_id, c_mktsegment AS model_type FROM customer), m AS (SELECT model_type, avg(score) AS m FROM scores JOIN firms USING (firm_id) GROUP BY 1) SELECT (SELECT round(skewness(score), 4) FROM scores) AS score_distribution_skew, (SELECT round(max(m) - min(m), 2) FROM m) AS model_type_bias_score")
def validate_bias(t):
    return A.bias(scores(t), t.customer.select(F.concat(F.lit("f"), K).alias("firm_id"), F.col("c_mktsegment").alias("model_type")))


@query(f"WITH {SCORED}, {POINTS}, l AS (SELECT firm_id FROM points WHERE source_url IS NOT NULL OR evidence_hash IS NOT NULL UNION SELECT 'f' || s_suppkey FROM supplier WHERE s_acctbal > 0) SELECT round(100.0 * count(*) FILTER (WHERE firm_id IN (SELECT firm_id FROM l)) / count(*), 2)::DOUBLE AS evidence_linkage_rate, 'v1' AS version_metadata FROM scores")
def validate_auditability(t):
    s = scores(t).withColumn("version_key", F.when(F.substr("firm_id", F.lit(2)).cast("int") % 3 == 0, "v0").otherwise("v1"))
    evidence = t.supplier.select(F.concat(F.lit("f"), "s_suppkey").alias("firm_id"), F.lit(None).cast("string").alias("source_url"), F.when(F.col("s_acctbal") > 0, "h").alias("sha256"))
    return A.auditability(s, points(t), evidence)


METRICS = [(f"c{i}", *r) for i, r in enumerate([(30.0, 60.0, 70.0, 6.0, 40.0, 60.0, 20.0, 60.0), (25.0, 70.0, 80.0, 5.0, 35.0, 70.0, 15.0, 70.0), (None, 10.0, None, 99.0, 35.01, 69.99, 15.01, None), (25.01, 100.0, 79.99, 0.0, 0.0, 100.0, 0.0, 100.0)])]
METRIC_NAMES = [m for _, m, *_ in A.ALERTS]


@query(f"WITH m AS (SELECT * FROM {values(METRICS, 'case_id, ' + ', '.join(METRIC_NAMES))}) " + " UNION ALL ".join(f"SELECT '{a}' AS alert_type, '{s}' AS severity, '{m}' AS metric_name, CAST({m} AS DOUBLE) AS current_value, {x}::DOUBLE AS threshold_value FROM m WHERE {m} {'>' if side == 'above' else '<'} {x}" for a, m, side, x, s in A.ALERTS))
def all_alerts(t):
    return A.alerts(t.spark.createDataFrame(METRICS, "case_id string, " + ", ".join(f"{m} double" for m in METRIC_NAMES)))


@query("SELECT o_orderkey, o_orderpriority AS alert_type, o_orderdate AS created_at FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate DESC, o_orderpriority, o_orderkey LIMIT 1")
def newest_open_alert(t):
    log = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("alert_type"), F.col("o_orderdate").alias("created_at"), F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")).alias("resolved_at"))
    return A.recent_alerts(log, 10).orderBy(F.desc("created_at"), "alert_type", "o_orderkey").limit(1).drop("resolved_at")


_na = "coalesce(round_even(100 * na_rate, 2), 0)"


@query(f"WITH {SCORED}, r AS (SELECT *, round_even(100 * na_rate, 2) AS na FROM scores), a AS (SELECT round(100 - avg(na), 2) AS coverage_percent, round(avg(na), 2) AS avg_na_rate, round(100.0 * count(*) FILTER (WHERE na <= 75) / count(*), 2)::DOUBLE AS agent_c_pass_rate, count(*) FILTER (WHERE na > 40) AS high_na_firms, count(*) FILTER (WHERE na <= 10) AS na_0_10, count(*) FILTER (WHERE na > 10 AND na <= 25) AS na_11_25, count(*) FILTER (WHERE na > 25 AND na <= 40) AS na_26_40, count(*) FILTER (WHERE na > 40) AS na_over_40, round(100.0 * count(score) / count(*), 2)::DOUBLE AS score_full, round(100.0 * count(nullif(jurisdiction_tier, '')) / count(*), 2)::DOUBLE AS tier_full, 100.0::DOUBLE AS confidence_full FROM r) SELECT *, coverage_percent > 85 AND avg_na_rate < 25 AND agent_c_pass_rate > 75 AS passed FROM a")
def record_coverage(t):
    return A.record_coverage(with_tier(t))


@query(f"WITH {SCORED}, g AS (SELECT coalesce(jurisdiction_tier, 'UNKNOWN') AS jurisdiction_tier, count(*) AS count, round(avg({_na}), 2) AS avg_na_rate FROM scores GROUP BY 1) SELECT *, round(100 - avg_na_rate, 2) AS coverage_percent FROM g")
def tier_coverage(t):
    return A.tier_coverage(with_tier(t))


@query(f"WITH {SCORED}, {PREV}, b AS (SELECT abs(s.score - p.score) AS change FROM scores s JOIN prev p USING (firm_id)), n AS (SELECT change, row_number() OVER (ORDER BY change) - 1 AS i, count(*) OVER () AS n FROM b), a AS (SELECT round(avg(change), 4) AS avg_score_change, round(max(change), 4) AS max_score_change, count(*) FILTER (WHERE change > 10) AS firms_with_major_changes, (SELECT round(change, 4) FROM n WHERE i = n // 2) AS median_score_change, (SELECT count(*) FROM scores) AS firms, {_entered(10, 'prev', 'scores')} AS top_10_turnover, {_entered(20, 'prev', 'scores')} AS top_20_turnover FROM b) SELECT *, avg_score_change < 0.05 AND top_10_turnover <= 2 AND top_20_turnover <= 4 AND firms_with_major_changes < 0.05 * firms AS passed FROM a")
def record_stability(t):
    s = scores(t)
    return A.record_stability(s, previous(s))


@query(f"WITH {SCORED} SELECT confidence, count(*) AS count, round(avg({_na}), 2) AS avg_na_rate, round(avg(score), 2) AS avg_score, round(100.0 * count(*) FILTER (WHERE {_na} < 15) / count(*), 2)::DOUBLE AS accuracy FROM scores GROUP BY 1")
def confidence_calibration(t):
    return A.confidence_calibration(scores(t))


@query(f"WITH {SCORED}, g AS (SELECT coalesce(jurisdiction_tier, 'UNKNOWN') AS jurisdiction_tier, count(*) AS count, round(avg(score), 2) AS avg_score, round(stddev_pop(score), 2) AS std_dev FROM scores GROUP BY 1), a AS (SELECT avg(avg_score) AS gm, stddev_pop(avg_score) AS gs FROM g) SELECT jurisdiction_tier, count, avg_score, std_dev, abs(avg_score - gm) > 1.5 * gs AS outlier FROM g, a")
def tier_bias(t):
    return A.tier_bias(with_tier(t))


@query(f"WITH {SCORED}, a AS (SELECT round(avg(score), 2) AS score_mean, round(stddev_pop(score), 2) AS score_std_dev, round(skewness(score) * (count(*) - 2) / sqrt(count(*) * (count(*) - 1.0)), 4) AS score_skewness, count(*) FILTER (WHERE score <= 20) AS upto_20, count(*) FILTER (WHERE score > 20 AND score <= 40) AS upto_40, count(*) FILTER (WHERE score > 40 AND score <= 60) AS upto_60, count(*) FILTER (WHERE score > 60 AND score <= 80) AS upto_80, count(*) FILTER (WHERE score > 80) AS upto_100 FROM scores) SELECT *, (upto_20 = 0)::INT + (upto_40 = 0)::INT + (upto_60 = 0)::INT + (upto_80 = 0)::INT + (upto_100 = 0)::INT > 2 AS clustered FROM a")
def score_distribution(t):
    return A.score_distribution(scores(t))


_share = lambda a, b: f"round(coalesce(100.0 * count(*) FILTER (WHERE {a}) / nullif(count(*) FILTER (WHERE {b}), 0), 0), 2)::DOUBLE"
_fit = "(CASE WHEN neg THEN s < 50 ELSE s >= 50 END)"


@query(
    f"WITH {SCORED}, {_truth}, e AS (SELECT ev.*, sc.score AS s, sc.firm_id IS NOT NULL AS known, sc.confidence, coalesce(event_type IN ('regulatory_action', 'license_revoked', 'fraud', 'payout_failure'), false) AS neg, CAST(floor(epoch(d - event_date) / 86400) AS INT) AS age, coalesce(severity, 'medium') AS sev FROM ev CROSS JOIN asof_ LEFT JOIN scores sc ON sc.firm_id = ev.firm_id)"
    f" SELECT count(*) FILTER (WHERE firm_id IS NOT NULL AND known AND ((neg AND s < 40) OR confidence = 'low')) AS events_detected, count(*) FILTER (WHERE firm_id IS NOT NULL AND NOT coalesce(known AND ((neg AND s < 40) OR confidence = 'low'), false)) AS events_missed, {_share(chr(40) + 'firm_id IS NOT NULL AND known AND ((neg AND s < 40) OR confidence = ' + chr(39) + 'low' + chr(39) + '))', 'firm_id IS NOT NULL')} AS event_detection_rate, count(*) FILTER (WHERE age BETWEEN 0 AND 30) AS recent_events, {_share('age BETWEEN 0 AND 30 AND known AND ' + _fit, 'age BETWEEN 0 AND 30')} AS score_responsiveness_rate,"
    f" {_share('known AND neg AND sev = ' + chr(39) + 'high' + chr(39) + ' AND s < 30', 'known AND neg AND sev = ' + chr(39) + 'high' + chr(39))} AS high_alignment, {_share('known AND neg AND sev = ' + chr(39) + 'medium' + chr(39) + ' AND s >= 30 AND s < 60', 'known AND neg AND sev = ' + chr(39) + 'medium' + chr(39))} AS medium_alignment, count(*) FILTER (WHERE severity = 'high' AND (NOT known OR (neg AND s >= 40))) AS false_negatives,"
    f" {_share('age BETWEEN 0 AND 7 AND known AND ' + _fit, '(age BETWEEN 0 AND 7 AND known AND ' + _fit + ') OR (age >= 0 AND known AND NOT ' + _fit + ')')} AS timeliness_rate FROM e"
)
def event_truth(t):
    return A.event_truth(t.orders.selectExpr(*TRUTH), scores(t), as_of(t))


SIGNAL = ["'f' || o_custkey AS firm_id", f"{choose('o_orderkey % 4', ['reddit', 'news', None, 'forum'])} AS source", f"{choose('o_orderkey % 5', ['negative', 'positive', 'neutral', None, 'negative'])} AS sentiment", "o_orderdate AS date"]


@query(
    f"WITH {SCORED}, sg AS (SELECT {', '.join(SIGNAL)} FROM orders), asof_ AS (SELECT max(o_orderdate) AS d FROM orders), e AS (SELECT sg.*, sc.score AS s, coalesce(sentiment, 'neutral') AS m, CAST(floor(epoch(d - date) / 86400) AS INT) AS age FROM sg CROSS JOIN asof_ LEFT JOIN scores sc USING (firm_id)), k AS (SELECT firm_id, count(DISTINCT coalesce(source, '')) AS k FROM sg GROUP BY 1),"
    f" a AS (SELECT count(*) AS total_signals, count(*) FILTER (WHERE m = 'negative') AS negative_signals, count(*) FILTER (WHERE m = 'positive') AS positive_signals, count(*) FILTER (WHERE m = 'neutral') AS neutral_signals, count(DISTINCT firm_id) AS firms_with_signals, {_share('(m = ' + chr(39) + 'negative' + chr(39) + ' AND s < 50) OR (m = ' + chr(39) + 'positive' + chr(39) + ' AND s >= 50)', 's IS NOT NULL AND m IN (' + chr(39) + 'negative' + chr(39) + ', ' + chr(39) + 'positive' + chr(39) + ')')} AS correlation_accuracy, count(*) FILTER (WHERE m = 'negative' AND age BETWEEN 1 AND 30 AND s IS NOT NULL) AS early_warnings, {_share('m = ' + chr(39) + 'negative' + chr(39) + ' AND age BETWEEN 1 AND 30 AND s < 50', 'm = ' + chr(39) + 'negative' + chr(39) + ' AND age BETWEEN 1 AND 30 AND s IS NOT NULL')} AS early_warning_accuracy, count(*) FILTER (WHERE m = 'negative' AND s >= 70) AS false_positives, {_share('m = ' + chr(39) + 'negative' + chr(39) + ' AND s >= 70', 'm = ' + chr(39) + 'negative' + chr(39) + ' AND s IS NOT NULL')} AS false_positive_rate, (SELECT round(100.0 * count(*) FILTER (WHERE k > 1) / count(*), 2)::DOUBLE FROM k) AS multi_source_validation_rate FROM e)"
    " SELECT *, correlation_accuracy > 85 AND false_positive_rate < 5 AND early_warning_accuracy > 70 AS passed FROM a"
)
def soft_signals(t):
    return A.soft_signals(t.orders.selectExpr(*SIGNAL), scores(t), as_of(t))


LOG = ["event_type AS agent", "ts", f"{choose('event_id % 25', ['failure', 'success', 'error', *['completed'] * 22])} AS status", "CASE WHEN event_id % 10 <> 0 THEN value END AS quality_score"]


@query(f"WITH l AS (SELECT {', '.join(LOG)} FROM events WHERE event_type <> 'view'), n AS (SELECT max(ts) AS d FROM events), w AS (SELECT unnest(['click', 'view', 'error', 'nobody']) AS agent), s AS (SELECT agent, count(*) AS runs, count(*) FILTER (WHERE status IN ('failure', 'error', 'failed')) AS failures, avg(epoch(d - ts) / 3600) AS age, min(epoch(d - ts) / 3600) AS idle, avg(quality_score) AS q FROM l, n GROUP BY 1) SELECT agent, coalesce(runs, 0) AS runs, coalesce(failures, 0) AS failures, round(100.0 * failures / runs, 2)::DOUBLE AS failure_rate, round(age, 1) AS avg_age_hours, round(idle, 1) AS hours_inactive, round(q, 1) AS avg_quality, CASE WHEN runs IS NULL THEN 'missing' WHEN idle > 24 THEN 'inactive' WHEN 100.0 * failures / runs > 5 THEN 'failing' WHEN age > 48 THEN 'stale' WHEN q < 70 THEN 'low_quality' ELSE 'ok' END AS state FROM w FULL JOIN s USING (agent)")
def agent_states(t):
    now = F.lit(t.events.agg(F.max("ts")).first()[0])
    return A.agent_health(t.events.filter("event_type <> 'view'").selectExpr(*LOG), ["click", "view", "error", "nobody"], now)


@query(None)
def validation_report(t):
    """Suites of one row each, under each other."""
    s = with_tier(t)
    return A.report(coverage=A.record_coverage(s), distribution=A.score_distribution(s), sensitivity=A.sensitivity(s, C.WEIGHTS))


# indices

INDEX = ["c_custkey AS id", "(c_custkey % 11) / CAST(10 AS DOUBLE) AS a", "(c_custkey % 7) / CAST(6 AS DOUBLE) AS b", "(c_custkey % 5) / CAST(4 AS DOUBLE) AS c", "(c_custkey % 13) / CAST(12 AS DOUBLE) AS d", "(c_custkey % 3) / CAST(2 AS DOUBLE) AS e", "c_custkey % 4 = 0 AS f", "c_custkey % 9 = 0 AS g", "(c_custkey % 6) / CAST(10 AS DOUBLE) AS na"]


@query(
    f"WITH i AS (SELECT {', '.join(INDEX)} FROM customer), x AS (SELECT id, 0.30*a + 0.25*b + 0.25*c + 0.20*d AS exposure, 0.25*a + 0.20*b + 0.20*c + 0.20*d + 0.15*e AS readiness, (a+b+c+d+e)/5 AS integrity, 1 - (a+b+c)/3 AS stress, greatest(0, least(1, 0.30*a + 0.20*b + 0.20*c + 0.20*(1-d) + 0.10*(1-e) - CASE WHEN f THEN 0.30 ELSE 0 END - CASE WHEN na > 0.40 THEN 0.25 ELSE 0 END - CASE WHEN g THEN 0.40 ELSE 0 END - CASE WHEN f AND g THEN 0.20 ELSE 0 END)) AS inclusion FROM i)"
    " SELECT id, round(exposure, 6)::DOUBLE AS exposure, round(readiness, 6)::DOUBLE AS readiness, CASE WHEN round(readiness, 9) >= 0.85 THEN 'Institution-grade' WHEN round(readiness, 9) >= 0.70 THEN 'Institutional-ready' WHEN round(readiness, 9) >= 0.50 THEN 'Emerging institutional' WHEN round(readiness, 9) >= 0.30 THEN 'Semi-professional' ELSE 'Retail-grade' END AS reading, round(integrity, 6)::DOUBLE AS integrity, round(stress, 6)::DOUBLE AS stress, round(inclusion, 6)::DOUBLE AS inclusion FROM x"
)
def composite_indices(t):
    d = t.customer.selectExpr(*INDEX)
    c = F.col
    named = d.withColumns({"registration_risk": c("a"), "client_jurisdiction_risk": c("b"), "regulatory_mentions": c("c"), "model_compatibility": c("d"), "governance": c("a"), "legal_clarity": c("b"), "operations": c("c"), "transparency": c("d"), "compliance": c("e")})
    ready = L.weighted_index(L.INSTITUTIONAL_READINESS)
    return named.select(
        "id", F.round(L.weighted_index(L.REGULATORY_EXPOSURE), 6).alias("exposure"), F.round(ready, 6).alias("readiness"), V.band(F.round(ready, 9), L.READINESS_BANDS, "Retail-grade").alias("reading"), F.round(L.model_integrity(c("a"), c("b"), c("c"), c("d"), c("e")), 6).alias("integrity"),
        F.round(L.stress(c("a"), c("b"), c("c")), 6).alias("stress"), F.round(L.inclusion(c("a"), c("b"), c("c"), c("d"), c("e"), c("f"), c("na"), c("g"), c("f") & c("g")), 6).alias("inclusion"),
    )
