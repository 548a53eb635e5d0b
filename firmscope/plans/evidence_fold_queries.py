"""Queries on evidence: datapoints of an ordered fold, merged parts, winners by source, payloads by schema and as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscope.functions import extract as E
from firmscope.functions import payload as J
from firmscope.functions import text as X
from firmscope.operators import extraction as O
from firmscope.plans.extract_queries import PHRASES, choose, frequency_sql, percent_sql
from firmscope.plans.registry import Tables, query

KEYS = ["rules_html", "pricing_html", "external_html", "rules_pdf", "other_html", "pricing_pdf", "xhr_json"]
#: Pages as evidence of 37 firms; some take a phrase that states rules or prices, and some are too short.
_ev = [
    "page_id AS evidence_id", "CASE WHEN page_id % 3 = 0 THEN 0 ELSE page_id % 37 END AS firm_id", f"{choose(f'page_id % {len(KEYS)}', KEYS)} AS key", "url AS source_url", "md5(html) AS sha256", "(page_id * 7919) % 101 AS created_at",
    f"CASE WHEN page_id % 10 = 3 THEN 'max drawdown 5%; payout weekly' WHEN page_id % 2 = 0 THEN html || ' ' || ({choose(f'CAST(floor(page_id / 2) AS BIGINT) % {len(PHRASES)}', PHRASES)}) ELSE html END AS raw",
]
EVIDENCE = f"SELECT {', '.join(_ev)} FROM pages"
_html = r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(raw, '(?is)<(script|style|noscript|svg)\b.*?</(script|style|noscript|svg)\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"
_quoted = lambda words: ", ".join(f"'{w}'" for w in words)
FOLD = (
    f"ev AS ({EVIDENCE}), tx AS (SELECT *, CASE WHEN key = 'xhr_json' THEN '' ELSE {_html} END AS text, row_number() OVER (PARTITION BY firm_id ORDER BY created_at DESC, evidence_id) AS place FROM ev WHERE key <> 'other_html'), l AS (SELECT *, lower(text) AS l FROM tx),"
    f" x AS (SELECT *, {frequency_sql('l')} AS payout_frequency, {percent_sql('l', E.MAX_DRAWDOWN)} AS max_drawdown, {percent_sql('l', E.DAILY_DRAWDOWN)} AS daily_drawdown, nullif(regexp_extract(l, '{E.RULE_CHANGE}', 2), '') AS rule_changes_frequency, try_cast(nullif(regexp_extract(l, '{E.PROFIT_SPLIT}', 1), '') AS DOUBLE) AS payout_split_pct,"
    f" key IN ({_quoted(O.RULE_KEYS + O.BOTH_KEYS)}) AS for_rules, key IN ({_quoted(O.PRICING_KEYS + O.BOTH_KEYS)}) AS for_pricing FROM l),"
    " h AS (SELECT *, length(text) >= 400 AND for_rules AND coalesce(payout_frequency, max_drawdown::VARCHAR, daily_drawdown::VARCHAR, rule_changes_frequency) IS NOT NULL AS has_rules, length(text) >= 400 AND for_pricing AND coalesce(payout_frequency, payout_split_pct::VARCHAR) IS NOT NULL AS has_pricing FROM x),"
    " f AS (SELECT firm_id, count(*) AS n, min(place) FILTER (has_rules) AS r, min(place) FILTER (has_pricing) AS p FROM h GROUP BY 1)"
)


def evidence(t: Tables) -> DataFrame:
    return t.pages.selectExpr(*_ev)


@query(
    f"WITH {FOLD} SELECT firm_id, 'rules' AS target, place, evidence_id, payout_frequency, max_drawdown, daily_drawdown, rule_changes_frequency, NULL::DOUBLE AS payout_split_pct FROM h JOIN f USING (firm_id) WHERE for_rules AND length(text) >= 400 AND place <= coalesce(r, place)"
    " UNION ALL SELECT firm_id, 'pricing', place, evidence_id, payout_frequency, NULL, NULL, NULL, payout_split_pct FROM h JOIN f USING (firm_id) WHERE for_pricing AND length(text) >= 400 AND place <= coalesce(p, place)"
)
def evidence_datapoints(t):
    return O.first_hits(evidence(t), blocks=False).drop("source_url", "sha256")


@query(f"WITH {FOLD} SELECT firm_id, CASE WHEN r IS NULL OR p IS NULL THEN n ELSE greatest(r, p) END AS processed, (r IS NOT NULL)::INT AS rules, (p IS NOT NULL)::INT AS pricing FROM f")
def evidence_runs(t):
    rows = evidence(t)
    return O.runs(rows, O.first_hits(rows, blocks=False))


@query(None)
def evidence_datapoints_blocks(t):
    """As evidence_datapoints, from the blocks under headings where a page has them; SQL has no parser for pages."""
    return O.first_hits(evidence(t))


PART = 1500
_parts = (
    f"parts AS (SELECT doc_id, c AS chunk, substr(text, (c * {PART} + 1)::BIGINT, {PART}) AS x FROM documents, range(0, 100000) r(c) WHERE c * {PART} < length(text)), e AS (SELECT doc_id, chunk, lower(x) AS l, nullif(regexp_extract(x, '([0-9]+)%', 1), '') AS percent,"
    " nullif(regexp_extract(x, '(?i)(please|contact|copyright|license)', 1), '') AS mark, regexp_extract_all(x, '[0-9]{2,6}') AS numbers, regexp_extract_all(x, '[A-Z][a-z]{6,}') AS names FROM parts)"
)
_union = lambda c: f"(SELECT doc_id, list(v ORDER BY first) AS {c} FROM (SELECT doc_id, v, min({{'a': chunk, 'b': i}}) AS first FROM (SELECT doc_id, chunk, unnest({c}) AS v, generate_subscripts({c}, 1) AS i FROM e) GROUP BY 1, 2) GROUP BY 1)"


@query(
    f"WITH {_parts}, s AS (SELECT doc_id, count(*) AS parts, arg_min(percent, chunk) FILTER (percent IS NOT NULL) AS percent, arg_min(mark, chunk) FILTER (mark IS NOT NULL) AS mark FROM e GROUP BY 1)"
    f" SELECT s.doc_id, parts, percent, mark, coalesce(array_to_string(numbers, ','), '') AS numbers, coalesce(array_to_string(names, ','), '') AS names FROM s LEFT JOIN {_union('numbers')} USING (doc_id) LEFT JOIN {_union('names')} USING (doc_id)"
)
def merged_chunks(t):
    parts = t.documents.select("doc_id", F.posexplode(X.chunks(F.col("text"), PART)).alias("chunk", "x"))
    x, all_ = F.col("x"), lambda p: F.regexp_extract_all("x", F.lit(p), F.lit(0))
    one = lambda p: F.nullif(F.regexp_extract(x, p, 1), F.lit(""))
    d = parts.select("doc_id", "chunk", one("([0-9]+)%").alias("percent"), one("(?i)(please|contact|copyright|license)").alias("mark"), all_("[0-9]{2,6}").alias("numbers"), all_("[A-Z][a-z]{6,}").alias("names"))
    out = O.merged_parts(d, ["doc_id"], "chunk", ["percent", "mark"], ["numbers", "names"])
    return out.select("doc_id", "parts", "percent", "mark", F.array_join("numbers", ",").alias("numbers"), F.array_join("names", ",").alias("names"))


SOURCES = ["html", "pdf", "wikipedia", "llm", "proxy"]
TRUST = {"html": 5, "pdf": 4, "wikipedia": 3, "llm": 2}
_cells = [
    "o_custkey AS firm_id", f"{choose(f'o_orderkey % {len(SOURCES)}', SOURCES)} AS source", "o_orderkey AS place", "CASE WHEN o_orderkey % 4 = 1 THEN 1990 + CAST(o_orderkey % 30 AS INT) END AS founded_year",
    "CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN o_orderpriority WHEN 4 THEN o_orderstatus END AS headquarters", "CASE WHEN o_orderkey % 9 = 2 THEN 'Tier ' || CAST(1 + o_orderkey % 3 AS VARCHAR(1)) END AS jurisdiction_tier",
]
FIELDS = ["founded_year", "headquarters", "jurisdiction_tier"]
_trust = "CASE source " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in TRUST.items()) + " ELSE 0 END"
WINNERS = (
    f"cells AS (SELECT {', '.join(_cells)} FROM orders), long AS (SELECT firm_id, source, place, unnest([{', '.join(f'{chr(39)}{f}{chr(39)}' for f in FIELDS)}]) AS f, unnest([{', '.join(f'{f}::VARCHAR' for f in FIELDS)}]) AS v FROM cells),"
    f" best AS (SELECT firm_id, f, v, source FROM long WHERE v <> '' QUALIFY row_number() OVER (PARTITION BY firm_id, f ORDER BY {_trust} DESC, place) = 1),"
    f" won AS (SELECT firm_id, {', '.join(f'any_value(v) FILTER (f = {chr(39)}{f}{chr(39)}) AS {f}' for f in FIELDS)}, string_agg(f || '=' || source, ',' ORDER BY f) AS sources FROM best GROUP BY 1)"
)


def winners(t: Tables) -> DataFrame:
    return O.field_winners(t.orders.selectExpr(*_cells), "firm_id", FIELDS, "source", TRUST, "place")


@query(f"WITH {WINNERS} SELECT firm_id, founded_year::INT AS founded_year, headquarters, jurisdiction_tier, sources FROM won")
def field_provenance(t):
    pairs = F.transform(F.map_entries("sources"), lambda x: F.concat(x["key"], F.lit("="), x["value"]))
    return winners(t).withColumn("sources", F.array_join(F.array_sort(pairs), ","))


_old = "c_custkey AS firm_id, CASE WHEN c_custkey % 4 = 0 THEN 2001 END AS founded_year, CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'London' END AS headquarters, CASE WHEN c_custkey % 5 > 0 THEN 'Tier 2' END AS jurisdiction_tier"
_merged = {f: f"CASE WHEN coalesce(o.{f}::VARCHAR, '') = '' AND coalesce(w.{f}::VARCHAR, '') <> '' THEN w.{f} ELSE o.{f}::VARCHAR END" for f in FIELDS}


@query(
    f"WITH {WINNERS}, old AS (SELECT {_old} FROM customer WHERE c_custkey % 7 > 0), j AS (SELECT w.firm_id, {', '.join(f'{e} AS {f}, o.{f}::VARCHAR AS o_{f}' for f, e in _merged.items())}, o.firm_id IS NOT NULL AS held FROM won w LEFT JOIN old o ON o.firm_id = w.firm_id)"
    f" SELECT firm_id, founded_year::INT AS founded_year, headquarters, jurisdiction_tier, CASE WHEN held THEN 'update' ELSE 'insert' END AS action FROM j WHERE {' OR '.join(f'{f} IS DISTINCT FROM o_{f}' for f in FIELDS)}"
)
def enrichment_writes(t):
    old = t.customer.filter("c_custkey % 7 > 0").selectExpr(*[x.strip() for x in _old.split(", ")])  # what an earlier run has written
    return O.filled(old, winners(t), "firm_id", FIELDS)


_sites = "CAST(5 - p_size % 4 AS INT) AS trust, p_brand AS firm_id, 'https://x' || (p_size % 13) || '.com/' || lower(p_type) AS url, p_partkey AS place"


@query(f"WITH s AS (SELECT {_sites} FROM part), o AS (SELECT firm_id, url, max(trust) AS trust, min(place) FILTER (trust = best) AS place FROM (SELECT *, max(trust) OVER (PARTITION BY firm_id, url) AS best FROM s) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY firm_id ORDER BY trust DESC, place) AS rank FROM o) SELECT firm_id, url, trust, rank FROM r WHERE rank <= 10")
def trusted_candidates(t):
    d = t.part.selectExpr(*[x.strip() for x in _sites.split(", ")])
    return O.ranked_candidates(d, "firm_id", "url", F.col("trust"), "place")


#: Payloads that don't keep to their schema, some of which can't be read.
PAYLOAD = (
    "CASE o_orderkey % 12 WHEN 0 THEN '{\"fee\":' WHEN 1 THEN '[1,2]' WHEN 2 THEN 'null' WHEN 3 THEN '{}' ELSE '{\"platforms\":' || CASE o_orderkey % 5 WHEN 0 THEN '[\" mt4 \",5,true]' WHEN 1 THEN '\"mt5\"' WHEN 2 THEN '[]' WHEN 3 THEN 'null' ELSE '[\"a\",\"b\"]' END"
    " || ',\"fee\":' || CASE o_orderkey % 7 WHEN 0 THEN '\" 12.5 \"' WHEN 1 THEN '\"abc\"' WHEN 2 THEN 'true' WHEN 3 THEN '[1]' WHEN 4 THEN 'null' ELSE CAST(o_orderkey % 1000 AS VARCHAR(9)) END || ',\"refund\":' || CASE o_orderkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN '\"true\"' ELSE '0' END"
    " || ',\"policy\":' || CASE o_orderkey % 4 WHEN 0 THEN '\"  x ' || o_orderpriority || ' \"' WHEN 1 THEN '7' WHEN 2 THEN '\"\"' ELSE '{\"a\":1}' END || '}' END"
)
SCHEMA = {"platforms": "list", "fee": "number", "refund": "boolean", "policy": "string"}


@query(
    f"WITH p AS (SELECT o_orderkey AS id, {PAYLOAD} AS p FROM orders), v AS (SELECT *, json_valid(p) AND coalesce(json_type(CASE WHEN json_valid(p) THEN p ELSE 'null' END), '') = 'OBJECT' AS good, CASE WHEN json_valid(p) THEN p ELSE 'null' END AS j FROM p)"
    " SELECT id, CASE WHEN NOT good THEN 'invalid_json' END AS error, CASE WHEN NOT good THEN p END AS raw, CASE WHEN good THEN array_to_string(CASE WHEN json_type(j, '$.platforms') = 'ARRAY' THEN list_transform(json_extract_string(j, '$.platforms[*]'), lambda x: trim(x)) ELSE [] END, '|') END AS platforms,"
    " CASE json_type(j, '$.fee') WHEN 'BOOLEAN' THEN (json_extract_string(j, '$.fee') = 'true')::INT::DOUBLE WHEN 'ARRAY' THEN NULL ELSE try_cast(trim(json_extract_string(j, '$.fee')) AS DOUBLE) END AS fee,"
    " CASE WHEN json_type(j, '$.refund') = 'BOOLEAN' THEN json_extract_string(j, '$.refund') = 'true' END AS refund, CASE WHEN json_type(j, '$.policy') = 'VARCHAR' THEN trim(json_extract_string(j, '$.policy')) END AS policy FROM v"
)
def payloads_by_schema(t):
    d = t.orders.select(F.col("o_orderkey").alias("id"), J.by_schema(F.expr(PAYLOAD), SCHEMA).alias("s")).select("id", "s.*")
    return d.withColumn("platforms", F.array_join("platforms", "|"))


#: Values nested one to five levels deep, built around the texts a, b and c.
_deep = "CASE id % 5 WHEN 0 THEN '\"' || a || '\"' WHEN 1 THEN '{\"z\":\"' || a || '\",\"_audit\":{\"x\":\"no\"},\"b\":[\"' || b || '\",null,\"\"]}' WHEN 2 THEN '[[{\"k\":[\"' || a || '\",{\"m\":' || c || '}]}],\"' || b || '\"]' WHEN 3 THEN '{\"a\":{\"b\":{\"c\":{\"d\":[\"' || a || '\",\"' || b || '\"]}}},\"source_urls\":[\"no\"],\"n\":' || c || '}' ELSE '{broken' END"
_src = "SELECT l_orderkey * 10 + l_linenumber AS id, l_returnflag || l_linestatus AS a, substr(md5(CAST(l_partkey AS VARCHAR(20))), 1, 6) AS b, CAST(l_suppkey AS VARCHAR(20)) AS c FROM lineitem"


@query(f"SELECT id, CASE id % 5 WHEN 0 THEN a WHEN 1 THEN a || ' ' || b WHEN 2 THEN a || ' ' || c || ' ' || b WHEN 3 THEN a || ' ' || b || ' ' || c END AS text FROM ({_src})")
def nested_texts(t):
    d = t.lineitem.selectExpr("l_orderkey * 10 + l_linenumber AS id", "l_returnflag || l_linestatus AS a", "substr(md5(CAST(l_partkey AS VARCHAR(20))), 1, 6) AS b", "CAST(l_suppkey AS VARCHAR(20)) AS c")
    return d.select("id", J.nested_text(F.expr(_deep)).alias("text"))


@query("SELECT o_orderkey AS id, sha256('{\"a\": ' || o_custkey || ', \"b\": {\"x\": [1, \"' || o_orderstatus || '\"], \"y\": null}}') AS hash FROM orders")
def payload_hashes(t):
    raw = F.expr("CASE WHEN o_orderkey % 2 = 0 THEN '{\"b\":{\"y\":null,  \"x\":[1,\"' || o_orderstatus || '\"]},\"a\":' || o_custkey || '}' ELSE '{\"a\":' || o_custkey || ',\"b\":{\"x\":[1,\"' || o_orderstatus || '\"],\"y\":null}}' END")
    return t.orders.select(F.col("o_orderkey").alias("id"), J.payload_hash(raw).alias("hash"))
