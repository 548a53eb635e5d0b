"""Queries on fields read from texts, names, addresses and registries, over documents, pages and tables of awkward cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmscope.functions import extract as E
from firmscope.functions import pages as P
from firmscope.functions import rules as L
from firmscope.functions import text as X
from firmscope.operators import links as K
from firmscope.operators import screening as S
from firmscope.operators.tables import shuffled
from firmscope.plans.registry import Tables, query
from firmscope.plans.text_queries import soundex_sql


def choose(key: str, values: list) -> str:
    """SQL of both engines: the value at a place, counted from 0."""
    lit = lambda v: "NULL" if v is None else (str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'")
    return f"CASE {key} " + " ".join(f"WHEN {i} THEN {lit(v)}" for i, v in enumerate(values)) + " END"


def values(rows: list[tuple], names: str) -> str:
    """SQL of a table of literals."""
    lit = lambda v: "NULL" if v is None else (str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'")
    return f"(VALUES {', '.join('(' + ', '.join(map(lit, r)) + ')' for r in rows)}) AS v({names})"


def when_in(c: str, table: list, otherwise: str = "NULL") -> str:
    """SQL of the first entry of which any word lies in c."""
    steps = [((w,) if isinstance(w, str) else w, v) for w, v in table]
    return "CASE " + " ".join(f"WHEN {' OR '.join(f'contains({c}, ' + chr(39) + w + chr(39) + ')' for w in ws)} THEN {v if isinstance(v, int) else chr(39) + v + chr(39)}" for ws, v in steps) + f" ELSE {otherwise} END"


PHRASES = [
    "Payout on demand after the first withdrawal.", "We process payouts bi-weekly.", "Withdrawals are paid every 14 days", "Our payout runs quarterly", "paid weekly, no more",
    "Mobile wallets; payout within 30 days; max drawdown: 10%.", "payouts processed every 40 days or after 2 weeks", "payout every 3 months. MAXIMUM DRAWDOWN of 12.5 % of equity", "PAYOUT EVERY 1 DAY; daily loss limit 5%",
    "withdraw within 12 months; total drawdown 0%; max loss 8 %", "payout after 3 weeks", "payouts available after 7 days. Daily drawdown up to 4.25%", "Rules change about monthly; rule update: daily", "rules update\nweekly", "Profit split: 80% to you; payout annually",
    "profit   split is a generous 90 %; withdrawals yearly", "Founded in 2015, headquartered in New York, USA.", "established 1999; head office in St. Gallen", "launched in1987 and based in  Port-au-Prince; since 2020", "based in the usa.", "headquartered in X1",
    "loss limit per day 3%; drawdown limit 6%, overall drawdown 9%", "max drawdown " + "x" * 41 + " 7%", "max drawdown 1234%", "on-demand withdrawal 2.555%", "", "Biweekly payout",
]
TEXTS = f"texts AS (SELECT doc_id AS id, coalesce(text, '') || ' ' || {choose(f'doc_id % {len(PHRASES)}', PHRASES)} AS x FROM documents UNION ALL SELECT -1 - i, x FROM {values(list(enumerate(PHRASES)), 'i, x')})"


def texts(t: Tables) -> DataFrame:
    d = t.documents.select(F.col("doc_id").alias("id"), F.concat(F.coalesce("text", F.lit("")), F.lit(" "), F.get(F.array(*map(F.lit, PHRASES)), (F.col("doc_id") % len(PHRASES)).cast("int"))).alias("x"))
    return d.unionByName(t.spark.createDataFrame([(-1 - i, x) for i, x in enumerate(PHRASES)], "id long, x string"))


def _day_band(n: str) -> str:
    return f"CASE WHEN {n} <= 1 THEN 'daily' WHEN {n} <= 7 THEN 'weekly' WHEN {n} <= 14 THEN 'biweekly' WHEN {n} <= 31 THEN 'monthly' END"


def frequency_sql(l: str) -> str:
    own = f"try_cast(regexp_extract({l}, '{E.PAYOUT_EVERY}', 1) AS INT)"
    n, unit = f"try_cast(regexp_extract({l}, '{E.ANY_EVERY}', 1) AS INT)", f"regexp_extract({l}, '{E.ANY_EVERY}', 2)"
    anyway = f"CASE WHEN {unit} = 'day' THEN {_day_band(n)} WHEN {unit} = 'week' THEN CASE WHEN {n} = 1 THEN 'weekly' WHEN {n} = 2 THEN 'biweekly' WHEN {n} >= 4 THEN 'monthly' END WHEN {unit} = 'month' THEN CASE WHEN {n} = 1 THEN 'monthly' WHEN {n} = 3 THEN 'quarterly' WHEN {n} >= 12 THEN 'annually' END END"
    return f"CASE WHEN contains({l}, 'payout') OR contains({l}, 'withdraw') THEN coalesce({when_in(l, E.FREQUENCIES)}, {_day_band(own)}, {anyway}) END"


def percent_sql(l: str, labels: list[str]) -> str:
    one = [f"try_cast(regexp_extract({l}, '{x}[^0-9]{{0,40}}([0-9]{{1,3}}(?:\\.[0-9]{{1,2}})?)\\s*%', 1) AS DOUBLE)" for x in labels]
    return f"coalesce({', '.join(f'nullif({x}, 0)' for x in one[:-1])}, {one[-1]})"


@query(f"WITH {TEXTS}, l AS (SELECT id, lower(x) AS l FROM texts) SELECT id, {frequency_sql('l')} AS payout_frequency, {percent_sql('l', E.MAX_DRAWDOWN)} AS max_drawdown, {percent_sql('l', E.DAILY_DRAWDOWN)} AS daily_drawdown, nullif(regexp_extract(l, '{E.RULE_CHANGE}', 2), '') AS rule_changes_frequency, try_cast(nullif(regexp_extract(l, '{E.PROFIT_SPLIT}', 1), '') AS DOUBLE) AS payout_split_pct FROM l")
def rules_from_text(t):
    d = texts(t).select("id", E.extracted_rules(F.col("x")).alias("r"), E.extracted_pricing(F.col("x"))["payout_split_pct"].alias("payout_split_pct"))
    return d.select("id", "r.*", "payout_split_pct")


HQ = "coalesce(" + ", ".join(f"nullif(trim(regexp_replace(trim(regexp_extract(x, '(?i){p}', 1)), '^[.,;]+|[.,;]+$', '', 'g')), '')" for p in E.HEADQUARTERS) + ")"


@query(f"WITH {TEXTS} SELECT id, try_cast(nullif(regexp_extract(lower(x), '{E.FOUNDED}', 1), '') AS INT) AS founded_year, {HQ} AS headquarters, try_cast(nullif(regexp_extract(x, '([0-9]+(?:\\.[0-9]+)?)', 1), '') AS DOUBLE) AS first_number FROM texts")
def company_facts(t):
    return texts(t).select("id", E.founded_year(F.col("x")).alias("founded_year"), E.headquarters(F.col("x")).alias("headquarters"), E.first_number(F.col("x")).alias("first_number"))


WORDS = ["on_demand", "Instant payouts", "bi-weekly", "Fortnightly", "weekly", "MONTHLY ", "daily", "on demand", "mobile", "", None, "Bi Weekly", "rarely", "very frequent", "Moderate", " lowest", "75%", " 12.5 % ", "x1", "1e3", "yearly", "annually, on demand"]


@query(f"SELECT event_id AS id, {when_in('lower(w)', E.DELAYS)} AS delay_days, {when_in('replace(lower(trim(w)), ' + chr(39) + '-' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ')', E.NORMAL_FREQUENCIES)} AS frequency, {when_in('lower(trim(w))', E.CHANGE_LEVELS)} AS change_level, try_cast(replace(trim(w), '%', '') AS DOUBLE) AS number FROM (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) || '%' ELSE {choose(f'CAST(floor(event_id / 2) AS BIGINT) % {len(WORDS)}', WORDS)} END AS w FROM events)")
def frequency_words(t):
    d, w = t.events.select(F.col("event_id").alias("id"), F.expr(f"CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS STRING) || '%' ELSE {choose(f'CAST(floor(event_id / 2) AS BIGINT) % {len(WORDS)}', WORDS)} END").alias("w")), F.col("w")
    return d.select("id", E.delay_days(w).alias("delay_days"), E.normal_frequency(w).alias("frequency"), E.change_level(w).alias("change_level"), E.numeric(w).alias("number"))


REMARKS = ['a.k.a. "Acme Corp"; f.k.a. "Old Acme"; a.k.a. "ACME  "; nationality RUS', 'Formerly Known As "X"; also known as "Y"; a.k.a. "Y".', "no names; Nationality ir", 'a.k.a. ""; A.K.A. "Z"', "", None]
KINDS = ["Individual", "vessel", "-0-", "AIRCRAFT", None, "individual vessel"]
REMARK_ROWS = [(i, r, KINDS[i % len(KINDS)], n) for i, (r, n) in enumerate([(r, n) for r in REMARKS for n in ("Ann", "", None)])]


@query(
    f"WITH v0 AS (SELECT * FROM {values(REMARK_ROWS, 'i, r, k, n')}), a AS (SELECT *, list_transform(list_concat(list_concat(regexp_extract_all(coalesce(r, ''), '(?i)a\\.k\\.a\\.\\s+\"([^\"]+)\"', 1), regexp_extract_all(coalesce(r, ''), '(?i)also known as\\s+\"([^\"]+)\"', 1)), list_concat(regexp_extract_all(coalesce(r, ''), '(?i)f\\.k\\.a\\.\\s+\"([^\"]+)\"', 1), regexp_extract_all(coalesce(r, ''), '(?i)formerly known as\\s+\"([^\"]+)\"', 1))), lambda x: trim(x)) AS al FROM v0), b AS (SELECT i, s_suppkey, r, k, n, al FROM a, supplier) "
    f"SELECT i * 1000000 + s_suppkey AS id, (SELECT string_agg(x, '|' ORDER BY p) FROM (SELECT x, min(p) AS p FROM (SELECT unnest(al) AS x, generate_subscripts(al, 1) AS p) GROUP BY x)) AS aliases, nullif(regexp_extract(coalesce(r, ''), '(?i)nationality\\s+([A-Z]{{2,3}})', 1), '') AS nationality, {when_in('lower(coalesce(k, ' + chr(39) * 2 + '))', [('individual', 'individual'), ('vessel', 'vessel'), ('aircraft', 'aircraft')], chr(39) + 'entity' + chr(39))} AS entity_type, coalesce(nullif(trim(concat_ws(' ', nullif(n, ''), CASE WHEN s_suppkey % 3 > 0 THEN 'S' || s_suppkey END)), ''), 'UNKNOWN') AS full_name FROM b"
)
def entity_fields(t):
    d = t.supplier.select("s_suppkey").crossJoin(F.broadcast(t.spark.createDataFrame(REMARK_ROWS, "i long, r string, k string, n string")))  # eighteen cases
    part = F.when(F.col("s_suppkey") % 3 > 0, F.concat(F.lit("S"), F.col("s_suppkey")))
    aliases = F.nullif(F.array_join(E.quoted_aliases(F.coalesce("r", F.lit(""))), "|"), F.lit(""))
    return d.select((F.col("i") * 1_000_000 + F.col("s_suppkey")).alias("id"), aliases.alias("aliases"), F.get(E.nationality(F.coalesce("r", F.lit(""))), 0).alias("nationality"), E.entity_type(F.coalesce("k", F.lit(""))).alias("entity_type"), E.full_name(F.col("n"), part).alias("full_name"))


TITLES = ["Firm suspended by regulator", "Licence REVOKED", "Client withdraws funds", "Settlement reached: fine of 3m", "Enforcement action opened", "Consumer warning", "Alert", "Criminal fraud ring", "Urban growth", "Proceeding closed", "inactive company", "Registered office", "Dissolved", "struck off, closed", "Open"]


@query(f"SELECT s_suppkey * 100 + i AS id, {when_in('l', E.EVENT_WORDS, chr(39) + 'warning' + chr(39))} AS event_type, {when_in('l', E.SEVERITY_WORDS, chr(39) + 'low' + chr(39))} AS severity, CASE {when_in('l', E.SEVERITY_WORDS, chr(39) + 'low' + chr(39))} WHEN 'critical' THEN -0.8::DOUBLE WHEN 'high' THEN -0.5 WHEN 'medium' THEN -0.25 ELSE -0.1 END AS impact, {when_in('l', E.STATUS_WORDS, chr(39) + 'unknown' + chr(39))} AS status FROM (SELECT s_suppkey, i, lower(s_name || ' ' || w) AS l FROM supplier, {values(list(enumerate(TITLES)), 'i, w')})")
def event_titles(t):
    d = t.supplier.select("s_suppkey", "s_name").crossJoin(F.broadcast(t.spark.createDataFrame(list(enumerate(TITLES)), "i long, w string")))  # fifteen titles
    title = F.concat("s_name", F.lit(" "), "w")
    kind = E.severity(title)
    return d.select((F.col("s_suppkey") * 100 + F.col("i")).alias("id"), E.event_type(title).alias("event_type"), kind.alias("severity"), L.severity_impact(kind).alias("impact"), E.registry_status(title).alias("status"))


PLACES = ["United States", "usa", "Ukraine", "Global markets", "EU", "Neuchatel", "Cayman Islands", "offshore", "Brazil", "", None, "Tokyo, Japan", "Europe", "GLOBAL offshore"]
URLS = ["https://www.acme.co.uk/x?y=1", "acme.de", "http://user@shop.acme.com.au:8080/", "https://x.io", "ACME.ORG/path", "https://acme.unknown", "", None, "https://a.b.c.eu#f", "https://www.acme-trading.com"]


def tier_sql(c: str, skip: bool) -> str:
    l = f"lower({c})"
    one = " OR ".join(f"contains({l}, '{x}')" for x in E.TIER_ONE)
    return f"CASE WHEN coalesce({c}, '') = '' {'OR contains(' + l + ', ' + chr(39) + 'global' + chr(39) + ')' if skip else ''} THEN NULL WHEN {one} THEN 'Tier 1' WHEN contains({l}, 'eu') THEN 'Tier 2' WHEN contains({l}, 'offshore') OR contains({l}, 'islands') THEN 'Tier 3' ELSE 'Tier 2' END"


@query(f"SELECT i AS id, {tier_sql('p', True)} AS tier, {tier_sql('p', False)} AS seed_tier FROM (SELECT * FROM {values(list(enumerate(PLACES)), 'i, p')} UNION ALL SELECT 100 + n_nationkey, n_name FROM nation UNION ALL SELECT 200 + r_regionkey, r_name FROM region)")
def jurisdiction_tiers_of_names(t):
    d = t.spark.createDataFrame(list(enumerate(PLACES)), "id long, p string").union(t.nation.select((F.col("n_nationkey") + 100).cast("long"), "n_name")).union(t.region.select((F.col("r_regionkey") + 200).cast("long"), "r_name"))
    return d.select("id", E.jurisdiction_tier(F.col("p")).alias("tier"), E.jurisdiction_tier(F.col("p"), skip_global=False).alias("seed_tier"))


_host = "lower(regexp_extract(CASE WHEN u LIKE 'http%' THEN u ELSE 'https://' || u END, '^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1))"
_country = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in E.COUNTRY_OF_TLD.items()) + "}"


@query(f"WITH a AS (SELECT i, u, {_host} AS h FROM (SELECT i, u FROM {values(list(enumerate(URLS)), 'i, u')} UNION ALL SELECT page_id + 100, url FROM pages)), b AS (SELECT *, string_split(h, '.') AS p FROM a) SELECT i AS id, h AS host, coalesce(({_country})[array_to_string(p[greatest(len(p) - 1, 1):], '.')], ({_country})[p[-1]]) AS country, coalesce(nullif(regexp_replace(regexp_replace(h, '^www\\.', ''), '[^a-z0-9\\-_]', '', 'g'), ''), 'unknown') AS firm_id FROM b")
def url_places(t):
    d = t.spark.createDataFrame(list(enumerate(URLS)), "id long, u string").union(t.pages.select(F.col("page_id") + 100, "url"))
    u = F.col("u")
    return d.select("id", E.url_host(u).alias("host"), E.url_country(u).alias("country"), E.firm_id(E.url_host(u), F.lit(None).cast("string")).alias("firm_id"))


ADDRESSES = ["http://acme.com//rules//daily/", "https://www.acme.com/faq", "https://acme.com", "http://www.acme.com/tems", "https://acme.com/a?b=1", "", None]


def _repair_sql() -> str:
    base = "WITH a AS (SELECT i, u, regexp_extract(u, '^([a-z]+)://', 1) AS sc, regexp_extract(u, '^[a-z]+://([^/?#]*)', 1) AS ho, coalesce(nullif(regexp_extract(u, '^[a-z]+://[^/?#]*([^?#]*)', 1), ''), '/') AS pa, regexp_extract(u, '^[a-z]+://[^/?#]*[^?#]*(.*)$', 1) AS re, regexp_extract(u, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS raw FROM src WHERE coalesce(u, '') <> ''), b AS (SELECT *, regexp_replace(pa, '/{2,}', '/', 'g') AS cp FROM a)"
    forms = ["u", "CASE WHEN cp <> pa THEN sc || '://' || ho || cp || re END", "sc || '://' || ho || CASE WHEN cp LIKE '%/' AND cp <> '/' THEN rtrim(cp, '/') ELSE cp || '/' END || re"]
    forms += [f"CASE WHEN contains(cp, '{a}') THEN sc || '://' || ho || replace(cp, '{a}', '{b}') || re END" for a, b in P.TYPOS.items()]
    forms += ["sc || '://' || CASE WHEN ho LIKE 'www.%' THEN substr(ho, 5) ELSE 'www.' || ho END || raw || re", "CASE sc WHEN 'http' THEN 'https' WHEN 'https' THEN 'http' ELSE sc END || '://' || ho || raw || re"]
    return f"{base} SELECT DISTINCT i AS id, x AS variant FROM (SELECT i, unnest([{', '.join(forms)}]) AS x FROM b) WHERE x IS NOT NULL"


@query(f"WITH src AS (SELECT i, u FROM {values(list(enumerate(ADDRESSES)), 'i, u')} UNION ALL SELECT page_id + 100, url FROM pages), " + _repair_sql()[5:])
def url_repairs(t):
    d = t.spark.createDataFrame(list(enumerate(ADDRESSES)), "id long, u string").union(t.pages.select(F.col("page_id") + 100, "url"))
    return d.select("id", F.explode(P.repaired(F.col("u"))).alias("variant"))


@query("WITH s AS (SELECT c_custkey AS id, lower(c_mktsegment) || '-' || CASE WHEN c_custkey % 3 = 0 THEN 'prop-' ELSE '' END || CASE WHEN c_custkey % 2 = 0 THEN 'trading' ELSE 'x' || c_custkey END AS slug FROM customer), f AS (SELECT id, unnest([slug, CASE WHEN slug LIKE '%-trading' THEN left(slug, length(slug) - 8) END, CASE WHEN contains('-' || slug || '-', '-prop-') THEN replace(slug, 'prop-', '') END, replace(slug, '-', ''), slug || '-prop-firm', slug || '-propfirm', slug || '-prop-trading-firm']) AS v, unnest([1, 2, 3, 4, 5, 6, 7]) AS p FROM s) SELECT id, string_agg(v, ',' ORDER BY p) AS variants FROM (SELECT id, v, min(p) AS p FROM f WHERE v IS NOT NULL GROUP BY id, v) GROUP BY id")
def slug_forms(t):
    k = F.col("c_custkey")
    slug = F.concat(F.lower("c_mktsegment"), F.lit("-"), F.when(k % 3 == 0, "prop-").otherwise(""), F.when(k % 2 == 0, "trading").otherwise(F.concat(F.lit("x"), k)))
    return t.customer.select(k.alias("id"), F.array_join(P.slug_forms(slug), ",").alias("variants"))


@query(None)
def page_links(t):
    """Links of pages, scored by address, anchor and the element around; SQL has no parser for pages."""
    return K.keyword_links(t.pages, "page_id", "url", "html", ["an", "de"])


@query(None)
def page_blocks(t):
    """Text under headings with a keyword."""
    return K.heading_blocks(t.pages, "page_id", "html", ["an", "de"])


@query("WITH h AS (SELECT page_id, nullif(split_part(url, '/', 3), '') AS host, length(url) % 7 AS relevance FROM pages) SELECT page_id, host, CAST(relevance AS BIGINT) AS relevance FROM (SELECT *, row_number() OVER (PARTITION BY coalesce(host, 'unknown') ORDER BY relevance DESC, page_id) AS r FROM h) WHERE r = 1")
def best_per_host(t):
    d = t.pages.select("page_id", F.nullif(F.split_part("url", F.lit("/"), F.lit(3)), F.lit("")).alias("host"), (F.length("url") % 7).cast("long").alias("relevance"))
    return K.best_per_key(d, F.coalesce("host", F.lit("unknown")), F.col("relevance"), F.col("page_id"))


_w = "list_distinct(list_filter(regexp_split_to_array(lower({c}), '\\s+'), lambda x: x <> ''))"


@query(f"WITH q AS (SELECT {_w.format(c=chr(39) + 'cold blue widget' + chr(39))} AS w), r AS (SELECT p_partkey, p_name, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS rank FROM part) SELECT p_partkey, round(least(1, CASE WHEN rank = 1 THEN 0.4 WHEN rank <= 3 THEN 0.3 WHEN rank <= 5 THEN 0.2 ELSE 0.1 END + 0.3 * len(list_intersect(w, {_w.format(c='p_name')})) / 3 + 0.2 * len(list_intersect(w, {_w.format(c='p_brand')})) / 3 + CASE WHEN p_brand LIKE '%1' THEN 0.05 ELSE 0 END), 6)::DOUBLE AS relevance FROM r, q")
def search_relevance(t):
    rank = F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    return t.part.withColumn("rank", rank).select("p_partkey", F.round(K.relevance(F.lit("cold blue widget"), F.col("p_name"), F.col("p_brand"), F.col("rank"), F.when(F.col("p_brand").endswith("1"), 0.05).otherwise(0.0)), 6).alias("relevance"))


@query("WITH d AS (SELECT p_partkey, string_split(p_name, ' ') AS w, p_type FROM part) SELECT p_partkey, CAST(len(list_filter(w, lambda x: x IN ('cold', 'widget'))) AS BIGINT) AS hits FROM d WHERE list_contains(w, 'cold') AND list_contains(w, 'widget') ORDER BY hits DESC, p_partkey LIMIT 20")
def full_text_all_words(t):
    return K.full_text(t.part.select("p_partkey", "p_name"), "p_partkey", F.col("p_name"), "Cold widget", 20)


GRAM = "list_distinct(flatten(list_transform(string_split({c}, ' '), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"
NAMES = "n AS (SELECT min(p_partkey) AS id, p_name AS name FROM part GROUP BY p_name)"


@query(f"WITH {NAMES}, g AS (SELECT id, name, {GRAM.format(c='name')} AS x FROM n), s AS (SELECT a.id AS query_id, b.id AS entity_id, round(len(list_intersect(a.x, b.x)) / len(list_distinct(list_concat(a.x, b.x)))::DOUBLE, 6) AS score FROM g a, g b) SELECT query_id, entity_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, entity_id) AS r FROM s WHERE score >= 0.45) WHERE r <= 20")
def trigram_top20(t):
    n = t.part.groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("id"))
    return K.trigram_top(n.select(F.col("id").alias("query_id"), "name"), n.select(F.col("id").alias("entity_id"), "name"), 0.45, 20)


@query("WITH m AS (SELECT event_id, CASE WHEN value >= 95 THEN 'high' WHEN value >= 85 THEN 'medium' ELSE 'low' END AS confidence, value FROM events) SELECT event_id, confidence, round(value, 6) AS value FROM m ORDER BY CASE confidence WHEN 'high' THEN 3 WHEN 'medium' THEN 2 ELSE 1 END DESC, m.value DESC, event_id LIMIT 50")
def ordered_matches(t):
    d = t.events.select("event_id", L.match_confidence(F.col("value") / 100).alias("confidence"), "value")
    order = F.when(F.col("confidence") == "high", 3).when(F.col("confidence") == "medium", 2).otherwise(1)
    return d.orderBy(order.desc(), F.desc("value"), "event_id").limit(50).select("event_id", "confidence", F.round("value", 6).alias("value"))


HOSTS = "h AS (SELECT page_id, lower(regexp_replace(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1), '^www\\.', '')) AS host FROM pages), p AS (SELECT page_id, host, string_split(host, '.') AS l FROM h), f AS (SELECT page_id, unnest([host, array_to_string(l[greatest(len(l) - 1, 1):], '.'), array_to_string(l[greatest(len(l) - 2, 1):], '.')]) AS k, unnest([1, 2, 3]) AS place FROM p), firms AS (SELECT DISTINCT array_to_string(l[greatest(len(l) - 1, 1):], '.') AS k, md5(array_to_string(l[greatest(len(l) - 1, 1):], '.')) AS firm_id FROM p)"


@query(f"WITH {HOSTS} SELECT page_id, arg_min(firm_id, place) AS firm_id, CAST(min(place) AS BIGINT) AS place FROM f JOIN firms USING (k) GROUP BY 1")
def host_join(t):
    d = t.pages.select("page_id", X.host(F.col("url")).alias("host"))
    key = F.array_join(F.slice(F.split("host", r"\."), F.greatest(F.size(F.split("host", r"\.")) - 1, F.lit(1)), F.lit(2)), ".")
    firms = d.select(key.alias("host")).distinct().withColumn("firm_id", F.md5("host"))
    return K.host_join(d, firms)


def people(t: Tables):
    """Distinct made-up names from customers and suppliers, and a watchlist of others close to some of them."""
    k = F.col("c_custkey")
    first, last = (F.array(*map(F.lit, x)) for x in (FIRST, LAST))
    name = F.concat(F.get(first, (k % len(FIRST)).cast("int")), F.lit(" "), F.get(last, (F.floor(k / len(FIRST)) % len(LAST)).cast("int")), F.lit(" "), F.substring(F.md5(k.cast("string")), 1, 5))
    q = t.customer.select(k.alias("query_id"), name.alias("name"))
    e = q.filter("query_id % 3 = 0").select(F.col("query_id").alias("entity_id"), F.when(F.col("query_id") % 2 == 0, F.concat("name", F.lit(" Holdings Ltd"))).when(F.col("query_id") % 5 == 0, F.concat(F.substring("name", 1, 3), F.substring("name", 5, 99))).otherwise(F.upper("name")).alias("name"), F.array(F.concat(F.lit("the "), "name")).alias("aliases"))
    return q, e


FIRST, LAST = ["Acme", "Brook", "Cedar", "Delta", "Ember", "Falcon", "Granite"], ["Trading", "Capital", "Markets", "Holdings", "Futures"]
_name = f"({choose(f'c_custkey % {len(FIRST)}', FIRST)}) || ' ' || ({choose(f'(c_custkey // {len(FIRST)}) % {len(LAST)}', LAST)}) || ' ' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 5)"
PEOPLE = f"q AS (SELECT c_custkey AS query_id, {_name} AS name FROM customer), e AS (SELECT query_id AS entity_id, CASE WHEN query_id % 2 = 0 THEN name || ' Holdings Ltd' WHEN query_id % 5 = 0 THEN substr(name, 1, 3) || substr(name, 5) ELSE upper(name) END AS name FROM q WHERE query_id % 3 = 0), nq AS (SELECT query_id, lower(name) AS q FROM q), ne AS (SELECT entity_id, lower(name) AS e FROM e)"


@query(f"WITH {PEOPLE}, l AS (SELECT query_id, trim(regexp_replace(regexp_replace(q, '\\b(ltd|limited|inc|llc|plc|corp|company|co)\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS q FROM nq), m AS (SELECT entity_id, trim(regexp_replace(regexp_replace(e, '\\b(ltd|limited|inc|llc|plc|corp|company|co)\\b', ' ', 'g'), '\\s+', ' ', 'g')) AS e FROM ne), h AS (SELECT query_id, 'L' || entity_id % 2 AS list_name, entity_id AS pos, CASE WHEN q = e THEN 0.98::DOUBLE ELSE 0.85::DOUBLE END AS score FROM l, m WHERE q = e OR (len(list_distinct(string_split(q, ' '))) >= 2 AND len(list_filter(string_split(q, ' '), lambda x: NOT list_contains(string_split(e, ' '), x))) = 0)) SELECT query_id, list_name, pos, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id, list_name ORDER BY pos) AS r FROM h) WHERE r = 1")
def watchlist_first_hits(t):
    q, e = people(t)
    return S.watchlists(q, e.select(F.concat(F.lit("L"), F.col("entity_id") % 2).alias("list_name"), F.col("entity_id").alias("pos"), "name"))


_sim = "least(1, 0.6::DOUBLE * (1 - levenshtein(q, e) / greatest(length(q), length(e), 1)::DOUBLE) + 0.4::DOUBLE * (len(list_filter(string_split(q, ' '), lambda s: len(list_filter(string_split(e, ' '), lambda t: levenshtein(s, t) <= 1)) > 0)) / greatest(len(string_split(q, ' ')), len(string_split(e, ' ')))::DOUBLE) + CASE WHEN contains(q, e) OR contains(e, q) THEN 0.1::DOUBLE ELSE 0 END)"


@query(
    f"WITH {PEOPLE}, p AS (SELECT query_id, entity_id, q, e FROM nq, ne WHERE q[1:2] = e[1:2]), x AS (SELECT query_id, entity_id, CASE WHEN q = e THEN 1.0 ELSE round({_sim}, 6) END::DOUBLE AS score, q = e AS same FROM p), y AS (SELECT *, bool_or(same) OVER (PARTITION BY query_id) AS exact FROM x WHERE score >= 0.85) "
    "SELECT q.query_id, count(y.query_id) AS n, coalesce(max(score), 0) AS best, CASE WHEN count(y.query_id) = 0 THEN 'CLEAR' WHEN max(score) >= 0.95 THEN 'SANCTIONED' ELSE 'REVIEW' END AS status FROM q LEFT JOIN y ON q.query_id = y.query_id AND (NOT exact OR same) GROUP BY 1"
)
def screen_requests(t):
    q, e = people(t)
    got = S.screen(q, e, match_types=("exact", "fuzzy"), include_aliases=False)
    return got.select("query_id", F.size("matches").cast("long").alias("n"), F.coalesce(F.array_max(F.col("matches.score")), F.lit(0.0)).alias("best"), "status")


@query(None)
def screen_requests_all(t):
    """All four stages."""
    got = S.screen(*people(t))
    return got.select("query_id", "status", F.size("matches").cast("long").alias("n"), F.get("matches", 0)["stage"].alias("stage"))


@query(None)
def event_firms(t):
    """Events by id, else by the most similar name of the suppliers, which take the names of customers."""
    q, _ = people(t)
    events = q.select(F.col("query_id").alias("event_id"), F.when(F.col("query_id") % 4 == 0, F.col("query_id")).alias("firm_id"), "name")
    firms = t.supplier.select(F.col("s_suppkey").alias("firm_id")).join(shuffled(q.withColumnRenamed("query_id", "firm_id")), "firm_id").select("firm_id", F.concat("name", F.lit(" plc")).alias("name"))
    return S.match_events(events, firms)


@query(f"WITH {PEOPLE}, p AS (SELECT entity_id, q, e FROM nq JOIN ne ON query_id = entity_id) SELECT entity_id, round(0.7::DOUBLE * CASE WHEN q = e THEN 1 ELSE {_sim} END + 0.3::DOUBLE * CASE WHEN {soundex_sql('q')} = {soundex_sql('e')} THEN 0.8 ELSE 0 END, 6)::DOUBLE AS combined FROM p")
def combined_similarity(t):
    q, e = people(t)
    d = q.select(F.col("query_id").alias("entity_id"), X.name_space(F.col("name")).alias("q")).join(e.select("entity_id", X.name_space(F.col("name")).alias("e")), "entity_id")
    return d.select("entity_id", F.round(X.combined_similarity(F.col("q"), F.col("e")), 6).alias("combined"))
