"""Queries on names, watchlists, extracted fields, pages and links."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from firmscope.functions import text as X
from firmscope.functions import values as V
from firmscope.operators import names as N
from firmscope.operators import screening as S
from firmscope.plans.registry import Tables, query

SIM = "least(1, 0.6::DOUBLE * (1 - levenshtein({a}, {b}) / greatest(length({a}), length({b}), 1)::DOUBLE) + 0.4::DOUBLE * (len(list_filter(string_split({a}, ' '), lambda s: len(list_filter(string_split({b}, ' '), lambda t: levenshtein(s, t) <= 1)) > 0)) / greatest(len(string_split({a}, ' ')), len(string_split({b}, ' ')))::DOUBLE) + CASE WHEN contains({a}, {b}) OR contains({b}, {a}) THEN 0.1::DOUBLE ELSE 0 END)"
#: Queries: each part's name, every second one with a letter dropped; entities: the distinct names.
SCREEN = "q AS (SELECT p_partkey AS query_id, CASE WHEN p_partkey % 4 = 1 THEN p_name[1:2] || p_name[4:] WHEN p_partkey % 4 = 3 THEN 'the ' || p_name ELSE upper(p_name) END AS name, CASE WHEN p_partkey % 4 = 1 THEN p_name[1:2] || p_name[4:] WHEN p_partkey % 4 = 3 THEN 'the ' || p_name ELSE p_name END AS nq FROM part), e AS (SELECT min(p_partkey) AS entity_id, p_name AS ne FROM part GROUP BY p_name)"


def watch(t: Tables):
    k, n = F.col("p_partkey") % 4, F.col("p_name")
    q = t.part.select(F.col("p_partkey").alias("query_id"), F.when(k == 1, F.concat(F.substring(n, 1, 2), F.substring(n, 4, 999))).when(k == 3, F.concat(F.lit("the "), n)).otherwise(F.upper(n)).alias("name"))
    e = t.part.groupBy(n.alias("name")).agg(F.min("p_partkey").alias("entity_id")).withColumn("aliases", F.array(F.concat(F.lit("the "), "name")))
    return q, e


@query("SELECT c_custkey AS firm_id, regexp_replace(lower(c_name), '[^a-z0-9\\s]', '', 'g') AS v1, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) AS v2, lower(c_mktsegment) || '-and-co' AS slug, lower(c_mktsegment) AS bare FROM customer")
def normalize_names(t):
    full = F.concat("c_mktsegment", F.lit(" & Co"))
    return t.customer.select(F.col("c_custkey").alias("firm_id"), X.name_delete(F.col("c_name")).alias("v1"), X.name_space(F.col("c_name")).alias("v2"), X.slug(full).alias("slug"), X.name_no_suffix(full).alias("bare"))


PAIRS = "pr AS (SELECT a.p_partkey AS a_id, b.p_partkey AS b_id, a.p_name AS a, b.p_name AS b FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_partkey < b.p_partkey AND a.p_size = b.p_size)"


def pairs(t, **scores):
    """Scores of all pairs of parts of a brand and size, on their names a and b."""
    return N.scored_pairs(t.part, "p_partkey", "p_name", ["p_brand", "p_size"], **scores)


@query(f"WITH {PAIRS} SELECT a_id, b_id, levenshtein(a, b) AS edits, round(CASE WHEN a = b THEN 1 ELSE {SIM.format(a='a', b='b')} END, 6)::DOUBLE AS similarity FROM pr")
def string_similarity(t):
    return pairs(t, edits=F.levenshtein("a", "b").cast("long"), similarity=F.round(X.similarity(F.col("a"), F.col("b")), 6))


TRI = "list_distinct(flatten(list_transform(string_split({c}, ' '), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


@query(f"WITH {PAIRS}, g AS (SELECT a_id, b_id, {TRI.format(c='a')} AS x, {TRI.format(c='b')} AS y FROM pr) SELECT a_id, b_id, round(len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y)))::DOUBLE, 6) AS trigram FROM g")
def trigram_similarity(t):
    return pairs(t, trigram=F.round(X.trigram_similarity(F.col("a"), F.col("b")), 6))


def soundex_sql(c: str) -> str:
    u = f"regexp_replace(upper({c}), '[^A-Z]', '', 'g')"
    code = f"translate({u}, 'AEIOUYHWBFPVCGJKQSXZDTLMNR', '00000000111122222222334556')"
    k = f"replace({code}, '0', '')"
    for d in "123456":
        k = f"regexp_replace({k}, '{d}+', '{d}', 'g')"
    return f"CASE WHEN {u} = '' THEN '0000' ELSE rpad(substr(substr({u}, 1, 1) || CASE WHEN substr({code}, 1, 1) = '0' THEN {k} ELSE substr({k}, 2) END, 1, 4), 4, '0') END"


@query(f"SELECT p_partkey, {soundex_sql('p_name')} AS code FROM part UNION ALL SELECT -n_nationkey - 1, {soundex_sql('n_name')} FROM nation")
def soundex_match(t):
    a = t.part.select("p_partkey", X.soundex(F.col("p_name")).alias("code"))
    return a.union(t.nation.select((-F.col("n_nationkey") - 1).cast("long"), X.soundex(F.col("n_name"))))


@query(
    f"WITH {SCREEN}, ex AS (SELECT query_id, entity_id FROM q JOIN e ON nq = ne), al AS (SELECT query_id, entity_id FROM q JOIN e ON nq = 'the ' || ne WHERE query_id NOT IN (SELECT query_id FROM ex)), fz AS (SELECT query_id, entity_id, round({SIM.format(a='nq', b='ne')}, 6) AS score FROM q, e WHERE query_id NOT IN (SELECT query_id FROM ex) AND query_id NOT IN (SELECT query_id FROM al)), ff AS (SELECT * FROM fz WHERE score >= 0.85) "
    "SELECT query_id, entity_id, 'exact' AS stage, 1.0::DOUBLE AS score FROM ex UNION ALL SELECT query_id, entity_id, 'alias', 0.95 FROM al UNION ALL SELECT query_id, entity_id, 'fuzzy', score FROM ff"
)
def screen_cascade(t):
    return S.cascade(*watch(t)).filter("stage <> 'phonetic'")


@query(None)
def screen_cascade_all(t):
    return S.cascade(*watch(t))


@query(f"WITH {SCREEN} SELECT query_id, entity_id FROM q JOIN e ON len(list_distinct(string_split(nq, ' '))) >= 2 AND len(list_filter(list_distinct(string_split(nq, ' ')), lambda x: NOT list_contains(string_split(ne, ' '), x))) = 0")
def token_subset_screen(t):
    return S.token_subset(*watch(t))


@query(None)
def difflib_best_match(t):
    return S.best_gestalt(*watch(t))


@query("SELECT p_partkey, p_size::DOUBLE AS drawdown, NULL::DOUBLE AS split FROM part")
def percent_near_label(t):
    s = F.concat(F.lit("Our Maximum Drawdown is "), F.col("p_size"), F.lit(" % of equity; daily "))
    return t.part.select("p_partkey", X.percent_near(s, "maximum drawdown").alias("drawdown"), X.percent_near(s, "profit split").alias("split"))


@query("SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'daily' WHEN 1 THEN 'weekly' WHEN 2 THEN 'weekly' WHEN 3 THEN 'monthly' END AS frequency, CASE p_size % 5 WHEN 0 THEN 1 WHEN 1 THEN 7 WHEN 2 THEN 14 WHEN 3 THEN 30 END AS delay_days FROM part")
def frequency_bands(t):
    k = F.col("p_size") % 5
    s = F.concat(F.lit("Payout "), F.when(k == 0, "Daily").when(k == 1, "weekly").when(k == 2, "biweekly").when(k == 3, "MONTHLY").otherwise("sometimes"))
    return t.part.select("p_partkey", X.frequency(s).alias("frequency"), X.delay_days(s).alias("delay_days"))


@query("SELECT doc_id, list_filter(list_transform(regexp_extract_all(text, '(?:19|20)[0-9]{2}'), lambda y: CAST(y AS INT)), lambda y: y BETWEEN 1990 AND 2026)[1] AS year FROM documents")
def year_extract(t):
    return t.documents.select("doc_id", X.first_year(F.col("text")).alias("year"))


@query("SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)), '^www\\.', '') AS host, split_part(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)), '^www\\.', ''), '.', -1) AS tld FROM pages")
def url_host_tld(t):
    h = X.host(F.col("url"))
    return t.pages.select("page_id", h.alias("host"), F.element_at(F.split(h, r"\."), -1).alias("tld"))


@query("SELECT page_id, rtrim(url, '/') AS bare, replace(url, 'http://', 'https://') AS secure, CASE WHEN url LIKE '%?%' THEN split_part(url, '?', 1) ELSE url END AS no_query FROM pages")
def url_variants(t):
    return t.pages.select("page_id", F.rtrim("url", F.lit("/")).alias("bare"), F.replace("url", F.lit("http://"), F.lit("https://")).alias("secure"), F.split_part("url", F.lit("?"), F.lit(1)).alias("no_query"))


@query(r"SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style|noscript|svg)\b.*?</(script|style|noscript|svg)\s*>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages")
def html_to_text(t):
    return t.pages.select("page_id", X.html_text(F.col("html")).alias("text"))


@query(r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href FROM pages), s AS (SELECT DISTINCT page_id, href, CASE WHEN regexp_matches(lower(href), 'rule|terms|page') THEN 6 ELSE 0 END + CASE WHEN href LIKE '/%' THEN 2 ELSE 0 END AS score FROM l) SELECT page_id, href, CAST(score AS BIGINT) AS score, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, href) AS rank FROM s""")
def link_scoring(t):
    l = t.pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("href")).distinct()
    score = F.when(F.lower("href").rlike("rule|terms|page"), 6).otherwise(0) + F.when(F.col("href").startswith("/"), 2).otherwise(0)
    s = l.withColumn("score", score.cast("long"))
    return s.withColumn("rank", F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("score"), "href")).cast("long"))


@query("SELECT doc_id, i AS chunk, length(substr(text, i * 900 + 1, 900)) AS n, md5(substr(text, i * 900 + 1, 900)) AS md5 FROM (SELECT doc_id, text, unnest(range(0, CAST(ceil(length(text) / 900.0) AS BIGINT))) AS i FROM documents)")
def chunk_text(t):
    d = t.documents.select("doc_id", F.posexplode(X.chunks(F.col("text"), 900)).alias("chunk", "c"))
    return d.select("doc_id", F.col("chunk").cast("long").alias("chunk"), F.length("c").cast("long").alias("n"), F.md5("c").alias("md5"))


@query(None)
def chunk_text_all(t):
    d = t.documents.select("doc_id", F.posexplode(X.chunks(F.col("text"))).alias("chunk", "c"))
    return d.select("doc_id", F.col("chunk").cast("long").alias("chunk"), F.length("c").cast("long").alias("n"), F.md5("c").alias("md5"))


@query("SELECT s_suppkey, 'sup ' || s_suppkey || ';alt ' || s_nationkey AS aliases, 'alt ' || s_nationkey AS hit FROM supplier")
def alias_extract(t):
    remark = F.concat(F.lit("a.k.a. 'Sup "), F.col("s_suppkey"), F.lit("'; f.k.a. 'Alt "), F.col("s_nationkey"), F.lit("'; a.k.a. 'SUP "), F.col("s_suppkey"), F.lit("'"))
    a = X.aliases(remark)
    return t.supplier.select("s_suppkey", F.array_join(a, ";").alias("aliases"), F.get(F.filter(a, lambda x: x.startswith("alt")), 0).alias("hit"))


@query("WITH h AS (SELECT page_id, string_split(regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/:?#]+)', 1)), '^www\\.', ''), '.') AS p FROM pages), x AS (SELECT page_id, array_to_string(p, '.') AS h, array_to_string(p[greatest(len(p) - 1, 1):], '.') AS h2 FROM h) SELECT page_id, h || ',' || CASE WHEN h2 <> h THEN h2 || ',' ELSE '' END AS suffixes FROM x")
def host_fallbacks(t):
    s = X.host_suffixes(X.host(F.col("url")))
    return t.pages.select("page_id", F.concat(F.array_join(F.slice(s, 1, 2), ","), F.lit(",")).alias("suffixes"))


@query("SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'suspend|revoke') THEN 'suspension' WHEN regexp_matches(lower(text), 'licensed|license') THEN 'license' WHEN regexp_matches(lower(text), '@') THEN 'contact' ELSE 'other' END AS event_type, substr(trim(regexp_replace(text, '[ \\n\\t]+', ' ', 'g')), 1, 80) AS excerpt, substr(sha256(source || ':' || doc_id), 1, 12) AS event_key FROM documents")
def classify_text(t):
    low = F.lower("text")
    kind = F.when(low.rlike("suspend|revoke"), "suspension").when(low.rlike("licensed|license"), "license").when(low.contains("@"), "contact").otherwise("other")
    excerpt = F.substring(F.trim(F.regexp_replace("text", r"[ \n\t]+", " ")), 1, 80)
    return t.documents.select("doc_id", kind.alias("event_type"), excerpt.alias("excerpt"), F.substring(F.sha2(F.concat("source", F.lit(":"), "doc_id"), 256), 1, 12).alias("event_key"))


@query("SELECT conv_id, max(CASE WHEN role = 'user' THEN turn END) AS last_user, count(*) FILTER (WHERE role = 'assistant') AS answers, string_agg(role, '>' ORDER BY turn) AS roles FROM conversations GROUP BY 1")
def submission_threads(t):
    g = t.conversations.groupBy("conv_id").agg(F.max(F.when(F.col("role") == "user", F.col("turn"))).alias("last_user"), F.count_if(F.col("role") == "assistant").alias("answers"), F.sort_array(F.collect_list(F.struct("turn", "role"))).alias("x"))
    return g.select("conv_id", "last_user", "answers", F.array_join(F.col("x.role"), ">").alias("roles"))


@query("SELECT source, count(*) AS reviews, round(avg(CASE WHEN toxic = 1 THEN 1.0::DOUBLE ELSE 0 END), 6) AS negative, CASE WHEN avg(CASE WHEN toxic = 1 THEN 1.0 ELSE 0 END) > 0.3 THEN 'HIGH' WHEN avg(CASE WHEN toxic = 1 THEN 1.0 ELSE 0 END) > 0.15 THEN 'MEDIUM' ELSE 'LOW' END AS risk FROM documents JOIN labels USING (doc_id) GROUP BY 1")
def reputation_risk(t):
    neg = F.avg(F.when(F.col("toxic") == 1, 1.0).otherwise(0.0))
    g = t.documents.select("doc_id", "source").join(t.labels.select("doc_id", "toxic"), "doc_id").groupBy("source").agg(F.count("*").alias("reviews"), neg.alias("n"))
    return g.select("source", "reviews", F.round("n", 6).alias("negative"), F.when(F.col("n") > 0.3, "HIGH").when(F.col("n") > 0.15, "MEDIUM").otherwise("LOW").alias("risk"))


@query(f"WITH {PAIRS}, x AS (SELECT a_id, b_id, 0.5::DOUBLE * CASE WHEN a = b THEN 100 ELSE 0 END + 0.3::DOUBLE * (1 - levenshtein(a, b) / greatest(length(a), length(b))::DOUBLE) * 90 + 0.2::DOUBLE * CASE WHEN {soundex_sql('a')} = {soundex_sql('b')} THEN 70 ELSE 0 END AS s FROM pr) SELECT a_id, b_id, round(s, 5) AS score, CASE WHEN s >= 95 THEN 'EXACT' WHEN s >= 80 THEN 'PARTIAL' ELSE 'PHONETIC' END AS kind FROM x")
def watchlist_spec_score(t):
    a, b = F.col("a"), F.col("b")
    s = 0.5 * F.when(a == b, 100).otherwise(0) + 0.3 * X.edit_similarity(a, b) * 90 + 0.2 * F.when(X.soundex(a) == X.soundex(b), 70).otherwise(0)
    return pairs(t, score=F.round(s, 5), kind=V.band(s, [(95, "EXACT"), (80, "PARTIAL")], "PHONETIC"))
