"""Queries on evidence, rules, agents' findings, and composite reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from firmscope.functions import rules as L
from firmscope.functions import text as X
from firmscope.functions import values as V
from firmscope.operators import relational as R
from firmscope.plans.firm_queries import FEATURES, SCORES, last_two, pillars, scores
from firmscope.plans.registry import query


def flags(*pairs):
    """Comma-joined names of the conditions that hold."""
    return F.array_join(F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in pairs))), ",")


@query("SELECT p_partkey, concat_ws(',', CASE WHEN p_size > 40 THEN 'drawdown' END, CASE WHEN p_retailprice < 950 THEN 'cheap' END, CASE WHEN p_type IS NULL OR p_type = '' THEN 'no_type' END, CASE WHEN p_size % 7 = 0 THEN 'odd_size' END) AS red_flags, round(1.0::DOUBLE - 0.2 * ((p_size > 40)::INT + (p_retailprice < 950)::INT + (p_size % 7 = 0)::INT), 4)::DOUBLE AS confidence FROM part")
def audit_rules(t):
    a, b, c, d = F.col("p_size") > 40, F.col("p_retailprice") < 950, V.is_blank(F.col("p_type")), F.col("p_size") % 7 == 0
    n = sum((x.cast("int") for x in (a, b, d)), F.lit(0))
    return t.part.select("p_partkey", flags(("drawdown", a), ("cheap", b), ("no_type", c), ("odd_size", d)).alias("red_flags"), F.round(1.0 - 0.2 * n, 4).alias("confidence"))


@query("WITH c AS (SELECT user_id AS firm_id, count(*) FILTER (WHERE event_type = 'error' AND value > 60) AS crit FROM events GROUP BY 1) SELECT firm_id, crit, CASE WHEN crit >= 5 THEN 'non_compliant' WHEN crit >= 3 THEN 'partial' WHEN crit >= 1 THEN 'mostly' ELSE 'compliant' END AS class FROM c")
def compliance_class(t):
    c = t.events.groupBy(F.col("user_id").alias("firm_id")).agg(F.count_if((F.col("event_type") == "error") & (F.col("value") > 60)).alias("crit"))
    return c.withColumn("class", V.band(F.col("crit"), [(5, "non_compliant"), (3, "partial"), (1, "mostly")], "compliant"))


@query("WITH w AS (SELECT user_id AS firm_id, max(value) AS top, bool_or(event_type = 'error') AS listed FROM events WHERE value > 40 GROUP BY 1) SELECT firm_id, CASE WHEN listed THEN -1.0::DOUBLE WHEN top > 90 THEN -0.7::DOUBLE WHEN top > 75 THEN -0.4::DOUBLE ELSE -0.1::DOUBLE END AS impact FROM w")
def watchlist_impact(t):
    lists = F.collect_set(F.when(F.col("event_type") == "error", "OFAC").otherwise("EU"))
    w = t.events.filter("value > 40").groupBy(F.col("user_id").alias("firm_id")).agg(F.max("value").alias("top"), lists.alias("lists"))
    return w.select("firm_id", L.watchlist_impact(F.col("lists"), F.col("top") / 100).alias("impact"))


@query("WITH r AS (SELECT o_custkey AS firm_id, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0::DOUBLE ELSE 0 END) AS share, count(*) AS n FROM orders GROUP BY 1) SELECT firm_id, share > 0.15 AS surge, CASE WHEN share > 0.25 THEN -0.6::DOUBLE WHEN share > 0.15 THEN -0.35::DOUBLE ELSE 0.0::DOUBLE END AS surge_impact, CASE WHEN n > 15 THEN -0.75::DOUBLE WHEN n > 8 THEN -0.45::DOUBLE ELSE 0.0::DOUBLE END AS complaint_impact FROM r")
def surge_rules(t):
    r = t.orders.groupBy(F.col("o_custkey").alias("firm_id")).agg(F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("s"), F.count("*").alias("n"))
    surge, complaints = L.review_surge(F.col("s")), L.payout_complaints(F.col("n"), F.lit(1.0))
    return r.select("firm_id", surge["has_issue"].alias("surge"), surge["impact"].alias("surge_impact"), complaints["impact"].alias("complaint_impact"))


@query("SELECT s_suppkey AS firm_id, concat_ws(' | ', CASE WHEN s_acctbal < 0 THEN 'Account is negative.' END, CASE WHEN s_nationkey IN (3, 7, 11) THEN 'Registered offshore.' END, CASE WHEN s_acctbal >= 0 AND s_nationkey NOT IN (3, 7, 11) THEN 'No findings.' END) AS notes, CASE WHEN s_acctbal < 0 AND s_nationkey IN (3, 7, 11) THEN 'high' WHEN s_acctbal < 0 OR s_nationkey IN (3, 7, 11) THEN 'medium' ELSE 'low' END AS risk FROM supplier")
def company_rules(t):
    a, b = F.col("s_acctbal") < 0, F.col("s_nationkey").isin(3, 7, 11)
    notes = F.concat_ws(" | ", F.when(a, "Account is negative."), F.when(b, "Registered offshore."), F.when(~a & ~b, "No findings."))
    return t.supplier.select(F.col("s_suppkey").alias("firm_id"), notes.alias("notes"), F.when(a & b, "high").when(a | b, "medium").otherwise("low").alias("risk"))


@query("SELECT o_custkey AS firm_id, CAST(20 * (count(*) > 5)::INT + 20 * (max(o_totalprice) > 200000)::INT + 10 * (count(DISTINCT o_orderstatus) > 1)::INT + 20 * (min(o_totalprice) > 2000)::INT + 20 * bool_or(o_orderpriority = '1-URGENT')::INT AS BIGINT) AS score FROM orders GROUP BY 1")
def principles_score(t):
    parts = [(20, F.count("*") > 5), (20, F.max("o_totalprice") > 200000), (10, F.count_distinct("o_orderstatus") > 1), (20, F.min("o_totalprice") > 2000), (20, F.bool_or(F.col("o_orderpriority") == "1-URGENT"))]
    return t.orders.groupBy(F.col("o_custkey").alias("firm_id")).agg(sum((n * c.cast("int") for n, c in parts), F.lit(0)).cast("long").alias("score"))


@query("WITH r AS (SELECT c_custkey AS firm_id, c_acctbal >= 0 AS authorized FROM customer), s AS (SELECT user_id AS firm_id, max(value) AS hit FROM events WHERE event_type = 'error' GROUP BY 1) SELECT firm_id, CASE WHEN hit > 95 THEN 'REJECTED' WHEN NOT authorized OR hit > 60 THEN 'REVIEW' ELSE 'VERIFIED' END AS status, concat_ws(',', CASE WHEN NOT authorized THEN 'unauthorized' END, CASE WHEN hit > 60 THEN 'sanctions' END) AS factors FROM r LEFT JOIN s USING (firm_id)")
def combined_verify(t):
    r = t.customer.select(F.col("c_custkey").alias("firm_id"), (F.col("c_acctbal") >= 0).alias("ok"))
    s = t.events.filter("event_type = 'error'").groupBy(F.col("user_id").alias("firm_id")).agg(F.max("value").alias("hit"))
    hit = F.coalesce("hit", F.lit(-1.0))
    return r.join(s, "firm_id", "left").select("firm_id", F.when(hit > 95, "REJECTED").when(~F.col("ok") | (hit > 60), "REVIEW").otherwise("VERIFIED").alias("status"), flags(("unauthorized", ~F.col("ok")), ("sanctions", hit > 60)).alias("factors"))


@query(f"WITH {SCORES} SELECT firm_id, snapshot_id, score, lag(score) OVER (PARTITION BY firm_id ORDER BY snapshot_id) AS previous, score < 50 OR na_rate > 0.5 AS investigate FROM scores")
def history_with_previous(t):
    w = Window.partitionBy("firm_id").orderBy("snapshot_id")
    return scores(t).select("firm_id", "snapshot_id", "score", F.lag("score").over(w).alias("previous"), ((F.col("score") < 50) | (F.col("na_rate") > 0.5)).alias("investigate"))


@query(f"WITH {SCORES} SELECT snapshot_id, count(*) AS n, round(avg(score), 4) AS mean_score, min(score) AS low, max(score) AS high FROM scores GROUP BY 1")
def snapshot_summary(t):
    return scores(t).groupBy("snapshot_id").agg(F.count("*").alias("n"), F.round(F.avg("score"), 4).alias("mean_score"), F.min("score").alias("low"), F.max("score").alias("high"))


@query(f"WITH {SCORES}, j AS (SELECT s_nationkey AS tier, abs(cur.score - prev.score) AS d FROM cur JOIN prev USING (firm_id) JOIN supplier ON firm_id = s_suppkey) SELECT tier, round(avg(d), 5) AS volatility, max(d) AS largest, count(*) AS firms FROM j GROUP BY 1")
def jurisdiction_volatility(t):
    cur, prev = last_two(t)
    j = cur.alias("c").join(prev.alias("p"), "firm_id").select("firm_id", F.abs(F.col("c.score") - F.col("p.score")).alias("d")).join(t.supplier.select(F.col("s_suppkey").alias("firm_id"), F.col("s_nationkey").alias("tier")), "firm_id")
    return j.groupBy("tier").agg(F.round(F.avg("d"), 5).alias("volatility"), F.max("d").alias("largest"), F.count("*").alias("firms"))


@query(f"WITH {FEATURES} SELECT firm_id, max(CASE WHEN pillar = 'payout' THEN round(ps, 6) END) AS payout, max(CASE WHEN pillar = 'risk' THEN round(ps, 6) END) AS risk, string_agg(pillar, ',' ORDER BY pillar) AS pillars FROM p GROUP BY 1")
def pillar_map(t):
    m = F.map_from_entries(F.collect_list(F.struct("pillar", F.round("ps", 6))))
    d = pillars(t).groupBy("firm_id").agg(m.alias("m"))
    return d.select("firm_id", F.try_element_at("m", F.lit("payout")).alias("payout"), F.try_element_at("m", F.lit("risk")).alias("risk"), F.array_join(F.array_sort(F.map_keys("m")), ",").alias("pillars"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.none') AS missing, sha256('{\"id\":' || event_id || ',\"k\":' || json_extract_string(props, '$.k') || '}') AS canonical FROM events")
def json_fields(t):
    k = F.get_json_object("props", "$.k").cast("long")
    return t.events.select("event_id", k.alias("k"), F.get_json_object("props", "$.none").alias("missing"), F.sha2(F.to_json(F.struct(F.col("event_id").alias("id"), k.alias("k"))), 256).alias("canonical"))


@query("SELECT event_id, '2024-01-' || lpad(CAST(1 + event_id % 40 AS VARCHAR), 2, '0') AS raw, CASE WHEN event_id % 40 < 31 THEN CAST('2024-01-' || lpad(CAST(1 + event_id % 40 AS VARCHAR), 2, '0') AS DATE) END AS day FROM events")
def parse_dates(t):
    raw = F.concat(F.lit("2024-01-"), F.lpad((1 + F.col("event_id") % 40).cast("string"), 2, "0"))
    return t.events.select("event_id", raw.alias("raw"), F.to_date(F.coalesce(F.try_to_timestamp(raw, F.lit("yyyy-MM-dd'T'HH:mm:ssX")), F.try_to_timestamp(raw, F.lit("yyyy-MM-dd")))).alias("day"))


@query("SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN 'FUTURES' WHEN s_acctbal > 0 THEN 'CFD_FX' ELSE 'HYBRID' END AS model_type, CASE WHEN s_nationkey % 4 = 0 THEN 'active' WHEN s_nationkey % 4 = 1 THEN 'active' WHEN s_nationkey % 4 = 2 THEN 'suspended' ELSE 'unknown' END AS status FROM supplier")
def normalize_status(t):
    k = F.col("s_nationkey") % 4
    text = F.lower(F.when(k == 0, "ACTIVE firm").when(k == 1, "Inactive").when(k == 2, "Suspended").otherwise("?"))
    kind = F.upper(F.when(F.col("s_acctbal") > 5000, "futures only").when(F.col("s_acctbal") > 0, "cfd fx").otherwise("mixed"))
    status = F.when(text.contains("active"), "active").when(text.contains("suspend"), "suspended").when(text.contains("expire"), "expired").otherwise("unknown")
    return t.supplier.select("s_suppkey", F.when(kind.rlike("FUTURES"), "FUTURES").when(kind.rlike("CFD|FX"), "CFD_FX").otherwise("HYBRID").alias("model_type"), status.alias("status"))


@query("SELECT url, page_id, rank FROM (SELECT url, page_id, row_number() OVER (PARTITION BY split_part(url, '/', 3) ORDER BY length(url) DESC, page_id) AS rank FROM (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url)) WHERE rank <= 2")
def diverse_candidates(t):
    d = t.pages.groupBy("url").agg(F.min("page_id").alias("page_id")).withColumn("slug", F.split_part("url", F.lit("/"), F.lit(3)))
    return R.top_per_group(d, ["slug"], 2, F.length("url").desc(), F.col("page_id")).select("url", "page_id", F.col("rank").cast("long").alias("rank"))


@query("WITH k AS (SELECT doc_id, source, sha256(text) AS h, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS r FROM documents) SELECT source, string_agg(substr(h, 1, 12), ',' ORDER BY doc_id) AS evidence FROM k WHERE r <= 3 GROUP BY 1")
def first_evidence(t):
    k = R.top_per_group(t.documents.select("doc_id", "source", "lang", F.sha2("text", 256).alias("h")), ["source", "lang"], 3, F.col("doc_id"))
    g = k.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("doc_id", F.substring("h", 1, 12).alias("h")))).alias("x"))
    return g.select("source", F.array_join(F.col("x.h"), ",").alias("evidence"))


@query("SELECT count(*) AS checked, count(*) FILTER (WHERE value >= 30) AS ok, round(count(*) FILTER (WHERE value >= 30) / count(*), 6)::DOUBLE AS ratio, max(value) AS slowest FROM events WHERE event_type IN ('view', 'click')")
def access_summary(t):
    d = t.events.filter(F.col("event_type").isin("view", "click"))
    ok = F.count_if(F.col("value") >= 30)
    return d.agg(F.count("*").alias("checked"), ok.alias("ok"), F.round(V.share(ok, F.count("*")), 6).alias("ratio"), F.max("value").alias("slowest"))


@query("WITH a AS (SELECT event_type AS agent, count(*) AS evidence FROM events WHERE value > 20 GROUP BY 1), e AS (SELECT unnest(['click', 'error', 'view', 'rvi', 'sss']) AS agent) SELECT agent, coalesce(evidence, 0) AS evidence, CASE WHEN evidence IS NULL THEN 'missing' WHEN evidence > 1000 THEN 'active' ELSE 'idle' END AS status FROM e LEFT JOIN a USING (agent)")
def agent_status(t):
    a = t.events.filter("value > 20").groupBy(F.col("event_type").alias("agent")).agg(F.count("*").alias("evidence"))
    e = t.spark.createDataFrame([(x,) for x in ("click", "error", "view", "rvi", "sss")], "agent string")
    return e.join(a, "agent", "left").select("agent", F.coalesce("evidence", F.lit(0)).alias("evidence"), F.when(F.col("evidence").isNull(), "missing").when(F.col("evidence") > 1000, "active").otherwise("idle").alias("status"))


@query("SELECT c_custkey AS firm_id, 'curator-' || (c_custkey % 3) AS route FROM customer WHERE c_acctbal < 1000 UNION ALL SELECT c_custkey, 'evidence' FROM customer WHERE c_acctbal >= 1000")
def submission_routing(t):
    d = t.customer.select(F.col("c_custkey").alias("firm_id"), F.when(F.col("c_acctbal") >= 1000, "evidence").otherwise(F.concat(F.lit("curator-"), F.pmod("c_custkey", F.lit(3)))).alias("route"))
    return d


@query("SELECT c_custkey AS firm_id FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'HOUSEHOLD' EXCEPT SELECT user_id FROM events WHERE event_type = 'purchase'")
def enrichment_targets(t):
    d = t.customer.filter((F.col("c_acctbal") < 0) | (F.col("c_mktsegment") == "HOUSEHOLD")).select(F.col("c_custkey").alias("firm_id"))
    return d.join(t.events.filter("event_type = 'purchase'").select(F.col("user_id").alias("firm_id")), "firm_id", "left_anti").distinct()


def firms_found(t, customers):
    dim = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.when(F.lower("r_name").contains("eu"), "Tier 1").when(F.col("r_name") == "AMERICA", "Tier 2").otherwise("Tier 3").alias("jurisdiction_tier"))
    return customers.join(dim, "c_nationkey").select(F.lower("c_name").alias("firm_id"), F.col("c_mktsegment").alias("model_type"), "jurisdiction_tier")


@query("SELECT lower(c_name) AS firm_id, c_mktsegment AS model_type, CASE WHEN r_name = 'EUROPE' THEN 'Tier 1' WHEN r_name = 'AMERICA' THEN 'Tier 2' ELSE 'Tier 3' END AS jurisdiction_tier FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def discover_firms(t):
    return firms_found(t, t.customer)


@query(None)
def discover_firms_all(t):
    return firms_found(t, t.customer)


@query("SELECT o_custkey AS firm_id, CASE WHEN count(*) FILTER (WHERE o_orderpriority = '1-URGENT') = 0 THEN 'PENDING' ELSE 'CONFIRMED' END AS filing, count(DISTINCT date_trunc('quarter', o_orderdate)) AS periods FROM orders GROUP BY 1 UNION ALL SELECT c_custkey, 'REJECTED', 0 FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def filing_status(t):
    o = t.orders.groupBy(F.col("o_custkey").alias("firm_id")).agg(F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("u"), F.count_distinct(F.date_trunc("quarter", "o_orderdate")).alias("p"))
    d = t.customer.select(F.col("c_custkey").alias("firm_id")).join(o, "firm_id", "full_outer")
    return d.select("firm_id", F.when(F.col("u").isNull(), "REJECTED").when(F.col("u") == 0, "PENDING").otherwise("CONFIRMED").alias("filing"), F.coalesce("p", F.lit(0)).alias("periods"))


@query("SELECT o_custkey AS firm_id, round(regr_slope(o_totalprice, date_diff('day', DATE '1990-01-01', CAST(o_orderdate AS DATE))), 4) AS slope, count(*) AS n FROM orders GROUP BY 1 HAVING count(DISTINCT CAST(o_orderdate AS DATE)) > 2")
def future_risk_slope(t):
    d = t.orders.select(F.col("o_custkey").alias("firm_id"), "o_totalprice", F.datediff(F.to_date("o_orderdate"), F.lit("1990-01-01").cast("date")).alias("day"))
    return d.groupBy("firm_id").agg(F.round(F.regr_slope("o_totalprice", "day"), 4).alias("slope"), F.count("*").alias("n"), F.count_distinct("day").alias("k")).filter("k > 2").drop("k")


@query("SELECT CAST(n_nationkey AS BIGINT) AS code, CASE WHEN n_nationkey IN (1, 2, 3) THEN 'A' WHEN n_nationkey IN (4, 5, 6, 7) THEN 'B' WHEN n_nationkey < 15 THEN 'C' WHEN n_nationkey < 22 THEN 'D' ELSE 'UNKNOWN' END AS tier FROM nation")
def jurisdiction_tiers(t):
    k = F.col("n_nationkey")
    return t.nation.select(k.cast("long").alias("code"), F.when(k.isin(1, 2, 3), "A").when(k.isin(4, 5, 6, 7), "B").when(k < 15, "C").when(k < 22, "D").otherwise("UNKNOWN").alias("tier"))


@query("WITH r AS (SELECT lang AS field, avg(CASE WHEN trim(text) <> '' THEN 100.0::DOUBLE ELSE 0 END) AS text_pct, avg(CASE WHEN source IS NOT NULL THEN 100.0::DOUBLE ELSE 0 END) AS source_pct FROM documents GROUP BY 1) SELECT field, 'source' AS name, round(source_pct, 4) AS pct FROM r UNION ALL SELECT field, 'text', round(text_pct, 4) FROM r")
def field_completeness(t):
    pct = lambda c: F.round(F.avg(F.when(c, 100.0).otherwise(0.0)), 4)
    r = t.documents.groupBy(F.col("lang").alias("field")).agg(pct(~V.is_blank(F.col("text"))).alias("text"), pct(F.col("source").isNotNull()).alias("source"))
    return r.unpivot("field", ["source", "text"], "name", "pct")


def truthy(lines):
    w = Window.partitionBy("l_orderkey")
    return lines.select("l_orderkey", "l_linenumber", F.bool_and(F.col("l_quantity") > 5).over(w).alias("all_large"), F.pmod(F.col("l_quantity"), F.lit(7)).cast("long").alias("modulo"), F.round(F.coalesce(V.truthy_coalesce(F.col("l_discount")), F.col("l_tax")), 4).alias("first_truthy"))


@query("SELECT l_orderkey, l_linenumber, bool_and(l_quantity > 5) OVER (PARTITION BY l_orderkey) AS all_large, CAST(l_quantity % 7 AS BIGINT) AS modulo, round(coalesce(nullif(l_discount, 0), l_tax), 4) AS first_truthy FROM lineitem")
def truthy_fields(t):
    return truthy(t.lineitem)


@query(None)
def truthy_fields_all(t):
    return truthy(t.lineitem)


@query("SELECT n_name AS list_name, s_suppkey, s_name FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE n_regionkey <> 0 AND s_name ILIKE 'supp%' AND s_acctbal BETWEEN 0 AND 9000")
def active_sanctions(t):
    s = t.supplier.filter(F.col("s_name").ilike("supp%") & F.col("s_acctbal").between(0, 9000))
    return s.join(t.nation.filter("n_regionkey <> 0"), F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("list_name"), "s_suppkey", "s_name")


@query("SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders WHERE o_orderstatus IN ('O', 'P') ORDER BY o_orderdate DESC, o_orderkey LIMIT 20")
def recent_queue(t):
    return t.orders.filter(F.col("o_orderstatus").isin("O", "P")).orderBy(F.desc("o_orderdate"), "o_orderkey").limit(20).select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


@query("WITH b AS (SELECT c_custkey AS firm_id, c_name AS brand, c_mktsegment AS seg FROM customer), o AS (SELECT 'customer#' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS k, CASE WHEN c_custkey % 4 = 0 THEN '  ' ELSE 'Override ' || c_custkey END AS brand FROM customer WHERE c_custkey % 2 = 0) SELECT firm_id, coalesce(nullif(trim(o.brand), ''), b.brand) AS brand, o.k IS NOT NULL AS has_override FROM b LEFT JOIN o ON lower(b.brand) = o.k")
def override_merge(t):
    o = t.customer.filter("c_custkey % 2 = 0").select(F.lower("c_name").alias("k"), F.when(F.col("c_custkey") % 4 == 0, "  ").otherwise(F.concat(F.lit("Override "), "c_custkey")).alias("over"))
    d = t.customer.join(o, F.lower("c_name") == F.col("k"), "left")
    return d.select(F.col("c_custkey").alias("firm_id"), V.filled(F.col("c_name"), F.col("over")).alias("brand"), F.col("k").isNotNull().alias("has_override")).withColumn("brand", F.trim("brand"))


@query("SELECT conv_id, turn, CASE WHEN regexp_matches(lower(text), 'fraud|scam|illegal') THEN 'high' WHEN regexp_matches(lower(text), 'risk|warn|er') THEN 'medium' ELSE 'low' END AS level, len(list_filter(string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) > 3)) AS words FROM conversations")
def risk_keywords(t):
    low = F.lower("text")
    words = F.filter(F.split(F.trim(F.regexp_replace(low, "[^a-z0-9]+", " ")), " "), lambda w: F.length(w) > 3)
    return t.conversations.select("conv_id", "turn", F.when(low.rlike("fraud|scam|illegal"), "high").when(low.rlike("risk|warn|er"), "medium").otherwise("low").alias("level"), F.size(words).cast("long").alias("words"))


@query("WITH v AS (SELECT p_brand, list_sort(list_distinct(list(p_size))) AS sizes, count(*) AS n FROM part GROUP BY 1) SELECT p_brand, array_to_string(sizes[1:5], ',') AS first5, len(sizes) AS distinct_sizes, list_contains(sizes, 7) AS has7, CAST(list_sum(sizes) AS BIGINT) AS total FROM v")
def array_functions(t):
    v = t.part.groupBy("p_brand").agg(F.sort_array(F.collect_set("p_size")).alias("s"))
    return v.select("p_brand", F.array_join(F.slice("s", 1, 5), ",").alias("first5"), F.size("s").cast("long").alias("distinct_sizes"), F.array_contains("s", 7).alias("has7"), F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<h[1-3][^>]*>')) AS headings, html ILIKE '%captcha%' AS captcha, CASE WHEN regexp_matches(url, 'rule|terms') THEN 'rules' WHEN regexp_matches(url, 'price|plan') THEN 'pricing' ELSE 'home' END AS kind FROM pages")
def page_fields(t):
    kind = F.when(F.col("url").rlike("rule|terms"), "rules").when(F.col("url").rlike("price|plan"), "pricing").otherwise("home")
    return t.pages.select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.size(F.regexp_extract_all("html", F.lit("(<h[1-3][^>]*>)"), F.lit(1))).cast("long").alias("headings"), F.col("html").ilike("%captcha%").alias("captcha"), kind.alias("kind"))


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS search_text, (len(list_intersect(string_split(p_name, ' '), ['cold', 'widget', 'gear'])) / 3.0)::DOUBLE AS rank FROM part WHERE len(list_intersect(string_split(p_name, ' '), ['cold', 'widget', 'gear'])) > 0")
def full_text_rank(t):
    name = X.name_space(F.col("p_name"))
    n = F.size(F.array_intersect(X.tokens(name), F.array(*(F.lit(x) for x in ("cold", "widget", "gear")))))
    return t.part.withColumn("n", n).filter("n > 0").select("p_partkey", name.alias("search_text"), (F.col("n") / 3).alias("rank"))
