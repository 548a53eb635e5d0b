"""Screening against all pairs, readers of watchlists, pages, the gate, and sinks."""

import difflib
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from firmscope.functions import extract as E
from firmscope.functions import rules as L
from firmscope.functions import text as X
from firmscope.operators import links as K
from firmscope.operators import relational as R
from firmscope.operators import scoring as C
from firmscope.operators import screening as S
from firmscope.operators import validation as A
from firmscope.sources import readers, watchlists, writers


def names(seed, n):
    r = random.Random(seed)
    parts = ["acme", "acmee", "trading", "tradin", "corp", "ltd", "brackwell", "frackwelt", "bo", "a", "holdings", "north", "nort", "x1"]
    out = []
    for _ in range(n):
        w = [r.choice(parts) for _ in range(r.randint(1, 4))]
        if r.random() < 0.4:
            k = r.randrange(len(w))
            w[k] = w[k][: r.randint(0, len(w[k]))] + r.choice("abz") + w[k][r.randint(0, len(w[k])) :]
        out.append(" ".join(w))
    return out


def frames(spark, a, b):
    q = spark.createDataFrame(list(enumerate(a)), "query_id long, name string")
    e = spark.createDataFrame([(i, n, []) for i, n in enumerate(b)], "entity_id long, name string, aliases array<string>")
    return q, e


def test_gestalt_finds_all_pairs(spark):
    a, b = [*names(1, 60), "acme", "", "ab", "brackwell"], [*names(2, 60), "acme in a longer name", "frackwelt", "a", "abc"]
    got = {(r["query_id"], r["entity_id"]): r["score"] for r in S.gestalt_matches(*frames(spark, a, b)).collect()}
    want = {}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            if x and y:
                s = difflib.SequenceMatcher(None, x, y).ratio()
                s = max(s, 0.85) if x in y or y in x else s
                if s >= 0.75:
                    want[i, j] = round(s, 6)
    assert got == pytest.approx(want) and len(want) > 100
    best = {r["query_id"]: r["entity_id"] for r in S.best_gestalt(*frames(spark, a, b)).collect()}
    assert best == {i: min((-s, j) for (k, j), s in want.items() if k == i)[1] for i in {k for k, _ in want}}


@pytest.mark.parametrize("threshold", [0.72, 0.85])
def test_similar_finds_all_pairs(spark, threshold):
    a, b = sorted(set(names(3, 70))), sorted(set(names(4, 70)))
    q, e = spark.createDataFrame([(x,) for x in a], "q_norm string"), spark.createDataFrame([(x,) for x in b], "e_norm string")
    got = {(r["q_norm"], r["e_norm"]) for r in S.similar(q, e, threshold).collect()}
    every = q.join(e, F.lit(True)).filter(F.round(X.similarity(F.col("q_norm"), F.col("e_norm")), 6) >= threshold)  # small lists
    assert got == {(r["q_norm"], r["e_norm"]) for r in every.collect()} and got


def test_trigram_top_finds_all(spark):
    a, b = sorted(set(names(5, 40))), sorted(set(names(6, 40)))
    q, e = frames(spark, a, b)
    got = {(r["query_id"], r["entity_id"]) for r in K.trigram_top(q, e, 0.4, 1000).collect()}
    every = q.withColumnRenamed("name", "n").join(e, F.lit(True)).filter(F.round(X.trigram_similarity(F.col("n"), F.col("name")), 6) >= 0.4)  # small lists
    assert got == {(r["query_id"], r["entity_id"]) for r in every.collect()} and got


def test_watchlists(spark):
    q = spark.createDataFrame([(1, "Acme Trading Ltd"), (2, "Acme"), (3, ""), (4, None), (5, "trading ACME"), (6, "Nobody Inc")], "query_id long, name string")
    e = spark.createDataFrame([("OFAC", 1, "Other"), ("OFAC", 2, "Acme Trading Corporation Holdings"), ("OFAC", 3, "ACME TRADING"), ("UN", 1, "acme trading"), ("UN", 2, "")], "list_name string, pos long, name string")
    got = sorted(tuple(r) for r in S.watchlists(q, e).collect())
    assert got == [(1, "OFAC", 2, 0.85), (1, "UN", 1, 0.98), (5, "OFAC", 2, 0.85), (5, "UN", 1, 0.85)]


def test_screen(spark):
    e = spark.createDataFrame([(1, "John Smith", ["Jon Smith"]), (2, "Acme Trading Corp", []), (3, "Robert Marks", [])], "entity_id long, name string, aliases array<string>")
    q = spark.createDataFrame([(1, "JOHN SMITH"), (2, "jon smith"), (3, "Acme Tradin Corp"), (4, "Nobody"), (5, ""), (6, None), (7, "Robert Merks")], "query_id long, name string")
    got = {r["query_id"]: (r["status"], [(m["entity_id"], m["stage"]) for m in r["matches"]]) for r in S.screen(q, e).collect()}
    assert got == {1: ("SANCTIONED", [(1, "exact")]), 2: ("SANCTIONED", [(1, "alias")]), 3: (got[3][0], [(2, "fuzzy")]), 4: ("CLEAR", []), 5: ("CLEAR", []), 6: ("CLEAR", []), 7: (got[7][0], [(3, "fuzzy")])}
    assert S.screen(q.limit(0), e).collect() == []
    events = spark.createDataFrame([(1, 2, "x"), (2, None, "acme trading"), (3, 99, "zzz")], "event_id long, firm_id long, name string")
    firms = e.select(F.col("entity_id").alias("firm_id"), "name")
    assert sorted((r["event_id"], r["firm_id"], r["how"]) for r in S.match_events(events, firms).collect()) == [(1, 2, "id"), (2, 2, "name"), (3, None, None)]


def test_watchlist_files(spark, tmp_path):
    as_of = F.lit(date(2024, 5, 6))
    (tmp_path / "sdn.csv").write_text('1, ACME CORP ,-0-,SDGT,,,,,,,,"a.k.a. ""Acme Two""; nationality RUS"\n2,Bob,individual,\n')
    got = {r["entity_id"]: r for r in watchlists.ofac_entities(watchlists.ofac(spark, str(tmp_path / "sdn.csv")), 1, as_of).collect()}
    assert (got["1"]["primary_name"], got["1"]["entity_type"], got["1"]["nationality"]) == ("ACME CORP", "entity", ["RUS"])
    assert (got["2"]["entity_type"], got["2"]["program"], got["2"]["name_variants"], got["2"]["added_date"]) == ("individual", "UNKNOWN", [], date(2024, 5, 6))
    (tmp_path / "un.xml").write_text(
        "<CONSOLIDATED_LIST><INDIVIDUALS><INDIVIDUAL><DATAID>7</DATAID><FIRST_NAME>Ann</FIRST_NAME><THIRD_NAME>Lee</THIRD_NAME><UN_LIST_TYPE>X</UN_LIST_TYPE><LISTED_ON>2001-02-03</LISTED_ON>"
        "<INDIVIDUAL_ALIAS><ALIAS_NAME>A. Lee</ALIAS_NAME></INDIVIDUAL_ALIAS><INDIVIDUAL_ALIAS><ALIAS_NAME></ALIAS_NAME></INDIVIDUAL_ALIAS><NATIONALITY><VALUE>FR</VALUE></NATIONALITY></INDIVIDUAL></INDIVIDUALS>"
        "<ENTITIES><ENTITY><DATAID>8</DATAID><REFERENCE_NUMBER>R8</REFERENCE_NUMBER><FIRST_NAME>Body</FIRST_NAME><LISTED_ON>soon</LISTED_ON></ENTITY></ENTITIES></CONSOLIDATED_LIST>"
    )
    at = str(tmp_path / "un.xml")
    got = {r["entity_id"]: r for r in watchlists.un_entities(watchlists.un_people(spark, at), watchlists.un_bodies(spark, at), 2, as_of).collect()}
    assert (got["7"]["primary_name"], got["7"]["name_variants"], got["7"]["nationality"], got["7"]["added_date"]) == ("Ann Lee", ["A. Lee"], ["FR"], date(2001, 2, 3))
    assert (got["R8"]["entity_type"], got["R8"]["program"], got["R8"]["added_date"]) == ("entity", "UNKNOWN", date(2024, 5, 6))
    assert [r["name"] for r in watchlists.xml_names(spark, at).orderBy("pos").collect()] == ["Ann", "Lee", "A. Lee", "Body"]
    (tmp_path / "names.csv").write_text('id,name\n1,"Bob"\nAlone\n3,\n')
    assert [r["name"] for r in watchlists.csv_names(spark, str(tmp_path / "names.csv")).orderBy("pos").collect()] == ["Bob", "Alone"]


def test_feeds_seeds_and_overrides(spark, tmp_path):
    (tmp_path / "a.rss").write_text("<rss><channel><item><title>Firm suspended</title><link>http://x</link><pubDate>Mon, 06 May 2024 10:00:00 GMT</pubDate></item><item><title> </title></item><item><title>Fine of 3m</title><pubDate>soon</pubDate></item></channel></rss>")
    rows = watchlists.regulatory_events(watchlists.rss_items(spark, str(tmp_path / "a.rss"), F.lit(datetime(2024, 1, 1)).cast("timestamp")), "fca").collect()
    assert {(r["title"], r["event_type"], r["severity"], r["impact"], r["date"].isoformat()) for r in rows} == {("Firm suspended", "suspension", "critical", -0.8, "2024-05-06T10:00:00"), ("Fine of 3m", "settlement", "high", -0.5, "2024-01-01T00:00:00")}
    assert all(r["event_id"].startswith("FCA-") and len(r["event_id"]) == 16 for r in rows)
    (tmp_path / "seed.json").write_text('[{"brand_name": "A", "website_root": "a.com"}, {"brand_name": " ", "website_root": "b"}, {"brand_name": "C"}, {"brand_name": "D", "website_root": "d", "status": "candidate"}]')
    assert sorted((r["brand_name"], r["status"]) for r in watchlists.seed(spark, str(tmp_path / "seed.json")).collect()) == [("A", "watchlist"), ("D", "candidate")]
    (tmp_path / "m.json").write_text('{"_note": {"x": 1}, "Acme": {"headquarters": "Bern"}}')
    (tmp_path / "o.json").write_text('{"acme": {"headquarters": "Rome", "founded": "1999"}, "b": {"k": "v"}}')
    got = {r["firm_id"]: r["fields"] for r in watchlists.overrides(spark, str(tmp_path / "m.json"), str(tmp_path / "o.json")).collect()}
    assert got == {"acme": {"headquarters": "Bern", "founded": "1999"}, "b": {"k": "v"}}
    (tmp_path / "latest.json").write_text('{"snapshot_key": "s9", "sha256": "x"}')
    assert watchlists.latest_snapshot(spark, str(tmp_path / "latest.json")) == "s9"
    r = spark.range(1).select(watchlists.object_parts(F.lit("s3://raw/a/b.html")).alias("p"), readers.robots_sitemaps(F.lit("\n".join(f"Sitemap: http://s/{i}" for i in range(12)))).alias("r"), watchlists.needs_update(F.lit(None).cast("timestamp"), F.lit(datetime(2024, 1, 1))).alias("n")).first()
    assert tuple(r["p"]) == ("raw", "a/b.html") and len(r["r"]) == 12 and r["n"]


def test_pages(spark):
    html = '<nav><a href="/rules?x=1">Our <b>Rules</b></a></nav><div>payout <a href="/pay">go</a> <a href="https://else.com/rules">x</a><a href="/login-rules">y</a><a href="#rules">z</a></div><h2>Trading rules</h2><p>First &amp; only</p><script>no</script><h3>Other</h3><p>skip</p>'
    d = spark.createDataFrame([(1, "https://acme.com/", html), (2, None, None), (3, "https://b.c", "")], "id long, url string, html string")
    got = [tuple(r) for r in K.keyword_links(d, "id", "url", "html", ["rules", "payout"]).orderBy("rank").collect()]
    assert got == [(1, "https://acme.com/rules?x=1", 12, 1), (1, "https://acme.com/pay", 2, 2)]
    assert [tuple(r) for r in K.heading_blocks(d, "id", "html", ["rules"]).collect()] == [(1, "Trading rules First & only")]


def test_joined_addresses(spark):
    from urllib.parse import urljoin

    from firmscope.functions import pages as P

    bases = ["https://a.com", "https://a.com/", "https://a.com/x/y?q=1#f", "http://u@b.org:8080/d/e/f.html", "https://a.com/x/"]
    links = ["", "?p=2", "#z", "k", "k/l?m=1", "/r", "//c.net/p", "ftp://h/i", "mailto:x@y", "../up", "./here", "a/./b/../c", "../../../top", "..", ".", "k#f"]
    d = spark.createDataFrame([(b, h) for b in bases for h in links], "b string, h string")
    bad = [(r["b"], r["h"], r["j"]) for r in d.withColumn("j", P.joined_address(F.col("b"), F.col("h"))).collect() if r["j"] != urljoin(r["b"], r["h"])]
    assert not bad


def test_gate_modes(spark):
    s = spark.createDataFrame([(1, 0.5, "low"), (2, 0.1, "high"), (3, 0.4, "high"), (4, None, None)], "firm_id long, na_rate double, confidence string")
    d = spark.createDataFrame([(1, "crawl_error", None), (1, "http_error", None), (1, "rules_extracted_v0", '{"error": "x"}'), (2, "discovered_links", "[]"), (3, "rules_extracted_v0", '{"error": ""}'), (4, "other", None)], "firm_id long, key string, value_json string")
    verdicts = {m: {r["firm_id"]: (r["verdict"], r["reasons"]) for r in C.gate(s, d, m).collect()} for m in ("soft", "relaxed", "strict")}
    reasons = {1: ["low_confidence", "na_rate_too_high_0.50", "crawl_error", "extraction_error"], 2: [], 3: [], 4: ["missing_key_data"]}
    assert verdicts["soft"] == {k: ("pass", []) for k in reasons}
    assert verdicts["relaxed"] == {k: ("review" if k == 1 else "pass", v) for k, v in reasons.items()}
    assert verdicts["strict"] == {k: ("review" if v else "pass", v) for k, v in reasons.items()}


def test_hand_cases(spark):
    one = lambda **c: spark.range(1).select(*(v.alias(k) for k, v in c.items())).first().asDict()
    lit = F.lit
    assert one(a=E.payout_frequency(lit("Withdrawals are paid every 14 days")), b=E.payout_frequency(lit("payout quarterly")), c=E.payout_frequency(lit("paid weekly")), d=E.delay_days(lit("mobile wallets, paid weekly"))) == {"a": "biweekly", "b": "quarterly", "c": None, "d": 7}
    assert one(a=L.domain(lit(-3), lit(False), lit(True))) == {"a": (True, 0.98, -1.1)}
    assert one(a=L.review_surge(lit(0.25)), b=L.submission_impact(lit("low"), lit("payout_problem"))) == {"a": (True, 0.85, -0.35), "b": pytest.approx(0.12)}
    assert one(a=A.days_since(lit(datetime(2024, 1, 2, 1)), lit(datetime(2024, 1, 1, 2))), b=A.days_since(lit(datetime(2024, 1, 1)), lit(datetime(2024, 1, 1, 1)))) == {"a": 0, "b": -1}


def test_sinks(spark, tmp_path):
    df = spark.range(20).withColumn("p", F.col("id") % 2)
    at = writers.snapshot(df, str(tmp_path / "s"), "v1")
    (tmp_path / "s" / at.rsplit("/", 1)[1] / "_SUCCESS").unlink()
    for f in (tmp_path / "s" / at.rsplit("/", 1)[1]).glob("*.parquet"):
        f.unlink()
    assert writers.snapshot(df, str(tmp_path / "s"), "v1") == at and spark.read.parquet(at).count() == 20
    writers.append(df, str(tmp_path / "t"))
    writers.append(df, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 40 and writers.next_id(df, "id") == 20 and writers.next_id(df.limit(0), "id") == 1
    assert writers.single_active(df, "id", 3).filter("is_active").count() == 1
    assert writers.updated(df, F.col("id") > 17, {"p": 9}).filter("p = 9").count() == 2
    old = spark.createDataFrame([(datetime(2020, 1, 1),), (datetime(2024, 1, 1),)], "ts timestamp")
    assert writers.retained(old, "ts", "2024-06-01", 365).count() == 1


def test_running_counts_stay_parted(spark):
    """No task sorts all distinct values: windows go by range, only the ranges' totals meet."""
    df = spark.range(5000).select((F.xxhash64("id") / 1e15).alias("v"))
    out = R.nth_smallest(df, "v", F.floor(F.col("n") * 0.95))
    assert out.first()["v"] == sorted(r["v"] for r in df.collect())[4750]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__g" in plan
    assert R.nth_smallest(df.limit(0), "v", F.lit(0)).first()["v"] is None


def test_report(spark):
    d = spark.createDataFrame([(1.5, True)], "score double, passed boolean")
    assert A.markdown(A.report(b=d, a=d.select("score"))) == "# Validation report\n\n## a\n\n- score: 1.5\n\n## b\n\n- passed: true\n- score: 1.5\n"
