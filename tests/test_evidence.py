"""The ordered fold over evidence, merged parts, winners by source, and payloads, against plain Python."""

import hashlib
import json
import random

from pyspark.sql import functions as F

from firmscope.functions import payload as J
from firmscope.operators import extraction as O

KIND = "evidence_id long, firm_id string, key string, source_url string, sha256 string, created_at long, raw string"
FILLER = "plain words without anything to find in them, " * 12
RULES, PRICING = "payout weekly. max drawdown 10%. " + FILLER, "withdrawals monthly; profit split 80%. " + FILLER


def fold(spark, rows):
    parsed = []
    e = spark.createDataFrame(rows, KIND)
    got = O.first_hits(e, blocks=False, parsed=parsed)
    return e, got, parsed


def test_reading_stops_once_both_are_found(spark):
    rows = [(i, "a", "rules_html", "u", "h", 100 - i, FILLER) for i in range(200)]  # newest first: 0, 1, 2, ...
    rows[2] = (2, "a", "rules_html", "u", "h2", 98, RULES)
    rows[4] = (4, "a", "external_html", "u", "h4", 96, PRICING)
    rows += [(300, "b", "rules_html", "u", "h", 5, "payout weekly"), (301, "b", "xhr_json", "u", "h", 4, '{"x": "' + RULES + '"}'), (302, "b", "other", "u", "h", 9, RULES), (303, "c", "pricing_html", "u", "h", 1, None), (304, "d", "rules_pdf", None, None, None, FILLER)]
    e, got, parsed = fold(spark, rows)
    have = sorted((r["firm_id"], r["target"], r["place"], r["evidence_id"], r["max_drawdown"], r["payout_split_pct"]) for r in got.collect())
    assert have == [
        ("a", "pricing", 5, 4, None, 80.0), ("a", "rules", 1, 0, None, None), ("a", "rules", 2, 1, None, None), ("a", "rules", 3, 2, 10.0, None),
        ("b", "pricing", 2, 301, None, None), ("b", "rules", 2, 301, 10.0, None), ("d", "rules", 1, 304, None, None),
    ]
    assert parsed == [3, 3, 4]  # places 1, 2 to 3, 4 to 7: of 200 texts of the first firm 7 are read
    runs = {r["firm_id"]: (r["processed"], r["rules"], r["pricing"]) for r in O.runs(e, got).collect()}
    assert runs == {"a": (5, 1, 1), "b": (2, 1, 1), "d": (1, 0, 0)}


def test_no_evidence(spark):
    e = spark.createDataFrame([], KIND)
    assert O.first_hits(e).collect() == [] and O.runs(e, O.first_hits(e, blocks=False)).collect() == []


def test_blocks_and_kinds(spark):
    page = "<h2>Our Payout Rules</h2><p>payouts are weekly</p><h2>Other</h2><p>max drawdown 3%</p>" + "<h3>Profit split and fees</h3><p>profit split 75%</p>"
    e = spark.createDataFrame([(1, "a", "external_html", "https://x/rules", "", 1, page), (2, "a", "external_html", "https://x/fees", "", 1, page), (3, "a", "rules_html", "", "", 1, page), (4, "a", "pricing_html", None, "", 1, "<p>no heading</p>"), (5, "a", "xhr_json", "", "", 1, '{"b": "é",\n"a": [1, null]}'), (6, "a", "xhr_json", "", "", 1, "{")], KIND)
    got = {r["evidence_id"]: r["text"] for r in O.texts(e).collect()}
    assert got == {1: "Our Payout Rules payouts are weekly", 2: "Profit split and fees profit split 75%", 3: "Our Payout Rules payouts are weekly", 4: "no heading", 5: '{"b": "\\u00e9", "a": [1, null]}', 6: ""}


def test_merged_parts(spark):
    r = random.Random(4)
    rows = [(r.choice(["a", "b", None]), k, r.choice([None, "", "x", "y"]), r.choice([None, 0.0, 1.5]), r.choice([None, [], ["p", None, "q"], ["q", "r", "q"], ["s"]])) for k in range(60)]
    rows += [("only", 99, None, None, None)]
    got = {x["doc"]: (x["s"], x["n"], x["many"], x["parts"]) for x in O.merged_parts(spark.createDataFrame(rows, "doc string, at long, s string, n double, many array<string>"), ["doc"], "at", ["s", "n"], ["many"]).collect() if x["doc"]}
    want = {}
    for doc in ("a", "b", "only"):
        own = [x for x in rows if x[0] == doc]
        items = [i for x in own for i in (x[4] or []) if i is not None]
        want[doc] = (next((x[2] for x in own if x[2]), None), next((x[3] for x in own if x[3] is not None), None), list(dict.fromkeys(items)), len(own))
    assert got == want


def test_winners_and_second_run(spark):
    rows = [("a", "pdf", 1, None, "Rome"), ("a", "html", 2, 1999, ""), ("a", "html", 3, 2001, None), ("a", "zzz", 0, 1, "Paris"), ("b", "llm", 1, None, " "), ("c", "x", 1, None, "")]
    d = spark.createDataFrame(rows, "firm_id string, source string, place long, year int, seat string")
    won = O.field_winners(d, "firm_id", ["year", "seat"], "source", {"html": 5, "pdf": 4, "llm": 2}, "place")
    got = {r["firm_id"]: (r["year"], r["seat"], r["sources"]) for r in won.collect()}
    assert got == {"a": (1999, "Rome", {"year": "html", "seat": "pdf"}), "b": (None, " ", {"seat": "llm"})}
    old = spark.createDataFrame([("a", None, "Oslo"), ("b", 7, "")], "firm_id string, year int, seat string")
    new = spark.createDataFrame([("a", 1999, "Rome"), ("b", 8, ""), ("c", 3, None)], "firm_id string, year int, seat string")
    first = O.filled(old, new, "firm_id", ["year", "seat"])
    assert {tuple(r) for r in first.collect()} == {("a", 1999, "Oslo", "update"), ("c", 3, None, "insert")}
    after = old.join(first, "firm_id", "left_anti").unionByName(first.drop("action"))
    assert O.filled(after, new, "firm_id", ["year", "seat"]).collect() == []


def test_payloads(spark):
    values = [{"b": [1, {"z": 1.5, "a": "é\n"}], "a": None}, [], "x", 0, True, None, {"deep": [[[[["t", 7, False, "", None]]]]], "_audit": "no", "n": 1e300}]
    raw = [json.dumps(v, ensure_ascii=False, indent=1) for v in values] + ["{", "", None, "[" * 3000 + "]" * 3000]
    d = spark.createDataFrame(list(enumerate(raw)), "id long, p string")
    got = d.select("id", J.payload_hash(F.col("p")).alias("h"), J.json_text(F.col("p"), 20).alias("t"), J.nested_text(F.col("p")).alias("n")).collect()
    for r, v in zip(sorted(got)[:5], values, strict=False):
        assert r["h"] == hashlib.sha256(json.dumps(v, sort_keys=True).encode()).hexdigest() and r["t"] == json.dumps(v)[:20]
    by = {r["id"]: r for r in got}
    assert by[0]["n"] == "1 1.5 é" and by[6]["n"] == "t 7 False 1e+300" and by[7]["h"] is None and by[7]["t"] == "" and by[9]["n"] is None and by[3]["n"] == "0"


def test_schema(spark):
    raw = ['{"a":[" x ",1,null,true],"n":"2.5","b":false,"s":" t "}', '{"a":"x","n":{},"b":1,"s":3}', "[1]", "nope" * 300, None, '{"n":true,"zzz":1}']
    s = J.by_schema(F.col("p"), {"a": "list", "n": "number", "b": "boolean", "s": "string"})
    got = [tuple(r["x"]) for r in spark.createDataFrame(list(enumerate(raw)), "id long, p string").select("id", s.alias("x")).orderBy("id").collect()]
    assert got == [(None, None, ["x", "1", "true"], 2.5, False, "t"), (None, None, [], None, None, None), ("invalid_json", "[1]", None, None, None, None), ("invalid_json", ("nope" * 300)[:500], None, None, None, None), ("invalid_json", None, None, None, None, None), (None, None, [], 1.0, None, None)]
