"""Search of similar names against all pairs, and verification on hand cases."""

import random

import pytest
from pyspark.sql import functions as F
from test_domain import names

from firmscope.functions import text as X
from firmscope.operators import names as N
from firmscope.operators import screening as S
from firmscope.operators import verification as Y


def odd(seed, n):
    """Names with repeated runs and tokens, one token, many tokens, and none."""
    r = random.Random(seed)
    parts = ["ana", "banana", "an", "na", "bananas", "limited", "limite", "gold", "golden", "x"]
    out = [" ".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(n)]
    long = [" ".join(r.choice("abcdefgh") + str(i) for i in range(13 + k)) for k in range(3)]
    return sorted({*out, *names(seed, n), *long, *(x[:-1] + "z" for x in long), "...", "z" * 9, "ab"})


@pytest.fixture(scope="module")
def lists(spark):
    a, b = odd(3, 60), odd(4, 60)
    make = lambda x: N.Names(spark.createDataFrame([(v,) for v in x], "name string"))
    q, e = make(a), make(b)
    every = q.table.select(F.col("name").alias("a")).join(e.table.select(F.col("name").alias("b")), F.lit(True))  # small lists
    scores = {(r["a"], r["b"]): r["s"] for r in every.withColumn("s", F.round(X.similarity(F.col("a"), F.col("b")), 6)).collect()}
    return a, b, q, e, N.partners(q, e), scores


@pytest.mark.parametrize("threshold", [0.6, 0.7, 0.85])
def test_all_pairs_are_found(lists, threshold, monkeypatch):
    a, b, q, e, near, scores = lists
    monkeypatch.setattr(N, "DEALT", 7)  # common keys are dealt
    found = N.matches(q, e, near, threshold).join(q.table.select("id", F.col("name").alias("a")), "id").join(e.table.select(F.col("id").alias("e_id"), F.col("name").alias("b")), "e_id")
    got = [(r["a"], r["b"], r["score"]) for r in found.collect()]
    assert sorted(got) == sorted((*k, s) for k, s in scores.items() if s >= threshold) and len(got) > 30


def test_best(spark, lists):
    a, b, _, _, _, scores = lists
    rows = N.best(spark.createDataFrame([(x,) for x in a], "name string"), spark.createDataFrame([(x, i) for i, x in enumerate(b)], "name string, first long")).collect()
    want = {}
    for x in a:
        s, j = min((-scores[x, y], j) for j, y in enumerate(b))
        if -s >= 0.6:
            want[x] = (j, -s)
    assert {r["name"]: (r["first"], r["score"]) for r in rows} == want


def test_common_keys_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(N, "DEALT", 5)
    asked = spark.range(20).select((F.col("id") % 3).alias("k"), F.col("id").alias("a"))
    index = spark.range(100).select(F.when(F.col("id") < 70, 0).otherwise(F.col("id") % 4).alias("k"), F.col("id").alias("b"))
    key = lambda r: (r["k"], r["a"], r["b"])
    assert sorted(map(key, N.dealt(asked, index, ["k"], 100).collect())) == sorted(map(key, asked.join(index, "k").collect()))
    assert N.dealt(asked, index.limit(0), ["k"], None).collect() == []


PERMISSION = "array<struct<activity:string,label:string,authorized:boolean,since:timestamp>>"
ACTION = "array<struct<date:timestamp,type:string,amount:double,description:string,status:string>>"


def registry(spark):
    deals = [("deal", "Deal", True, None), ("advise", "Advise", False, None), ("arrange", "Arrange", None, None), ("hold", "Hold", True, None)]
    rows = [
        (7, "FTMO Limited", "authorized", None, deals, [(None, "fine", 1.0, "", "active"), (None, "fine", 1.0, "", "closed"), (None, "fine", 1.0, "", None)]),
        (5, "ftmo limited ", "authorized", None, None, None), (3, "Brackwell Capital", "suspended", None, [], []), (9, "Old Futures Group", "revoked", None, deals[:1], []), (11, None, "authorized", None, [], []), (12, "", "authorized", None, [], []),
    ]
    return spark.createDataFrame(rows, f"firm_id long, name string, authorization_status string, authorization_date timestamp, permissions {PERMISSION}, enforcement_actions {ACTION}")


def test_verified(spark):
    firms = spark.createDataFrame([(1, "FTMO LIMITED"), (2, "Brackwel Capital"), (3, "Old Futures Grp"), (4, "Nobody At All"), (5, ""), (6, None), (7, "FTMO LIMITED")], "firm_id long, name string")
    got = {r["firm_id"]: r for r in Y.verified(firms, registry(spark)).collect()}
    assert {k: r["status"] for k, r in got.items()} == {1: "CONFIRMED", 2: "SUSPENDED", 3: "REJECTED", 4: "REJECTED", 5: "REJECTED", 6: "REJECTED", 7: "CONFIRMED"}
    assert (got[1]["registry_id"], got[1]["permissions"], got[1]["enforcement_actions"], got[1]["confidence"], got[1]["error"]) == (5, [], 0, 1.0, None)  # of equal names the least id
    assert got[4]["error"] == Y.NO_MATCH and got[4]["confidence"] == 0 and got[3]["permissions"] == ["deal"] and got[3]["error"] is None
    only = registry(spark).select("firm_id", Y.authorized_permissions(F.col("permissions")).alias("p"), Y.active_actions(F.col("enforcement_actions")).alias("n")).collect()
    assert {r["firm_id"]: (r["p"], r["n"]) for r in only} == {7: (["deal", "hold"], 1), 5: ([], 0), 3: ([], 0), 9: (["deal"], 0), 11: ([], 0), 12: ([], 0)}
    assert Y.verified(firms, registry(spark).limit(0)).filter("status = 'REJECTED'").count() == 7 and Y.verified(firms.limit(0), registry(spark)).collect() == []


def test_combined(spark):
    firms = spark.createDataFrame([(1, "FTMO LIMITED"), (2, "Brackwel Capital"), (4, "Nobody At All"), (5, "Old Futures Grp"), (6, "Evil Empire Holdings"), (7, "Old Futurs")], "firm_id long, name string")
    listed = spark.createDataFrame([(1, "Evil Empire Holdings", []), (2, "Nobody At Al", [])], "entity_id long, name string, aliases array<string>")
    got = {r["firm_id"]: (r["status"], r["risk"], r["risk_factors"]) for r in Y.combined(firms, registry(spark), listed).collect()}
    assert got[1] == ("CLEAR", "LOW", []) and got[2] == ("SUSPENDED", "HIGH", ["FCA authorization suspended"])
    assert got[4][:2] == ("SANCTIONED", "HIGH") and got[4][2] == ["Not found in FCA registry", "Entity or related entity on OFAC/UN sanctions list", "1 sanctions match(es)"]
    assert got[5] == ("CLEAR", "LOW", ["FCA authorization revoked"]) and got[6][0] == "SANCTIONED"
    assert got[7] == ("CLEAR", "MEDIUM", ["FCA authorization revoked", "Low FCA match confidence (62%)"])


def test_blank_names_meet_nothing(spark):
    q = spark.createDataFrame([(1, ""), (2, None), (3, "acme")], "query_id long, name string")
    e = spark.createDataFrame([(1, " ", [""]), (2, "acme", ["", None]), (3, None, None)], "entity_id long, name string, aliases array<string>")
    assert [(r["query_id"], r["entity_id"]) for r in S.cascade(q, e).collect()] == [(3, 2)]


def test_names_whose_tokens_must_all_be_met_ask_for_few_keys(spark, monkeypatch):
    words = [f"acme trading ab{a}{b}e" for a in "0123456789cdf" for b in "0123456789cdf"]  # each last token has 24 partners
    asked = []
    dealt = N.dealt
    monkeypatch.setattr(N, "dealt", lambda q, e, key, total: asked.append((key, q)) or dealt(q, e, key, total))
    make = lambda x: N.Names(spark.createDataFrame([(v,) for v in x], "name string"), 0.85)
    q, e = make(words), make(words)
    near = N.partners(q, e)
    asked.clear()
    found = N.matches(q, e, near, 0.85)
    assert found.count() == len(words) * 25
    assert all(d.count() <= 6 * len(words) for key, d in asked)


def test_thresholds_that_need_no_runs_keep_none(spark):
    d = spark.createDataFrame([("acme trading abcde",)], "name string")
    assert "runs" not in N.Names(d, 0.85).table.columns and "runs" in N.Names(d, 0.6).table.columns
