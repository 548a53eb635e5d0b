"""Folds over logs against plain Python, versions of records, publishing that dies midway, and alerts of a stream."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from firmscope.operators import history as H
from firmscope.operators import logs as G
from firmscope.sources import publishing as B
from firmscope.streaming import monitor as M

START = datetime(2024, 1, 1)
at = lambda s: START + timedelta(seconds=s)


def samples(spark, seed=1, n=400):
    r = random.Random(seed)
    rows = [(i, r.choice(["a", "a", "a", "b", None]), at(r.randint(0, 40_000)), r.choice([None, float(r.randint(0, 50))])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, k string, ts timestamp, v double")


@pytest.mark.parametrize("block", [7, 50, 20_000])
def test_rolling_nth(spark, block):
    rows, d = samples(spark)
    got = {(r["id"], r["n"], r["nth"]) for r in G.rolling_nth(d, "k", "id", "v", F.col("ts"), last=20, block=block, span=900).collect()}
    want = set()
    for k in ("a", "b", None):
        own = sorted((x for x in rows if x[1] == k and x[3] is not None), key=lambda x: (x[2], x[0]))
        for i, x in enumerate(own):
            last = sorted(y[3] for y in own[max(0, i - 19) : i + 1])
            want.add((x[0], len(last), last[int(len(last) * 0.95)]))
    assert got == want
    assert G.rolling_nth(d.limit(0), "k", "id", "v", F.col("ts")).collect() == []


def test_cache_replay(spark):
    rows, d = samples(spark, 2)
    got = {r["id"]: r["hit"] for r in G.cache_replay(d, "k", "id", F.col("ts"), 600).collect()}
    want, until = {}, {}
    for i, k, ts, _ in sorted(rows, key=lambda x: (x[2], x[0])):
        want[i] = k in until and ts < until[k]
        if not want[i]:
            until[k] = ts + timedelta(seconds=600)
    assert got == want
    assert tuple(G.hit_rate(G.cache_replay(d.limit(0), "k", "id", F.col("ts"), 600)).first()) == (0, 0, 0.0)


def test_rates_and_quantiles(spark):
    d = spark.createDataFrame([("a", at(0), 5.0), ("a", at(100), 8.0), ("a", at(250), 2.0), ("a", at(400), 2.0), ("b", at(0), 1.0)], "k string, ts timestamp, v double")
    got = {(r["k"], r["ts"]): r["rate"] * 300 for r in G.rates(d, "k", "ts", "v", 300).collect()}
    assert got == pytest.approx({("a", at(0)): 0, ("a", at(100)): 3, ("a", at(250)): 5, ("a", at(400)): 2, ("b", at(0)): 0})
    inf = float("inf")
    rows = [("x", 1.0, 2), ("x", 2.0, 4), ("x", inf, 10), ("y", 1.0, 10), ("y", inf, 10), ("z", 1.0, 0), ("z", inf, 0), ("w", 1.0, 3), ("v", 1.0, 0), ("v", 5.0, 8), ("v", inf, 8)]
    h = spark.createDataFrame(rows, "s string, le double, n long")
    assert {r["s"]: r["quantile"] for r in G.histogram_quantile(h, ["s"], "le", "n", 0.25).collect()} == {"x": 1.25, "y": 0.25, "z": None, "w": None, "v": 2.0}
    assert {r["s"]: r["quantile"] for r in G.histogram_quantile(h, ["s"], "le", "n", 0.9).collect()}["x"] == 2.0  # in the last bucket


SERIES = [("a", 0, 1), ("a", 100, 9), ("a", 200, 9), ("a", 399, 9), ("a", 400, 9), ("a", 500, 1), ("a", 600, 9), ("a", 700, None), ("b", 0, 9), ("b", 299, 9), ("c", 0, 9), ("c", 1000, 9), ("c", 2000, 9), ("c", 2100, 2), ("c", 2200, 9), ("c", 2500, 9), ("c", 2500, 3)]
ALERTS = {("a", at(100), at(400)), ("c", at(0), at(1000))}


def test_sustained(spark):
    d = spark.createDataFrame([(s, at(t), v) for s, t, v in SERIES], "s string, ts timestamp, v int")
    got = {tuple(r) for r in G.sustained(d, "s", "ts", F.col("v") > 5, 300).collect()}
    assert got == {("a", at(100), at(400), at(500)), ("c", at(0), at(1000), at(2100))}


def test_stream_gives_the_same_alerts(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    kind = "s string, ts timestamp, v int"
    spark.createDataFrame([], kind).write.parquet(str(src))
    later = sorted(SERIES, key=lambda x: x[1])
    for part in (later[:6], later[6:11], later[11:]):  # the state of a series outlives a run
        spark.createDataFrame([(s, at(t), v) for s, t, v in part], kind).write.mode("append").parquet(str(src))
        stream = spark.readStream.schema(kind).parquet(str(src))
        M.run_available(M.sustained_alerts(stream, "s", "ts", F.col("v") > 5, 300), out, str(tmp_path / "state")).awaitTermination()
    assert {tuple(r) for r in spark.read.parquet(out).collect()} == ALERTS


def test_versions(spark):
    load = lambda *rows: spark.createDataFrame(list(rows), "id string, a string, b long")
    step = lambda h, l, t: H.versions(h, l, "id", ["a", "b"], F.lit(t).cast("long"))
    rows = lambda h: sorted(((r["id"], r["a"], r["b"], r["valid_from"], r["valid_to"]) for r in h.collect()), key=str)
    one = step(None, load(("x", "p", 1), ("y", None, 2), (None, "n", 0)), 1)
    assert rows(step(one, load(("x", "p", 1), ("y", None, 2), (None, "n", 0)), 2)) == rows(one)
    two = step(one, load(("x", "p", None), ("z", "q", 3), (None, "n", 0)), 2)
    assert rows(two) == sorted([("x", "p", 1, 1, 2), ("x", "p", None, 2, None), ("y", None, 2, 1, 2), ("z", "q", 3, 2, None), (None, "n", 0, 1, None)], key=str)
    three = step(two, load(("y", None, 2), ("x", "p", None)), 5)
    assert [r["id"] for r in H.as_of(three, F.lit(5)).orderBy("id").collect()] == ["x", "y"] and len(rows(H.as_of(three, F.lit(1)))) == 3
    assert rows(step(three, load(), 6)) and step(three, load(), 6).filter("valid_to IS NULL").count() == 0


def test_captured_and_recorded(spark):
    d = spark.createDataFrame([("a", "A", 0.0, 0.5), ("", "B", 1.0, None), ("c", "C", 88.0, 1.0), ("d", None, 5.0, None), ("e", "E", None, 0.0), ("f", "F", None, None)], "id string, name string, score double, integrity_score double")
    got = H.captured(d, "s", "h")
    assert {(r["firm_id"], r["score"], r["score_normalized"], r["confidence"], r["status"]) for r in got.collect()} == {("a", 0.5, 0.5, "medium", "candidate"), ("c", 88.0, 0.88, "medium", "candidate"), ("e", 0.0, 0.0, "medium", "candidate")}
    table, counts = H.recorded(got.filter("firm_id <> 'e'"), got.withColumn("status", F.lit("x")), ["firm_id", "snapshot_id"])
    assert table.filter("status = 'x'").count() == 3 == table.count() and tuple(counts.first()) == (1, 2)


def test_publishing(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        B.published(spark, root)
    a = B.publish(spark.range(10), root, "t1")
    pinned = B.published(spark, root)
    assert (a["version"], a["rows"]) == (1, 10) and B.publish(spark.range(10).repartition(3), root, "t2") == {**a, "updated_at": "t2"}

    def dies(*_):
        raise OSError("the pointer's write died")

    with monkeypatch.context() as m:
        m.setattr(B, "_swap", dies)
        with pytest.raises(OSError):
            B.publish(spark.range(20), root, "t3")
    with pytest.raises(Exception, match="boom"):
        B.publish(spark.range(30).select(F.when(F.col("id") == 29, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id")), root, "t4")
    assert B.pointer(spark, root)["updated_at"] == "t2" and B.published(spark, root).count() == 10
    assert B.publish(spark.range(20), root, "t5")["version"] == 2
    assert pinned.count() == 10 and B.published(spark, root).count() == 20
