import numpy as np
import pytest
from pyspark.sql import functions as F

from firmscope.llm import ann, queries


def test_recall_and_scores(spark):
    at = "/root/testdata/sf0.1"
    df = spark.read.parquet(f"{at}/embeddings.parquet").toPandas()
    ids, x = df["vec_id"].to_numpy(), np.array(df["embedding"].tolist(), float)
    place = {v: i for i, v in enumerate(ids)}
    got = {}
    for r in queries.op5_nearest(spark, at).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {int(v) for v in ids if v % 50 == 0}
    found = 0
    for q, near in got.items():
        near.sort()
        assert [n[0] for n in near] == [1, 2, 3, 4, 5] and q not in [n[1] for n in near]
        for _, v, s in near:
            a, b = x[place[q]], x[place[v]]
            assert s == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)
        found += len({n[1] for n in near} & set(ann.brute_force(x, ids, x[place[q]], q)))
    assert found / (5 * len(got)) >= 0.9


def test_odd(spark):
    e = [1.0, 0.0, 0.0]
    rows = [(0, e), (1, e), (2, e), (3, e), (4, e), (5, e), (6, e), (6, e), (7, [0.0, 0.0, 0.0]), (8, None), (9, [1.0, None, 0.0]), (10, [float("nan"), 1.0, 0.0]), (None, e), (50, [0.5, 0.5, 0.0]), (51, [2.0]), (52, [float("inf"), 0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("leaf", F.lit(1)).withColumn("score", F.lit(0))
    got = [tuple(r) for r in ann.nearest(df, df.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect()]
    assert [g[:3] for g in got] == [(0, i + 1, i + 1) for i in range(5)] + [(50, i + 1, i) for i in range(5)]
    assert ann.nearest(df.limit(0), df.limit(0)).collect() == []
    one = df.filter("vec_id = 50")
    assert ann.nearest(one, one).collect() == []


def brute(rows, k=5):
    """(query, rank, id) by comparing all vectors of a length, for queries of ids divisible by 50; rows of the query's own id aside."""
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, u in ok:
        if q % 50 == 0:
            near = sorted((-round(float(u @ v / np.linalg.norm(u) / np.linalg.norm(v)), 12), i) for i, v in ok if i != q and len(v) == len(u))
            out += [(q, r + 1, i) for r, (_, i) in enumerate(near[:k])]
    return sorted(out)


def test_repeated_ids_and_lengths(spark):
    """Ids with several vectors, vectors with several ids, repeated rows and vectors of other lengths."""
    rng = np.random.RandomState(4)
    base = rng.normal(size=(6, 4))
    rows = [(50, (base[0] + 1e-3 * rng.normal(size=4)).tolist()) for _ in range(40)]
    rows += [(int(i), (base[i % 6] + 0.1 * rng.normal(size=4)).tolist()) for i in range(1, 40)]
    rows += [(100, base[1].tolist()), (100, base[1].tolist()), (150, base[1].tolist()), *[(7, base[1].tolist())] * 9, (8, base[1].tolist())]
    rows += [(200, [1.0, 2.0]), (201, [2.0, 1.0]), (202, [1.0]), (250, [3.0]), (300, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(df, df.filter("vec_id % 50 = 0")).collect())
    assert got == brute(rows)


def test_parts_and_large_leaves(spark, monkeypatch):
    """Several parts of queries, a leaf over several shards: the same rows as comparing all."""
    monkeypatch.setattr(ann, "TOGETHER", 3)
    monkeypatch.setattr(ann, "SHARD", 64)
    rng = np.random.RandomState(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 3)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in ann.nearest(df, df.filter("vec_id % 50 = 0"), sample=100).collect())
    assert got == brute(rows)
