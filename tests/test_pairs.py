"""Pairs of rows within keys, ties of alerts and the like, on small tables."""

from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from firmscope.operators import links as K
from firmscope.operators import names as N
from firmscope.operators import validation as A
from firmscope.plans import domain_queries, text_queries  # noqa: F401
from firmscope.plans.registry import QUERIES


def test_a_cut_among_equal_alerts_takes_the_least_ids(spark):
    at = datetime(2001, 8, 1)
    log = spark.createDataFrame([(k, "1-URGENT", at, None) for k in range(400, 0, -1)], "id long, alert_type string, created_at timestamp, resolved_at timestamp").repartition(7)
    assert [r["id"] for r in A.recent_alerts(log, 10).collect()] == list(range(1, 11))


@pytest.mark.parametrize("name", ["trigram_similarity", "watchlist_spec_score", "string_similarity"])
def test_few_bytes_of_pairs_stay_many_tasks(spark, sf, name):
    assert QUERIES[name](spark, sf).rdd.getNumPartitions() == 8


@pytest.mark.parametrize("name", ["watchlist_spec_score", "string_similarity"])
def test_scores_are_looked_up_by_one_number(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [__ab#" in plan


@pytest.mark.parametrize("few", [500, 1])
def test_pairs_are_those_of_equal_keys(spark, monkeypatch, few):
    monkeypatch.setattr(N, "FEW_NAMES", few)
    rows = [(i, ["red", "red ring", None, "bolt"][i % 4], i % 3 if i % 7 else None, "x") for i in range(60)]
    d = spark.createDataFrame(rows, "id long, name string, k int, l string")
    got = sorted(tuple(r) for r in N.scored_pairs(d, "id", "name", ["k", "l"], n=F.length("a") - F.length("b")).collect())
    want = [(i, j, None if None in (a, b) else len(a) - len(b)) for i, a, k, _ in rows for j, b, m, _ in rows if i < j and k == m and k is not None]
    assert got == sorted(want)


def test_few_keys_with_many_pairs_stay_many_tasks(spark):
    d = spark.createDataFrame([(i % 3, i) for i in range(60)], "k int, v int")
    met = N.dealt(d, d.withColumnRenamed("v", "w"), ["k"], None)
    assert met.rdd.getNumPartitions() == 8 and met.count() == 1200


def test_stability_reads_each_snapshot_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        read.add(1)
        return x

    d = spark.createDataFrame([(f"f{i}", float(i)) for i in range(30)], "firm_id string, score double")
    row = A.record_stability(d.withColumn("score", seen("score")), d).first()
    assert row["firms"] == 30 and row["max_score_change"] == 0 and read.value == 30


def test_rows_of_some_pages_leave_before_the_next_are_parsed(spark, monkeypatch):
    run = []
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda d, f, schema: run.append(f) or d, raising=False)
    monkeypatch.setattr(DataFrame, "mapInPandas", lambda d, f, schema: run.append(f) or d, raising=False)
    d = spark.createDataFrame([], "id long, html string")
    K.heading_blocks(d, "id", "html", ["rules"]), K.page_anchors(d, "id", "html")
    n = 1000
    whole = pa.RecordBatch.from_pydict({"id": list(range(n)), "html": ["<h1>rules</h1>x<a href='/a'>go</a>"] * n})
    for f in run:
        parts = [len(b) for b in f(iter([whole]))]
        assert sum(parts) == n and max(parts) <= 100
