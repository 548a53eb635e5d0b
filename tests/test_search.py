"""Stems by the published algorithm's examples; search against brute force; which files a search reads."""

import math
import random

from pyspark.sql import functions as F

from firmscope.functions import stems
from firmscope.operators import search as Q

# Words and stems of the published vocabulary.
STEMS = {
    "consigned": "consign", "consistency": "consist", "consolation": "consol", "knightly": "knight", "generously": "generous", "communication": "communic", "running": "run", "happily": "happili", "flies": "fli", "ties": "tie", "gas": "gas", "kiwis": "kiwi",
    "hopping": "hop", "hoping": "hope", "luxuriated": "luxuri", "agreed": "agre", "by": "by", "say": "say", "cry": "cri", "relational": "relat", "rationally": "ration", "hopefulness": "hope", "replacement": "replac", "electricity": "electr", "controlling": "control",
    "roll": "roll", "dying": "die", "news": "news", "youth": "youth", "formative": "format", "apology": "apolog", "possibly": "possibl", "triplicate": "triplic", "proceed": "proceed", "succeeding": "succeed", "sanctions": "sanction", "x1s": "x1s", "is": "is", "élan": "élan",
}


def test_stems():
    assert {w: stems.stem(w) for w in STEMS} == STEMS


def brute(rows, queries, top):
    words = {i: [(stems.stem(w), at) for at, w in enumerate(stems._word.findall((t or "").lower()), 1) if w not in stems._stops] for i, t in rows}
    near = lambda d: 1e-30 if d > 100 else 1 / (1.005 + 0.05 * math.exp(d / 1.5 - 2))
    out = set()
    for q, text in queries:
        asked = sorted({stems.stem(w) for w in stems._word.findall((text or "").lower()) if w not in stems._stops})
        found = []
        for i, ws in words.items():
            at = [[a for w, a in ws if w == x] for x in asked]
            if not asked or not all(at):
                continue
            if len(asked) == 1:
                r = sum(0.1 / k**2 for k in range(1, len(at[0]) + 1)) / 1.64493406685
            else:
                r = 1 - math.prod(1 - 0.1 * math.sqrt(near(abs(a - b))) for x in range(len(at)) for y in range(x + 1, len(at)) for a in at[x] for b in at[y])
            found.append((-round(r, 9), i))
        out |= {(q, i, -r, k) for k, (r, i) in enumerate(sorted(found)[:top], 1)}
    return out


def test_search_is_brute_force(spark, tmp_path):
    r = random.Random(3)
    vocabulary = ["sanction", "sanctions", "trading", "trades", "the", "of", "acme", "Acme", "limited", "funds", "É2", "x1"]
    rows = [(i, " ".join(r.choices(vocabulary, k=r.choice([0, 3, 8, 250])))) for i in range(120)] + [(500, None), (501, "unique Word")]
    queries = [(1, "sanctioned trade"), (2, "ACME"), (3, "the of"), (4, None), (5, "missing acme"), (6, "fund x1 limiting é2"), (7, "unique words"), (8, "acme acme")]
    folder = str(tmp_path / "index")
    Q.write_index(spark.createDataFrame(rows, "id long, t string"), "id", F.col("t"), folder, buckets=8)
    got = Q.search(spark, folder, spark.createDataFrame(queries, "query_id long, text string"), top=7, buckets=8)
    assert {(x["query_id"], x["id"], x["rank"], x["place"]) for x in got.collect()} == brute(rows, queries, 7)
    assert Q.search(spark, folder, spark.createDataFrame([], "query_id long, text string"), buckets=8).collect() == []


def test_only_asked_buckets_are_read(spark, tmp_path):
    folder = str(tmp_path / "index")
    rows = spark.createDataFrame([(i, f"word{i} common") for i in range(300)], "id long, t string")
    Q.write_index(rows, "id", F.col("t"), folder, buckets=16)
    one = Q.postings(spark, folder, "bigint", [3])
    assert {f.split("bucket=")[1].split("/")[0] for f in one.select("id", F.input_file_name().alias("f")).toPandas()["f"]} == {"3"}
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().explainString(one._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert 0 < one.count() < 60
