"""Queries over whole tables, on small fixtures."""

from firmscope.plans import evidence_queries, text_queries  # noqa: F401
from firmscope.plans.registry import QUERIES


def test_chunks_hold_the_whole_text(spark, tmp_path):
    texts = {1: "ab" * 25_000, 2: "c" * 9000, 3: "", 4: None, 5: "é" * 9001}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {}
    for r in QUERIES["chunk_text_all"](spark, str(tmp_path)).orderBy("doc_id", "chunk").collect():
        got.setdefault(r["doc_id"], []).append(r["n"])
    assert got == {1: [9000] * 5 + [5000], 2: [9000], 5: [9000, 1]}


def test_every_customer_and_line_has_a_row(spark, tmp_path):
    put = lambda name, rows, kind: spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    put("region", [(1, "EUROPE"), (2, "AMERICA"), (3, "ASIA")], "r_regionkey int, r_name string")
    put("nation", [(1, 1), (2, 2), (3, 3)], "n_nationkey int, n_regionkey int")
    put("customer", [(k, f"C{k}", 1 + k % 3, "S") for k in (1, 2, 3, 10)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    put("lineitem", [(1, 1, 6.0, 0.0, 0.02), (1, 2, 9.0, 0.05, 0.02), (5, 1, 3.0, 0.1, 0.0)], "l_orderkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double")
    got = {tuple(r) for r in QUERIES["discover_firms_all"](spark, str(tmp_path)).collect()}
    assert got == {("c1", "S", "Tier 2"), ("c2", "S", "Tier 3"), ("c3", "S", "Tier 1"), ("c10", "S", "Tier 2")}
    got = {tuple(r) for r in QUERIES["truthy_fields_all"](spark, str(tmp_path)).collect()}
    assert got == {(1, 1, True, 6, 0.02), (1, 2, True, 2, 0.05), (5, 1, False, 3, 0.1)}
