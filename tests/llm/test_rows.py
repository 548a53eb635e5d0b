"""Stages judge each row by its own text: null ids, repeated ids with different texts, clashing column names."""

import corpus_pipeline
from pyspark.sql import functions as F
from test_jaccard import brute_kept
from test_llm_text import brute_components, brute_fp

from firmscope.llm import decontaminate, line_dedup, simhash, toxicity

CLASH = ["__th", "__spans", "__rows", "__new", "__r", "__text", "removed_lines", "c0", "c1", "score", "rid", "rth", "id", "th", "spans"]
RUN = "\n".join(f"line {i} of a run that comes again" for i in range(5))
ITEM = " ".join(f"q{i}" for i in range(14))
ROWS = [
    (1, "a quiet text about " + ITEM, "leak"),
    (1, "a clean text of its own, with nothing in it that any other has", "clean"),
    (None, "before " + ITEM.upper() + " after", "leak"),
    (None, "one more clean text without an id and without a fault", "clean"),
    (2, RUN, "clean"),
    (2, "top\n" + RUN, "lines"),
    (None, RUN + "\nend", "lines"),
    (3, None, "clean"),
    (None, None, "clean"),
    (4, "", "clean"),
]


def frame(spark):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], "doc_id long, text string, kind string, place int")
    return df.select("*", *(F.lit(f"kept {c}").alias(c) for c in CLASH))


def whole(out, df):
    assert out.columns == df.columns
    rows = out.collect()
    assert all(r[c] == f"kept {c}" for r in rows for c in CLASH)
    return {r["place"]: r["text"] for r in rows}


def test_leaks(spark):
    df, bench = frame(spark), spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string")
    assert set(whole(decontaminate.clean(df, bench), df)) == {i for i, r in enumerate(ROWS) if r[2] != "leak"}
    assert set(whole(decontaminate.clean(df, bench.limit(0)), df)) == set(range(len(ROWS)))


def test_shuffles_give_the_same(spark, monkeypatch):
    df, bench = frame(spark), spark.createDataFrame([(1, ITEM), (2, "a clean"), (3, ITEM)], "item_id long, text string")
    want = sorted(map(str, decontaminate.contamination(df, bench).collect()))
    for name in ("BROADCAST_ROWS", "BROADCAST_DOCS", "BROADCAST_PLACES", "BROADCAST_BYTES"):
        monkeypatch.setattr(decontaminate, name, 0)
    assert sorted(map(str, decontaminate.contamination(df, bench).collect())) == want


def test_toxic(spark):
    bad, good = "you are a rotten worm.", "we had tea and cake."
    train = spark.createDataFrame([(i, (bad if i % 2 else good) + f" word{i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    rows = [(7, good), (7, bad), (None, bad), (None, good), (100, bad), (100, bad), (101, None)]
    docs = train.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    kept = toxicity.drop_toxic(docs.withColumn("score", F.lit("s")).withColumn("c0", F.lit(1)), labels)
    assert kept.columns == ["doc_id", "text", "score", "c0"]
    left = [tuple(r)[:2] for r in kept.collect()]
    assert sorted(map(str, left)) == sorted(map(str, [(i, f"{good} word{i}") for i in range(0, 60, 2)] + [(7, good), (None, good), (101, None)]))


def test_lines(spark):
    df = frame(spark)
    got = whole(corpus_pipeline.drop_lines(spark, df, ""), df)
    assert got == {i: {5: "top", 6: "end"}.get(i, r[1]) for i, r in enumerate(ROWS)}
    plain = line_dedup.drop_repeated_lines(df)
    assert plain.columns == [*df.columns, "removed_lines_1"] and {r["place"]: r["text"] for r in plain.collect()}[6] == RUN + "\nend"


def test_one_of_each_group(spark):
    df = frame(spark)
    fps = {i: brute_fp(r[1]) for i, r in enumerate(ROWS)}
    order = lambda i: (ROWS[i][0] is None, ROWS[i][0] or 0)
    groups = {}
    for i, root in brute_components(fps).items():
        groups.setdefault(root, []).append(i)
    got = whole(simhash.keep_one(df), df)
    assert len(got) == len(groups)
    for members in groups.values():
        kept = [i for i in members if i in got]
        assert len(kept) == 1 and order(kept[0]) == min(map(order, members))
    got = whole(corpus_pipeline.drop_near_duplicates(spark, df, ""), df)
    want = brute_kept([r[:2] for r in ROWS])
    assert sorted(map(order, got)) == sorted(map(order, want))


def test_names_with_dots_and_of_working_columns(spark, sf):
    names = ["a.b", "__firmscope_key", "__firmscope_rank", "key", "rank", "rk", "root", "n", "removed_lines"]
    rows = [(1, RUN, 1, "x"), (2, "top\n" + RUN, 2, "y"), (3, "one two three four five six", 3, "z"), (4, "one two three four five six", 4, "z"), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, `c.d` string").select("*", *(F.lit(f"kept {c}").alias(c) for c in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, sf)
        assert out.columns == df.columns and out.schema["n_chars"] == df.schema["n_chars"]
        kept = [r.asDict() for r in out.collect()]
        assert len(kept) == {"simhash_near_dedup": 3}.get(name, 5) and all(r[c] == f"kept {c}" for r in kept for c in names)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in corpus_pipeline.drop_lines(spark, df, "").collect()}
    assert got[2] == ("top", 3) and got[1] == (RUN, 1)


def test_one_key_may_hold_most_rows(spark):
    from firmscope.llm.common import join_by_count

    rows = spark.range(5000).select((F.when(F.col("id") < 3000, 1).otherwise(F.col("id"))).alias("k"), "id")
    one = rows.groupBy("k").agg(F.count("*").alias("n"))
    assert join_by_count(rows, one, ["k"], "n", 10).filter("n = if(k = 1, 3000, 1)").count() == 5000
    assert join_by_count(rows.limit(0), one.limit(0), ["k"], "n").count() == 0
