"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window of 10 words holds six 5-grams; its fingerprint is the least of their hashes. Equal windows have equal
fingerprints, so every shared span of 10 words or more shows up in the join of training and test fingerprints. Each hit
is then extended to its windows and compared by words, so the result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmscope.llm.common import checkpointed, join_by_count, lower_az, numbered

WINDOW, GRAM = 10, 5
#: Test fingerprints (8 bytes each) that are broadcast; more of them are joined by a shuffle.
BROADCAST_ROWS = 500_000
#: Documents with hits that are broadcast, places of hits in them, and bytes of test windows; more are joined by a shuffle.
BROADCAST_DOCS, BROADCAST_PLACES, BROADCAST_BYTES = 20_000, 1_000_000, 32_000_000
#: Tasks that the documents of one fingerprint are dealt to where fingerprints are joined by a shuffle.
SALTS = 16


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words of letters, digits and anything beyond ASCII; none for null."""
    return F.array_remove(F.split(lower_az(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def _grams(words: Column, n: int, tag: int) -> Column:
    """Hash of the n words from each place on."""
    return F.when(F.size(words) < n, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(words) - n), lambda i: F.xxhash64(F.lit(tag), *(F.get(words, i + j) for j in range(n))))
    )


def _minima(grams: Column) -> Column:
    """Least hash of each WINDOW: of WINDOW - GRAM + 1 neighbouring grams."""
    k = WINDOW - GRAM + 1
    return F.when(F.size(grams) < k, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.size(grams) - k), lambda i: F.least(*(F.get(grams, i + j) for j in range(k)))))


def _window_text(words: Column, start: Column, n: int) -> Column:
    return F.array_join(F.slice(words, start + 1, n), " ")


def _with_prints(df: DataFrame, short: list[int]) -> DataFrame:
    """df (w: words) with g (5-gram hashes), p10 (window minima) and, for each short item length n, p{n}."""
    df = df.withColumn("g", _grams(F.col("w"), GRAM, 0)).withColumn("p10", _minima(F.col("g"))).drop("g")
    return df.withColumns({f"p{n}": _grams(F.col("w"), n, n) for n in short}) if short else df


def _runs(df: DataFrame, sizes: list[int]) -> DataFrame:
    """df with `runs`: (p, n, s, e) for each stretch of windows of n words, from word s up to e - 1, that select one fingerprint p."""
    new = lambda p: F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: (i == 0) | (F.get(p, i) != F.get(p, i - 1)))
    df = df.withColumns({f"r{n}": F.when(F.size(f"p{n}") > 0, new(F.col(f"p{n}"))).otherwise(F.array().cast("array<int>")) for n in sizes})

    def of(n: int) -> Column:
        p, r = F.col(f"p{n}"), F.col(f"r{n}")
        return F.transform(r, lambda s, k: F.struct(F.get(p, s).alias("p"), F.lit(n).alias("n"), s.alias("s"), F.coalesce(F.get(r, k + 1), F.size(p)).alias("e")))

    return df.withColumn("runs", F.concat(*(of(n) for n in sizes)))


def _small(df: DataFrame, size: Column, rows: int, most: int) -> bool:
    """Whether df has no more than `rows` rows and `size` adds up to no more than `most`."""
    got = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("s")).first()
    return got["n"] <= rows and got["s"] <= most


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """id_col, n_words, n_hit, n_items, items_sha256, contaminated for each row of docs; whole texts are read.

    A window is 10 consecutive words of an item, or all of a shorter item that has words; words of a document inside any
    occurrence of a window are hit. Null texts have no words. Rows that agree in id and text get the same result each;
    items of equal text all count; windows of an item without item_id are hit but count in no list. Other columns are not
    read. Without test items no document is hit; no documents give no rows.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    d = d.select("id", F.xxhash64(F.coalesce("t", F.lit(""))).alias("th"), words_of(F.col("t")).alias("w"))
    result = _results(d, benchmark.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(item_text)).alias("w")))
    base = d.select("id", "th", F.size("w").cast("long").alias("n_words"))
    return base.join(result, F.col("id").eqNullSafe(F.col("rid")) & (F.col("th") == F.col("rth")), "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def _results(d: DataFrame, benchmark: DataFrame) -> DataFrame:
    """rid, rth, n_hit and items of each contaminated pair of id and text hash of d (id, th, w)."""
    items = checkpointed(benchmark.filter("size(w) > 0"))
    sizes = items.groupBy(F.least(F.size("w"), F.lit(WINDOW)).alias("n")).agg(F.count("*").alias("c")).collect()  # at most ten rows
    short = sorted(r["n"] for r in sizes if r["n"] < WINDOW)

    # windows of the items, with their fingerprints
    starts = F.explode(F.sequence(F.lit(0), F.size("w") - WINDOW))
    windows = _with_prints(items.filter(F.size("w") >= WINDOW), []).select("item", "w", "p10", starts.alias("s")).select("item", F.lit(WINDOW).alias("n"), F.get("p10", F.col("s")).alias("p"), _window_text(F.col("w"), F.col("s"), WINDOW).alias("x"))
    for n in short:
        windows = windows.union(items.filter(F.size("w") == n).select("item", F.lit(n).alias("n"), F.get(_grams(F.col("w"), n, n), F.lit(0)).alias("p"), F.array_join("w", " ").alias("x")))
    windows = checkpointed(windows.distinct())
    prints = windows.select("p").distinct()

    # training fingerprints with the places that selected them, joined with those of the items
    # explode_outer: for explode(), Spark adds a filter below that works all fingerprints out once more, in every step of a lambda
    mine = _runs(_with_prints(d, short), [*short, WINDOW]).select("id", "th", F.explode_outer("runs").alias("r")).select("id", "th", "r.*").filter("s is not null")
    if prints.count() <= BROADCAST_ROWS:
        met = mine.join(F.broadcast(prints), "p")
    else:  # a fingerprint of a common passage is dealt to SALTS tasks
        salted = prints.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = mine.withColumn("salt", F.pmod(F.xxhash64("id", "th"), F.lit(SALTS)).cast("int")).join(salted, ["p", "salt"])
    cand = checkpointed(met.groupBy("id", "th").agg(F.collect_set(F.struct("n", "s", "e")).alias("at")))
    some = cand.withColumnsRenamed({"id": "id2", "th": "th2"})
    some = F.broadcast(some) if _small(cand, F.size("at"), BROADCAST_DOCS, BROADCAST_PLACES) else some

    # extend: the windows at those places, compared by their words
    again = d.join(some, F.col("id").eqNullSafe(F.col("id2")) & (F.col("th") == F.col("th2"))).drop("id2", "th2").dropDuplicates(["id", "th"])
    text_at = lambda r: F.transform(F.sequence(r["s"], r["e"] - 1), lambda i: F.struct(i.alias("s"), r["n"].alias("n"), F.array_join(F.slice("w", i + 1, r["n"]), " ").alias("x")))
    found = again.select("id", "th", F.explode_outer(F.flatten(F.transform("at", text_at))).alias("h")).select("id", "th", "h.*").filter("x is not null")
    few = _small(windows, F.octet_length("x"), BROADCAST_ROWS, BROADCAST_BYTES)
    found = found if few else checkpointed(found)

    def with_windows(rows: DataFrame, of: DataFrame) -> DataFrame:
        if few:
            return rows.join(F.broadcast(of), ["x", "n"])
        count = rows.groupBy("x", "n").agg(F.count("*").alias("k"))
        return join_by_count(rows, checkpointed(of.join(count, ["x", "n"])), ["x", "n"], "k").drop("k")

    met = checkpointed(with_windows(found, windows.select("x", "n").distinct()).select("id", "th", "s", "n", "x"))
    by_start = Window.partitionBy("id", "th").orderBy("s", "n")
    before = F.max(F.col("s") + F.col("n")).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    covered = met.select("id", "th", F.greatest(F.lit(0), F.col("s") + F.col("n") - F.greatest(F.col("s"), F.coalesce(before, F.lit(0)))).alias("c")).groupBy("id", "th").agg(F.sum("c").cast("long").alias("n_hit"))
    texts = with_windows(met.select("id", "th", "x", "n").distinct(), windows.groupBy("x", "n").agg(F.collect_set("item").alias("of")))
    listed = texts.withColumn("item", F.explode_outer("of")).groupBy("id", "th").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return covered.join(listed.withColumnsRenamed({"id": "i", "th": "h"}), F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("h"))).select(F.col("i").alias("rid"), F.col("h").alias("rth"), "n_hit", "items")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs without the contaminated rows; all columns return as they are.

    Each row is judged by its own text, so a contaminated row with a null id goes, and a clean row stays whatever other
    rows have its id. Null texts have no words and stay; without test items all stay.
    """
    rows = numbered(docs)
    own, text = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    th = F.xxhash64(F.coalesce(text, F.lit("")))
    d = rows.select(own.alias("id"), th.alias("th"), words_of(text).alias("w"))
    bad = _results(d, benchmark.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(item_text)).alias("w"))).select("rid", "rth")
    return rows.join(bad, own.eqNullSafe(F.col("rid")) & (th == F.col("rth")), "left_anti").toDF(*docs.columns)
