"""Best-fit packing, centroid clustering and the Merkle manifest against plain Python, and their results for odd input."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_text import ODD, docs_of, odd, whole

from firmscope.llm import best_fit, centroids, manifest, queries
from firmscope.llm.encode import vocabulary

# ---- best fit


def fewest(items, window):
    """Least number of sequences, by dynamic programming over subsets."""
    best = [(1, 0)] + [(99, 0)] * ((1 << len(items)) - 1)
    for m in range(1 << len(items)):
        n, load = best[m]
        for i, x in enumerate(items):
            if not m >> i & 1:
                best[m | 1 << i] = min(best[m | 1 << i], (n, load + x) if load + x <= window else (n + 1, x))
    return best[-1][0] if items else 0


def loads(table, counts):
    """Offsets and lengths in each sequence, as the table of places gives them."""
    by, out = defaultdict(list), defaultdict(list)
    for size, *row in table.tolist():
        by[size].append(row)
    for size, n in counts.items():
        for rank in range(n):
            low, each, first, at = [r for r in by[size] if r[0] <= rank][-1]
            out[first + (rank - low) // each].append((at + (rank - low) % each * size, size))
    return out


def check_loads(got, window):
    for rows in got.values():
        at = 0
        for offset, size in sorted(rows):
            assert offset == at
            at += size
        assert at <= window


def test_reduction_loses_no_optimum():
    r = random.Random(7)
    for _ in range(500):
        window = r.choice([7, 10, 20, 30, 50])
        items = [r.randint(1, window) for _ in range(r.randint(0, 10))]
        fixed, left = best_fit.reduce(Counter(items), window)
        rest = [x for x, n in left.items() for _ in range(n)]
        assert sum(n for n, _ in fixed) + fewest(rest, window) == fewest(items, window)
        assert sorted(rest + [x for n, f in fixed for x in f for _ in range(n)]) == sorted(items)
        table, n = best_fit.places(Counter(items), window)
        got = loads(table, Counter(items))
        check_loads(got, window)
        assert len(got) == n


def test_each_dominance_rule():
    assert best_fit.dominant(Counter([8, 5]), 8, 10) == (8,)  # nothing fits
    assert best_fit.dominant(Counter([6, 4, 3]), 6, 10) == (6, 4)  # full
    assert best_fit.dominant(Counter([5, 4, 3, 3]), 5, 10) == (5, 4)  # no set fits that is longer than 4
    assert best_fit.dominant(Counter([5, 3, 2]), 5, 10) == (5, 3, 2)  # three pieces
    assert best_fit.dominant(Counter([4, 3, 2, 2, 2, 2]), 4, 10) is None  # 2 + 2 + 2 isn't dominated by 3 + 2


def slow_best_fit(counts, window):
    room = []
    for x in sorted((k for k, n in counts.items() for _ in range(n)), reverse=True):
        fits = [i for i, r in enumerate(room) if r >= x]
        at = min(fits, key=lambda i: room[i]) if fits else len(room)
        if not fits:
            room.append(window)
        room[at] -= x
    return room


def test_best_fit_on_counts_is_best_fit_on_pieces():
    r = random.Random(1)
    for _ in range(300):
        window = r.choice([10, 37, 100])
        counts = Counter(r.randint(1, window) for _ in range(r.randint(0, 60)))
        runs, n = best_fit.best_fit(counts, window)
        room = slow_best_fit(counts, window)
        assert n == len(room)
        got, used = defaultdict(list), Counter()
        for size, pieces, each, first, at in runs:
            used[size] += pieces
            for k in range(pieces):
                got[first + k // each].append((at + k % each * size, size))
        assert used == +counts
        check_loads(got, window)
        assert sorted(window - sum(s for _, s in x) for x in got.values()) == sorted(room)


def check_whole(rows, texts, window=2048, end=0):
    """Pieces are the documents'; sequences have no gaps. Returns how many there are."""
    ids = [x + [end] for x in texts]
    want = Counter((i // window, i, min(window, len(x) - i), zlib.crc32(np.array(x[i : i + window], "<u4").tobytes())) for x in ids for i in range(0, len(x), window))
    assert Counter((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    check_loads(by, window)
    return len(by)


def test_op11(spark, sf):
    rows = queries.op11_best_fit(spark, sf).collect()
    docs = docs_of(spark, sf)
    texts = whole([t for _, t in docs])
    n = check_whole(rows, texts)
    of = defaultdict(list)
    for r in rows:
        of[r["doc_id"]].append((r["piece"], r["length"]))
    assert {d: sum(k for _, k in x) for d, x in of.items()} == {d: len(x) + 1 for (d, _), x in zip(docs, texts, strict=True)}
    assert all(sorted(p for p, _ in x) == list(range(len(x))) for x in of.values())
    lengths = Counter(r["length"] for r in rows)
    assert -(-sum(r["length"] for r in rows) // 2048) <= n <= len(slow_best_fit(lengths, 2048))


def test_op11_odd(spark):
    df = odd(spark)
    out = best_fit.pack_whole(df, vocabulary())
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check_whole(out.collect(), whole([t for _, t in ODD]))
    assert best_fit.pack_whole(df.limit(0), vocabulary()).collect() == []
    same = spark.range(5000).select(F.when(F.col("id") < 2000, None).otherwise(7).cast("long").alias("doc_id"), F.lit("a b c").alias("text"))
    rows = best_fit.pack_whole(same, vocabulary()).collect()
    assert check_whole(rows, whole(["a b c"] * 5000)) == -(-5000 // (2048 // 4))


# ---- centroids


def brute_clusters(rows, k=40, rounds=5, dims=64):
    """rows: (id, components). [(id, cluster, distance)] and centroids."""
    from math import floor, isfinite

    kept = [(i, [floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and isfinite(x) for x in v)]
    order = sorted((x for x in kept if x[0] is not None), key=lambda x: (hashlib.sha256(f"2:{x[0]}".encode()).hexdigest(), x[1])) + sorted((x for x in kept if x[0] is None), key=lambda x: x[1])
    c = [list(v) for _, v in order[:k]]
    for r in range(rounds + 1):
        at = [min((sum((a - b) ** 2 for a, b in zip(v, y, strict=True)), j) for j, y in enumerate(c)) for _, v in kept]
        if r < rounds:
            for j in range(len(c)):
                own = [v for (_, v), (_, g) in zip(kept, at, strict=True) if g == j]
                if own:
                    c[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    return [(i, j, d) for (i, _), (d, j) in zip(kept, at, strict=True)], c


def check_clusters(df, rows, k=40, dims=64, rounds=5):
    out, c = centroids.cluster(df, k=k, dims=dims, rounds=rounds)
    want, ends = brute_clusters(rows, k, rounds, dims)
    assert c.tolist() == ends
    got = centroids.with_inertia(out, c).collect()
    assert sorted(map(str, [(r["vec_id"], r["cluster"], r["distance"]) for r in got])) == sorted(map(str, want))
    inertia = Counter()
    for _, j, d in want:
        inertia[j] += d
    for r in got:
        assert (r["cluster_inertia"], r["inertia"]) == (inertia[r["cluster"]], sum(inertia.values()))
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, ends[r["cluster"]])).encode()).hexdigest()
    return got


def test_op12(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = check_clusters(df, [(r["vec_id"], r["embedding"]) for r in df.collect()])
    assert sorted(str({**r.asDict(), "n_distances": 0}) for r in got) == sorted(str({**r.asDict(), "n_distances": 0}) for r in queries.op12_centroids(spark, sf).withColumn("n_distances", F.lit(0)).select(got[0].__fields__).collect())
    assert sum(r["n_distances"] for r in got) < 0.75 * 40 * 6 * len(got)  # bounds skip the others


def test_op12_odd(spark):
    r = random.Random(5)
    rows = [(i % 60 if i % 7 else None, [r.randint(-2, 2) / 256 for _ in range(4)]) for i in range(300)]  # many ties and repeated rows
    rows += [(1, None), (2, []), (3, [1.0] * 5), (4, [1.0, None, 0.0, 0.0]), (5, [float("nan")] * 4), (6, [float("inf"), 0.0, 0.0, 0.0])]
    make = lambda x: spark.createDataFrame(x, "vec_id long, embedding array<double>").select("*", *(F.lit("x").alias(c) for c in ("id", "v", "at", "k", "n", "s", "cluster", "distance")))
    for k in (1, 3, 12):
        check_clusters(make(rows), rows, k=k, dims=4)
    few = rows[:3] + rows[:1]
    check_clusters(make(few), few, dims=4)
    apart = [(i, [float(i // 20 * 50 + r.random()) for _ in range(4)]) for i in range(200)]
    got = check_clusters(make(apart), apart, k=10, dims=4)
    assert sum(x["n_distances"] for x in got) < 0.35 * 10 * 6 * 200
    none, c = centroids.cluster(make(rows).limit(0), dims=4)
    assert centroids.with_inertia(none, c).collect() == [] and len(c) == 0
    wide = [(1, [1e5, 0.0, 0.0, -1e5]), (2, [-1e5] * 4), (3, [1e300] * 4), (4, [-0.001] * 4)]
    check_clusters(make(wide), [wide[0], wide[1], wide[3]], dims=4, k=2)  # what a long can't hold is left out


# ---- manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(nodes, fanout):
    """Root and, for each node, its siblings in order with how many come before, level by level."""
    paths, spots = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for at, own in enumerate(spots):
            run, place = runs[at // fanout], at % fanout
            for i in own:
                paths[i].append((run[:place], run[place + 1 :]))
        spots = [sum(spots[i : i + fanout], []) for i in range(0, len(spots), fanout)]
        nodes = [sha(*r) for r in runs]
    return nodes[0], paths


def brute_manifest(rows, fanout=2):
    """rows: doc_id, source, lang, n_chars, text."""
    part = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda r: sha(*map(part, r))
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    order = {g: sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for g in names}
    trees = {g: brute_tree([leaf(r) for r in order[g]], fanout) for g in names}
    root, tops = brute_tree([trees[g][0] for g in names], fanout)
    out = []
    for g, top in zip(names, tops, strict=True):
        for r, path in zip(order[g], trees[g][1], strict=True):
            path = path + top
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None
            node = leaf((*r[:3], r[3] + 1, r[4])) if bad else leaf(r)
            for before, after in path:
                node = sha(*before, node, *after)
            out.append((r[0], leaf(r), trees[g][0], root, sha(*(x for a, b in path for x in a + b)), node, node == root))
            assert (node != root) == bad
    return out


KIND = "doc_id long, source string, lang string, n_chars long, text string"
COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest_of(spark, rows, fanout=2):
    df = spark.createDataFrame(rows, KIND).select("*", *(F.lit("x").alias(c) for c in ("g", "rank", "node", "id", "grp", "key", "u", "claimed", "leaf", "root")))
    tampered = F.when(queries.remainder("doc_id", 7) == 0, (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")).otherwise(F.col("n_chars").cast("string"))
    return manifest.manifest(df, ["doc_id", "source", "lang", "n_chars", "text"], fanout=fanout, claims={"n_chars": tampered}, siblings=True)


def test_op13(spark, sf):
    got = queries.op13_manifest(spark, sf)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted(map(tuple, got.select(COLUMNS).collect())) == sorted(brute_manifest(rows))


def odd_rows():
    r = random.Random(2)
    out = [(r.choice([None, 0, -1, -(1 << 63), (1 << 63) - 1, r.getrandbits(62), r.randint(0, 300)]), r.choice([None, "", "a"]), r.choice([None, "", "é", "zz", "z", "de", "de", "de"]), r.choice([None, 3, -5, (1 << 63) - 1]), r.choice([None, "", "x y", "ß東" * 99])) for _ in range(700)]
    return out + [(None, "s", "de", 1, "copy")] * 90 + [(5, "s", "de", 1, "copy")] * 40 + [(9, None, "alone", None, None)]


@pytest.mark.parametrize("fanout", [2, 3, 7])
def test_op13_odd(spark, monkeypatch, fanout):
    monkeypatch.setattr(manifest, "CELL", 16)
    monkeypatch.setattr(manifest, "BLOCK", 20)
    rows = odd_rows()
    got = manifest_of(spark, rows, fanout).collect()
    key = lambda r: tuple((x is not None, x) if x is None or not isinstance(x, int) else (True, x) for x in r)
    assert Counter(map(key, ([r[c] for c in COLUMNS] for r in got))) == Counter(map(key, brute_manifest(rows, fanout)))
    for r in got:
        assert r["proof_sha256"] == sha(*(x for level in r["siblings"] for x in level["before"] + level["after"]))
    assert {(r["lang"], r["place"]) for r in got} == {(g, i) for g, n in Counter(r[2] for r in rows).items() for i in range(n)}


def test_op13_few(spark):
    for rows in ([(1, None, None, None, None)], [(1, "a", "b", 2, "c")] * 3, [(i, "a", str(i), 2, "c") for i in range(5)]):
        assert sorted(tuple(r[c] for c in COLUMNS) for r in manifest_of(spark, rows).collect()) == sorted(brute_manifest(rows))
    assert manifest.manifest(spark.createDataFrame([], KIND), ["doc_id", "text"]).collect() == []


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, sf, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    rel, df = c.sql(queries.oracle_sql()[name]), queries.queries()[name](spark, sf)
    assert sorted(rel.columns) == sorted(df.columns)
    assert sorted(map(tuple, df.select(sorted(df.columns)).collect())) == sorted(rel.select(",".join(sorted(rel.columns))).fetchall())
