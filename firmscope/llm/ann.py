"""Approximate nearest neighbours by cosine: a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmscope.llm.common import checkpointed

SAMPLE, BRANCH, LEAF, RECALL = 20_000, 8, 256, 0.97
#: Vectors of a shard, and queries that meet it at once.
SHARD, TOGETHER = 2_048, 20_000


class Tree:
    """Centres of nested clusters of unit vectors. children[i]: nodes below node i; leaves have a number instead."""

    def __init__(self, x: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = 0):
        self.centres: list[np.ndarray] = [x.mean(0) if len(x) else np.zeros(x.shape[1] if x.ndim == 2 else 1)]
        self.children: list[list[int]] = [[]]
        self.leaf_no: list[int] = [-1]
        rng, todo, self.leaves = np.random.RandomState(seed), [(0, np.arange(len(x)))], 0
        while todo:
            node, rows = todo.pop()
            parts = self._split(x[rows], branch, rng) if len(rows) > leaf else []
            if len(parts) < 2:
                self.leaf_no[node], self.leaves = self.leaves, self.leaves + 1
                continue
            for centre, inside in parts:
                self.children[node].append(len(self.centres))
                todo.append((len(self.centres), rows[inside]))
                self.centres.append(centre)
                self.children.append([])
                self.leaf_no.append(-1)
        self.matrix = np.array(self.centres)

    @staticmethod
    def _split(x: np.ndarray, branch: int, rng: np.random.RandomState, rounds: int = 8) -> list[tuple[np.ndarray, np.ndarray]]:
        c = np.unique(x[rng.choice(len(x), min(branch, len(x)), replace=False)], axis=0)
        for _ in range(rounds):
            own = np.argmin((c**2).sum(1) - 2 * x @ c.T, 1)
            c = np.array([x[own == k].mean(0) for k in range(len(c)) if (own == k).any()])
        own = np.argmin((c**2).sum(1) - 2 * x @ c.T, 1)
        return [(c[k], np.flatnonzero(own == k)) for k in range(len(c)) if (own == k).any()]

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row, by the nearest centre at each level."""
        out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            kids = self.children[node]
            if not kids:
                out[rows] = self.leaf_no[node]
            elif len(rows):
                c = self.matrix[kids]
                own = np.argmin((c**2).sum(1) - 2 * x[rows] @ c.T, 1)
                todo += [(kid, rows[own == k]) for k, kid in enumerate(kids)]
        return out

    def visit(self, q: np.ndarray, n: int) -> list[int]:
        """The first n leaves for q, the nearest bin first: a queue holds every branch passed by."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < n:
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                out.append(self.leaf_no[node])
                continue
            for d, kid in zip(((self.matrix[kids] - q) ** 2).sum(1).tolist(), kids, strict=True):
                heapq.heappush(queue, (d, kid))
        return out


def calibrate(tree: Tree, x: np.ndarray, recall: float, k: int, queries: int = 200) -> int:
    """Leaves to visit so that this part of the k nearest of sampled rows is found: visits widen until it is reached."""
    if len(x) < 2:
        return max(1, tree.leaves)
    at = np.linspace(0, len(x) - 1, min(queries, len(x))).astype(int)
    leaf = tree.place(x)
    sims = x[at] @ x.T
    sims[np.arange(len(at)), at] = -np.inf
    best = np.argsort(-sims, 1)[:, : min(k, len(x) - 1)]
    need = []
    for row, q in zip(best, at, strict=True):
        order = {v: i for i, v in enumerate(tree.visit(x[q], tree.leaves))}
        need += [order[v] for v in leaf[row]]
    n = int(np.quantile(need, recall, method="higher")) + 1
    return min(n, tree.leaves)


def shards_of(counts: dict[int, int], most: int = SHARD) -> dict[int, tuple[int, int]]:
    """(first shard, shards) of each leaf: a large leaf is dealt to several, neighbouring small ones share one."""
    out, shard, room = {}, 0, most
    for leaf in sorted(counts):
        n = counts[leaf]
        if n > room and room < most:
            shard, room = shard + 1, most
        parts = -(-n // most)
        out[leaf] = (shard, parts)
        shard, room = (shard, room - n) if parts == 1 else (shard + parts, most)
    return out


def kept(near: list[tuple[float, int]], k: int) -> list[tuple[float, int]]:
    """Of (distance, id) in order, as many as the k nearest without any one id can come from: k of an id at most, 2 k in all."""
    out: list[tuple[float, int]] = []
    of: dict[int, int] = {}
    for s, i in near:
        if of.get(i, 0) < k:
            out.append((s, i))
            of[i] = of.get(i, 0) + 1
            if len(out) - max(of.values()) >= k:
                break
    return out


def enough(near: list[tuple[float, int]], k: int) -> int:
    """How many are left, at least, without any one id."""
    ids = [i for _, i in near]
    return len(ids) - max((ids.count(i) for i in set(ids)), default=0)


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine in double precision): the k nearest found of each row of queries.

    Candidates are all rows of vectors but those of the query's own id; repeated rows are candidates each. Ties go to the
    smaller id. Vectors that are null, zero, hold null or non-finite components, or have a null id take no part. Vectors
    of different lengths have no cosine: each length is searched by itself, with a tree of its own, so lengths should be
    few. Other columns are not read. A query with fewer than k candidates gets all of them; no rows, no result.

    The tree is fitted on about `sample` vectors chosen by a hash of their components, and every vector is put in a leaf.
    Equal vectors are searched once: only their smallest ids, no more than k of one, can be among a query's nearest.
    Leaves are gathered in shards of about SHARD vectors, which meet TOGETHER queries at a time. Visits per query are
    calibrated on the sample for the part `recall` of true neighbours.
    """

    def usable(df: DataFrame) -> DataFrame:
        v = F.col(vec_col).cast("array<double>")
        ok = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
        return df.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(F.coalesce(ok, F.lit(False)))

    rows, asked = usable(vectors), usable(queries)
    lengths = sorted(r["d"] for r in asked.select(F.size("v").alias("d")).distinct().collect())
    out = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for d in lengths:
        out = out.unionByName(_of_length(rows.filter(F.size("v") == d), asked.filter(F.size("v") == d), d, k, sample, recall))
    return out


def _of_length(rows: DataFrame, asked: DataFrame, d: int, k: int, sample: int, recall: float) -> DataFrame:
    spark = rows.sparkSession
    # of each vector k rows of an id, and of these the 2 k smallest ids; ranks are cut before the shuffle, so a common vector sends few rows
    of_id, by_id = Window.partitionBy("v", "id").orderBy("id"), Window.partitionBy("v").orderBy("id")
    first = rows.withColumn("r", F.row_number().over(of_id)).filter(F.col("r") <= k).drop("r").withColumn("r", F.row_number().over(by_id)).filter(F.col("r") <= 2 * k)
    distinct = checkpointed(first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("key", F.xxhash64("v")))
    total = distinct.count()
    part = F.pmod(F.xxhash64(F.lit("tree"), F.col("key")), F.lit(1_000_000)) < int(1e6 * min(1.0, sample / max(1, total)))
    x = np.array(distinct.filter(part).select("v").toPandas()["v"].tolist(), float).reshape(-1, d)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    tree = Tree(x)
    visits = calibrate(tree, x, recall, k)
    held = spark.sparkContext.broadcast(tree)

    def unit(b: pd.Series) -> np.ndarray:
        m = np.array(b.tolist(), float).reshape(-1, d)
        m = m / np.abs(m).max(1, keepdims=True)
        return m / np.linalg.norm(m, axis=1, keepdims=True)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(leaf=held.value.place(unit(b["v"])))

    placed = checkpointed(distinct.mapInPandas(place, "v array<double>, ids array<long>, key long, leaf long"))
    counts = {r["leaf"]: r["n"] for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # a row a leaf at most
    shards = shards_of(counts)
    table = spark.createDataFrame([(leaf, first, n) for leaf, (first, n) in shards.items()], "leaf long, first long, n long")
    asked = checkpointed(asked)
    q = asked.select("v").distinct().withColumn("key", F.xxhash64("v"))
    together = max(1, -(-q.count() // TOGETHER))
    cand = placed.join(F.broadcast(table), "leaf").select((F.col("first") + F.pmod("key", "n")).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(together - 1))).alias("part"), "leaf", "v", "ids")

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for v, key, u in zip(b["v"], b["key"], unit(b["v"]), strict=True):
                mine: dict[int, list[int]] = {}
                for leaf in held.value.visit(u, visits):
                    first, n = shards.get(leaf, (0, 0))
                    for s in range(first, first + n):
                        mine.setdefault(s, []).append(leaf)
                out += [(s, key % together, leaves, v) for s, leaves in mine.items()]
            yield pd.DataFrame(out, columns=["shard", "part", "leaves", "v"])

    q = q.repartition("key").mapInPandas(visit, "shard long, part int, leaves array<long>, v array<double>")

    def closest(c: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        if not len(c) or not len(qs):
            return pd.DataFrame({"v": [], "near": []}, dtype=object)
        b, uc, ids = np.array(c["v"].tolist(), float).reshape(-1, d), unit(c["v"]), c["ids"].tolist()
        first = np.array([i[0] for i in ids])
        names, code = np.unique(c["leaf"].to_numpy(), return_inverse=True)
        norm, near = np.linalg.norm(b, axis=1), []
        for at in range(0, len(qs), 256):
            some = qs.iloc[at : at + 256]
            a = np.array(some["v"].tolist(), float).reshape(-1, d)
            visited = np.array([np.isin(names, x) for x in some["leaves"]])
            rough = np.where(visited[:, code], unit(some["v"]) @ uc.T, -2.0)
            n = min(2 * k, len(b))
            edges = np.partition(rough, len(b) - n, axis=1)[:, len(b) - n]
            for i, row in enumerate(rough):
                own = np.flatnonzero(row >= max(edges[i] - 1e-9, -1.5))
                exact = b[own] @ a[i] / (norm[own] * np.linalg.norm(a[i]))
                best = kept(sorted((-float(exact[j]), int(v)) for j in np.lexsort((first[own], -exact))[: 2 * k] for v in ids[own[j]]), k)
                if enough(best, k) < k and (row > -1.5).sum() > len(own):  # an id with many vectors near by: all that is visited, in order
                    own = np.flatnonzero(row > -1.5)
                    exact = b[own] @ a[i] / (norm[own] * np.linalg.norm(a[i]))
                    best = kept(sorted((-float(e), int(v)) for e, j in zip(exact, own, strict=True) for v in ids[j]), k)
                near.append([{"s": x, "id": v} for x, v in best])
        return pd.DataFrame({"v": qs["v"].tolist(), "near": near})

    got = cand.groupBy("shard", "part").cogroup(q.groupBy("shard", "part")).applyInPandas(closest, "v array<double>, near array<struct<s:double,id:long>>")
    ids = got.groupBy("v").agg(F.array_sort(F.flatten(F.collect_list("near"))).alias("near"))  # 2 k from each shard
    own = asked.join(ids, "v").select(F.col("id").alias("q"), F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k).alias("near"))
    return own.select("q", F.posexplode("near")).select(F.col("q").cast("long").alias("query_id"), (F.col("pos") + 1).cast("int").alias("rank"), F.col("col.id").cast("long").alias("vec_id"), (-F.col("col.s")).alias("score"))


def brute_force(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int = 5) -> list[int]:
    """The exact answer for one query, for tests and recall."""
    s = vectors @ query / (np.linalg.norm(vectors, axis=1) * np.linalg.norm(query))
    order = [i for i in np.lexsort((ids, -s)) if ids[i] != own][:k]
    return ids[order].tolist()
