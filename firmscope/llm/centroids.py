"""Centroid clustering by rounds of exact integer distances, with Elkan's bounds.

Every vector carries an upper bound of the distance to its centroid and a lower bound for each of the k centroids from
round to round, in a table of the shared folder. A round moves the bounds by how far the centroids went and works out
only the distances that the bounds and the distances between centroids leave open. Bounds are rounded outwards and only
a strictly greater one skips a centroid, so ties come out as without bounds. A round is one pass without a shuffle: its
tasks add what the vectors that changed their centroid mean for the sums, k rows each, which Spark then sums up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from firmscope.llm.common import shared_folder

DIMS, K, ROUNDS, SCALE = 64, 40, 5, 256
#: Integers beyond it would have squared distances that a long can't hold.
MOST = 1 << 27


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """id and v (array<int>): floor(scale * x) of each component x as a double.

    Vectors that are null, of another length, with a null or non-finite component or with an integer beyond 2**27 in
    size, for which squared distances don't fit a long, are left out.
    """
    x = F.col(vector_col)
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double") * scale) > MOST - 1)
    kept = vectors.filter((F.size(x) == dims) & ~F.exists(x, bad))
    return kept.select(F.col(id_col).alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("int")).alias("v"))


def first_centroids(rows: DataFrame, k: int = K, seed: str = "2:") -> np.ndarray:
    """The k vectors of the smallest sha256 of seed and id, in that order; equal ids go by their components, null ids last."""
    h = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    got = rows.select(h.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()  # k rows
    return np.array([r["v"] for r in got], np.int64)


def _below(d2: np.ndarray) -> np.ndarray:
    """At most the roots, as float32."""
    x = np.nextafter(np.sqrt(d2.astype(np.float64)), 0)
    return np.maximum(np.nextafter(x.astype(np.float32), np.float32(-np.inf)), np.float32(0))


def _above(d2: np.ndarray) -> np.ndarray:
    """At least the roots, as float32."""
    x = np.nextafter(np.sqrt(d2.astype(np.float64)), np.inf)
    return np.nextafter(x.astype(np.float32), np.float32(np.inf))


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def between(centroids: np.ndarray) -> np.ndarray:
    """At most half the distance of each two centroids."""
    return np.stack([_below(((centroids - c) ** 2).sum(1)) for c in centroids]) * np.float32(0.5)


def assign(v: np.ndarray, at: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray, half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact squared distances to the nearest centroids (-1 where bounds alone decided) and how many were worked out.

    at, upper and lower are changed in place. A centroid is skipped only if it is strictly farther than the vector's own.
    """
    d2, made = np.full(len(v), -1, np.int64), np.zeros(len(v), np.int32)
    others = half + np.where(np.eye(len(half), dtype=bool), np.float32(np.inf), np.float32(0))
    alone = others.min(1)  # within it no other centroid is as near
    open_ = upper >= alone[at]
    for k in range(len(centroids)):
        near = lambda r: r[(upper[r] >= lower[r, k]) & (upper[r] >= half[at[r], k])]  # noqa: B023, E731
        rows = near(np.flatnonzero(open_ & (at != k)))
        loose = rows[d2[rows] < 0]
        if len(loose):
            d2[loose] = _squared(v[loose], centroids[at[loose]])
            upper[loose], lower[loose, at[loose]] = _above(d2[loose]), _below(d2[loose])
            made[loose] += 1
            rows = near(rows)
        e = _squared(v[rows], centroids[k])
        lower[rows, k] = _below(e)
        made[rows] += 1
        better = (e < d2[rows]) | ((e == d2[rows]) & (k < at[rows]))
        to = rows[better]
        at[to], d2[to], upper[to] = k, e[better], _above(e[better])
    return d2, made


def _shifted(upper: np.ndarray, lower: np.ndarray, at: np.ndarray, moved: np.ndarray) -> None:
    """Bounds after the centroids have gone the squared distances `moved`."""
    up, down = _above(moved), _above(moved)
    up[moved == 0] = down[moved == 0] = 0
    own = up[at]
    upper[:] = np.where(own > 0, np.nextafter(upper + own, np.float32(np.inf)), upper)
    lower[:] = np.where(down > 0, np.maximum(np.nextafter(lower - down, np.float32(-np.inf)), np.float32(0)), lower)


def _matrix(column: pa.ListArray, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(kind)


def _lists(m: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)), pa.array(np.ascontiguousarray(m).ravel()))


def _round(table: DataFrame, centroids: np.ndarray, moved: np.ndarray | None, last: bool) -> DataFrame:
    """The rows after one assignment, and for each task the changes of its centroids' counts and sums (rows with k).

    table has id, v and, from the second round on (moved is given), at, upper, lower and made.
    """
    n, dims = centroids.shape
    held = table.sparkSession.sparkContext.broadcast((centroids, between(centroids), moved))  # k * (k + dims) numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, half, moved = held.value
        counts, sums = np.zeros(n, np.int64), np.zeros((n, dims), np.int64)
        for whole in batches:
            for low in range(0, whole.num_rows, 4096):
                b = whole.slice(low, 4096)
                v = _matrix(b.column("v"), dims, np.int64)
                if moved is None:
                    at, upper, lower = np.zeros(len(v), np.int32), np.full(len(v), np.inf, np.float32), np.zeros((len(v), n), np.float32)
                    before, made = np.full(len(v), -1, np.int32), np.zeros(len(v), np.int32)
                else:
                    at, upper, lower = b.column("at").to_numpy().copy(), b.column("upper").to_numpy().copy(), _matrix(b.column("lower"), n, np.float32)
                    before, made = at.copy(), b.column("made").to_numpy()
                    _shifted(upper, lower, at, moved)
                d2, new = assign(v, at, upper, lower, c, half)
                changed = np.flatnonzero(at != before)
                for to, sign in ((at[changed], 1), (before[changed], -1)):
                    for i in np.unique(to[to >= 0]):
                        own = changed[to == i]
                        counts[i] += sign * len(own)
                        sums[i] += sign * v[own].sum(0)
                if last:
                    d2 = np.where(d2 < 0, _squared(v, c[at]), d2)
                state = [b.column("id"), *((pa.nulls(len(v), pa.list_(pa.int32())), pa.nulls(len(v), pa.list_(pa.float32()))) if last else (b.column("v"), _lists(lower)))]
                yield pa.RecordBatch.from_arrays([*state, pa.array(at), pa.array(upper), pa.array(made + new), pa.array(d2), pa.nulls(len(v), pa.int32()), pa.nulls(len(v), pa.int64()), pa.nulls(len(v), pa.list_(pa.int64()))], names=names)
        own = np.flatnonzero((counts != 0) | (sums != 0).any(1))
        if len(own) and not last:
            blank = [pa.nulls(len(own), t) for t in (id_kind, pa.list_(pa.int32()), pa.list_(pa.float32()), pa.int32(), pa.float32(), pa.int32(), pa.int64())]
            yield pa.RecordBatch.from_arrays([*blank, pa.array(own.astype(np.int32)), pa.array(counts[own]), _lists(sums[own])], names=names)

    id_type = table.schema["id"].dataType
    id_kind = to_arrow_type(id_type)
    names = ["id", "v", "lower", "at", "upper", "made", "d2", "k", "n", "s"]
    return table.mapInArrow(run, f"id {id_type.simpleString()}, v array<int>, lower array<float>, at int, upper float, made int, d2 long, k int, n long, s array<long>")


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS, scale: int = SCALE, seed: str = "2:") -> tuple[DataFrame, np.ndarray]:
    """One row a vector (id_col, cluster, distance, n_distances), and the final centroids.

    The vectors of integers() are clustered; fewer than k of them are as many centroids. After `rounds` rounds of
    assignment to the nearest centroid (ties: smaller number) and floor(sum / count) of each component, exact in
    integers, they are assigned once more; a centroid without vectors stays. Repeated rows and null ids are vectors like
    any other. n_distances is how many distances were worked out for a vector. Other columns aren't read; without vectors
    there are no rows and no centroids. The driver holds k centroids; a round's table goes when the next but one is written.
    """
    spark = vectors.sparkSession
    rows = integers(vectors, id_col, vector_col, dims, scale)
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows.select(F.col("id").alias(id_col), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).alias("n_distances")).limit(0), centroids
    counts, sums, moved = [0] * len(centroids), [[0] * dims for _ in centroids], None
    folder, table, n = shared_folder(spark, "centroids"), rows, len(centroids)
    for r in range(rounds):
        _round(table, centroids, moved, False).write.parquet(f"{folder}/{r}")
        written = spark.read.parquet(f"{folder}/{r}")
        table = written.filter("k is null").select("id", "v", "lower", "at", "upper", "made")
        if r:
            _delete(spark, f"{folder}/{r - 1}")
        change = written.filter("k is not null").groupBy("k").agg(F.sum("n").alias("n"), *(F.sum(F.get("s", F.lit(i))).alias(f"s{i}") for i in range(dims))).collect()  # k rows
        new = centroids.copy()
        for x in change:
            counts[x["k"]] += x["n"]
            sums[x["k"]] = [a + x[f"s{i}"] for i, a in enumerate(sums[x["k"]])]
        for i in range(n):
            if counts[i]:
                new[i] = [a // counts[i] for a in sums[i]]
        moved, centroids = ((new - centroids) ** 2).sum(1), new
    _round(table, centroids, moved, True).select("id", "at", "d2", "made").write.parquet(f"{folder}/last")
    if rounds:
        _delete(spark, f"{folder}/{rounds - 1}")
    out = spark.read.parquet(f"{folder}/last")
    return out.select(F.col("id").alias(id_col), F.col("at").alias("cluster"), F.col("d2").alias("distance"), F.col("made").alias("n_distances")), centroids


def _delete(spark, folder: str) -> None:
    """A table that nothing reads any more: the next round's is whole."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def with_inertia(clustered: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The rows with cluster_inertia, inertia and centroid_sha256 (components as decimal integers, joined by commas).

    Sums that a long can't hold are null. The clusters' table, a row for each centroid, is broadcast.
    """
    total = clustered.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()  # k rows
    fits = lambda n: int(n) if n < 1 << 63 else None
    every = sum(r["d"] for r in total)
    rows = [(r["cluster"], fits(r["d"]), fits(every), hashlib.sha256(",".join(map(str, centroids[r["cluster"]].tolist())).encode()).hexdigest()) for r in total]
    sums = clustered.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return clustered.join(F.broadcast(sums), "cluster")
