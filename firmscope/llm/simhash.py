"""Near-duplicates by SimHash: fingerprints, links within a small Hamming distance through pivot distance tables, components.

Distances of a pair to any reference fingerprint (pivot) differ by no more than the pair's own distance. Each distinct
fingerprint gets a row of distances to many pivots. Some of them are spread far apart; the others lie close to one
anchor, in groups of three that differ from it in four bits of their own, so that their distances less the anchor's
(coordinates) depend on those four bits alone. Two fingerprints within 2 bits differ in the coordinates of at most two
groups: of any four sets of groups they agree in two. The coordinates of two of four sets are therefore keys that every
near pair shares one of. Members of a key are compared by their rows: pairs whose largest difference exceeds the radius
go, and the others are verified bit by bit. A key of many members is parted by coordinates of the groups that it leaves open, level by level.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmscope.llm.common import checkpointed, join_by_count, map_texts, numbered

BITS, RADIUS, BUCKET = 64, 2, 512
#: Neighbours of a node, two numbers each, that one task may join.
HUB = 100_000
#: Groups of four bits, pivots that are far apart, and levels of keys.
GROUPS, FAR, LEVELS = 16, 16, 3


def fingerprint(text: str | None, words: int = 3) -> int:
    """SimHash of a whole text, as a signed 64-bit integer; 0 if it has no words."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) < words:
        return int(np.uint64(xxhash.xxh64_intdigest(joined, 42)).view(np.int64))
    ends = np.cumsum([len(x) + 1 for x in tokens]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    n = len(tokens) - words + 1
    h = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[words - 1 :].tolist(), strict=True)), "<u8", n)
    return int(majority(h[None, :])[0])


def majority(h: np.ndarray) -> np.ndarray:
    """The SimHash of each row of hashes (unsigned 64-bit), as signed integers: a bit is set if over half of the row's hashes have it."""
    counts = np.zeros((len(h), BITS), np.int64)
    for at in range(0, h.shape[1], 4096):
        part = np.ascontiguousarray(h[:, at : at + 4096], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(*part.shape, 8), axis=2, bitorder="little").sum(1, dtype=np.uint16)
    return np.packbits(2 * counts > h.shape[1], axis=1, bitorder="little").view("<i8")[:, 0]


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text", words: int = 3) -> DataFrame:
    """keep and `fp` (long), one row for each row of docs. Null, empty and wordless texts have fingerprint 0."""
    return map_texts(docs, keep, text_col, lambda: lambda texts: [pa.array([fingerprint(x, words) for x in texts], pa.int64())], "fp long")


def pivots() -> tuple[int, np.ndarray, np.ndarray]:
    """(anchor, near, far): the reference fingerprints, the same in every run.

    near has three for each group of four bits: the anchor with some of the four turned over. Its masks are the first three
    of which the numbers of set bits in common tell all sixteen values of four bits apart.
    """
    spread = np.random.RandomState(7).randint(-(1 << 63), (1 << 63) - 1, FAR + 1, dtype=np.int64)
    told = lambda masks: len({tuple((v & m).bit_count() for m in masks) for v in range(16)}) == 16
    masks = next(c for c in combinations(range(1, 16), 3) if told(c))
    anchor = int(spread[0])
    near = np.array([np.uint64(anchor % (1 << 64)) ^ np.uint64(m << 4 * g) for g in range(GROUPS) for m in masks], np.uint64)
    return anchor, near.view(np.int64), spread[1:]


def distances(fp: Column) -> Column:
    """The row of the pivot distance table for a fingerprint: to the anchor, the near pivots, and the far ones."""
    anchor, near, far = pivots()
    return F.array(*(F.bit_count(fp.bitwiseXOR(F.lit(int(p)))).cast("tinyint") for p in (anchor, *near, *far)))


def _near_in_bucket(fp: np.ndarray, table: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links of one bucket: every fingerprint that has a near one, with the first of its group in the bucket."""
    near = np.ones((len(fp), len(fp)), bool)
    for d in table.T[-4:]:
        near &= np.abs(d[:, None] - d[None, :]) <= radius
    a, b = np.nonzero(np.triu(near, 1))
    for d in table.T[-5::-1]:
        ok = np.abs(d[a] - d[b]) <= radius
        a, b = a[ok], b[ok]
    ok = np.bitwise_count((fp[a] ^ fp[b]).view(np.uint64)) <= radius
    a, b = a[ok], b[ok]
    label = np.arange(len(fp))
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == label).all():
            break
        label = new
    far = np.flatnonzero(label != np.arange(len(fp)))
    return list(zip(fp[far].tolist(), fp[label[far]].tolist(), strict=True))


def _keys(row: Column, parent: Column, open_groups: list[int]) -> list[Column]:
    """For two of four sets of the open groups each: a key of their coordinates, and which groups it leaves open."""
    coordinate = lambda j: F.get(row, 1 + j) - F.get(row, 0)
    sets = [open_groups[i * len(open_groups) // 4 : (i + 1) * len(open_groups) // 4] for i in range(4)]
    out = []
    for k, two in enumerate(combinations(range(4), 2)):
        used = [g for i in two for g in sets[i]]
        left = sum(1 << g for i in range(4) if i not in two for g in sets[i])
        out.append(F.struct(F.xxhash64(parent, F.lit(k), *(coordinate(3 * g + m) for g in used for m in range(3))).alias("key"), F.lit(left).alias("left")))
    return out


def links(fps: DataFrame, radius: int = RADIUS, most: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints `fp` at `radius` or fewer differing bits.

    Not every near pair is returned, but the components of the links are those of all near pairs. Keys of more than
    `most` fingerprints are parted by further coordinates, where near pairs again share one of six keys. Three levels
    leave two groups open, so the last keys hold 256 fingerprints at most, whatever the table holds. Keys are hashes:
    equal hashes of different coordinates only mean that more pairs are looked at.
    """
    if radius != 2:
        raise ValueError("links() is written for radius 2")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [x for fp, row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for x in _near_in_bucket(np.array(fp, np.int64), np.array(row, np.int8), radius)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    table = fps.select("fp", distances(F.col("fp")).alias("row"))
    rows = table.select("fp", "row", F.explode(F.array(*_keys(F.col("row"), F.lit(0), list(range(GROUPS))))).alias("k")).select("fp", "row", "k.*")
    out = None
    for level in range(LEVELS):
        sizes = checkpointed(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"))
        last = level == LEVELS - 1
        few = sizes if last else sizes.filter(F.col("n") <= most)
        buckets = rows.join(few, "key").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("fp", "row"))).alias("m"))
        got = buckets.select(F.col("m.fp").alias("fp"), F.col("m.row").alias("row")).mapInArrow(sift, "a long, b long")
        out = got if out is None else out.union(got)
        many = sizes.filter(F.col("n") > most)
        if last or many.isEmpty():
            break
        crowded = join_by_count(rows, many, ["key"], "n")
        wide = [sum(1 << g for g in x) for x in _open_sets(level)]
        again = F.lit(None).cast("array<struct<key:bigint,left:int>>")
        for x in wide:
            again = F.when(F.col("left") == x, F.array(*_keys(F.col("row"), F.col("key"), [g for g in range(GROUPS) if x >> g & 1]))).otherwise(again)
        rows = checkpointed(crowded.select("fp", "row", F.explode(again).alias("k")).select("fp", "row", "k.*"))
    return out.distinct()


def _open_sets(level: int) -> list[list[int]]:
    """The sets of groups that keys of a level can leave open."""
    now = [list(range(GROUPS))]
    for _ in range(level + 1):
        now = [[g for i in range(4) if i not in two for g in x[i * len(x) // 4 : (i + 1) * len(x) // 4]] for x in now for two in combinations(range(4), 2)]
    return [list(x) for x in sorted({tuple(x) for x in now})]


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node reachable, for each node of the edges (a, b), by star contraction.

    Each round links the larger neighbours of every node to its least neighbour, then the smaller ones; it ends when no
    edge changes. Rounds grow with the logarithm of the longest chain; each is written to the checkpoint folder.
    """
    e = checkpointed(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    state = None
    while True:
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now["n"] == 0 or tuple(now) == state:
            break
        state = tuple(now)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = checkpointed(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n")))
        e = checkpointed(join_by_count(both, least, ["u"], "n", floor=HUB).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = checkpointed(e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        e = join_by_count(e, least, ["u"], "n", floor=HUB).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        e = checkpointed(e.filter("u <> v").distinct())
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def _roots(docs: DataFrame, id_col: str, text_col: str, words: int) -> tuple[DataFrame, DataFrame]:
    """rows: id, th (hash of the text) and fp of each row; of: fp, n (rows) and root, equal for linked fingerprints."""
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("th"), F.col(text_col).alias("text"))
    rows = checkpointed(fingerprints(d, ["id", "th"], "text", words))
    nodes = checkpointed(rows.groupBy("fp").agg(F.count("*").alias("n")))
    linked = components(links(nodes.select("fp")))
    return rows, nodes.join(linked, nodes["fp"] == linked["node"], "left").select("fp", "n", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """id_col, fingerprint (16 hex digits), component_id (least id reachable over links, itself included).

    One row for each row of docs. Equal fingerprints are one node, so copies are never paired. Wordless, empty and null
    texts share fingerprint 0 and are linked like any other. Null ids are never least; a component of null ids only has
    a null component_id. Columns beyond these two are not read, so their names don't matter; no rows give no rows.
    """
    rows, of = _roots(docs, id_col, text_col, words)
    least = rows.groupBy("fp").agg(F.min("id").alias("least")).join(of, "fp")
    named = checkpointed(least.join(least.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "n", "component_id"))
    return join_by_count(rows, named, ["fp"], "n").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """docs with one row for each group of near-duplicates: that of the least id, null ids last. All columns return as they are.

    Rows are told apart by id and text: of rows that agree in both one stays, and rows that share an id but no link all stay.
    """
    rows, of = _roots(docs, id_col, text_col, words)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th"))
    best = rows.groupBy("fp").agg(first.alias("m")).join(of, "fp").groupBy("root").agg(F.min("m").alias("m")).select(F.col("m.id").alias("__id"), F.col("m.th").alias("__th")).distinct()
    flat = numbered(docs)
    own, text = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    th = F.xxhash64(F.coalesce(text, F.lit("")))
    kept = flat.join(best, own.eqNullSafe(F.col("__id")) & (th == F.col("__th")), "left_semi")
    place = Window.partitionBy(own, th).orderBy(F.lit(0))
    return kept.withColumn("__r", F.row_number().over(place)).filter("__r = 1").drop("__r").toDF(*docs.columns)
