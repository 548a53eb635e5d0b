"""Merkle manifest of a table: leaves by group in order of their ids, a root, a proof for each row, and its check.

A row's place in its group is found without a sort of all rows. Its id, its leaf's digest and a serial number are written
as digits of a radix key; rows are counted by prefixes of that key, deep enough that no prefix has many rows, and the
counts of the prefixes before, level by level, give each prefix its first place. The place, in digits to the base of the
fanout, is the leaf's key in the trie of nodes: nodes of a common prefix are siblings. A task reduces all levels under one
prefix of a bounded number of nodes, longest prefixes first, so a few shuffles reach the root whatever the fanout. On the
way down again each such task hands its nodes the siblings that their proofs need.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmscope.llm.common import checkpointed

FANOUT = 2
#: Rows of a prefix of the radix key, and nodes that one task call reduces, at most.
CELL, BLOCK = 1024, 1024
#: Hex digits: null or not, id, digest (the last of these takes the rest of it) and serial number.
ROW_WIDTHS = [2, *[2] * 8, 2, 2, 2, 58, *[2] * 8]
NAME_WIDTHS = [*[2] * 16, 1 << 30]
PATH = "array<struct<before:array<string>,after:array<string>>>"
_path = pa.list_(pa.struct([("before", pa.list_(pa.string())), ("after", pa.list_(pa.string()))]))


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(fields: list[Column]) -> Column:
    """SHA-256 in lowercase hex of the fields in order: `-` for null, else bytes in UTF-8, a colon and the value."""
    text = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text)), 256)


def ranks(rows: DataFrame, widths: list[int]) -> DataFrame:
    """rows (g, key and any others; key unique in its g) with `rank`, the place of key among those of the same g, from 0.

    key is a string of digits of the given widths; digits that are the same in all rows are left out. Prefixes are taken
    one digit longer until none has more than CELL rows, so neither a prefix's rows nor a prefix's next digits are many.
    """
    starts = [1 + sum(widths[:i]) for i in range(len(widths))]
    digits = [F.substring("key", a, w) for a, w in zip(starts, widths, strict=True)]
    seen = rows.agg(F.count("*").alias("n"), *(F.struct(F.min(d).alias("a"), F.max(d).alias("b")).alias(f"d{i}") for i, d in enumerate(digits))).first()
    used = [i for i in range(len(widths)) if seen["n"] and seen[f"d{i}"]["a"] != seen[f"d{i}"]["b"]]
    if not used:  # no key differs: one row in each g at most
        return rows.withColumn("rank", F.lit(0).cast("long"))
    ends = [sum(widths[i] for i in used[: k + 1]) for k in range(len(used))]
    keyed = rows.withColumn("__key", F.concat(*(digits[i] for i in used)))
    depth = next((k for k in range(len(used)) if 256 ** (k + 1) * CELL >= seen["n"]), len(used) - 1)
    while True:
        cells = checkpointed(keyed.groupBy("g", F.substring("__key", 1, ends[depth]).alias("p")).agg(F.count("*").alias("n")))
        if depth == len(used) - 1 or cells.agg(F.max("n")).first()[0] <= CELL:
            break
        depth += 1
    first = None
    for k in range(depth + 1):
        level = cells.groupBy("g", F.substring("p", 1, ends[k]).alias("p")).agg(F.sum("n").alias("n")) if k < depth else cells
        level = level.withColumn("up", F.substring("p", 1, ends[k - 1]) if k else F.lit(""))
        base = F.lit(0) if first is None else F.col("base")
        level = level if first is None else level.join(first.withColumnRenamed("p", "up"), ["g", "up"])
        first = level.select("g", "p", (base + F.sum("n").over(Window.partitionBy("g", "up").orderBy("p")) - F.col("n")).alias("base"))
    p = F.substring("__key", 1, ends[depth])
    placed = keyed.withColumn("p", p).withColumn("__r", F.row_number().over(Window.partitionBy("g", "p").orderBy("__key")) - 1)
    return placed.join(first, ["g", "p"]).withColumn("rank", (F.col("base") + F.col("__r")).cast("long")).drop("p", "base", "__r", "__key")


def _levels(nodes: list[str], depth: int, fanout: int, alone: bool) -> list[list[str]]:
    """The nodes and those above them, `depth` levels up; alone: up to the first level of a single node."""
    out = [nodes]
    for _ in range(depth):
        if alone and len(out[-1]) == 1:
            break
        out.append([digest(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def _siblings(levels: list[list[str]], at: int, fanout: int) -> list[dict[str, list[str]]]:
    """What stands before and after the node `at` and each one above it, in their runs."""
    out = []
    for level in levels[:-1]:
        low = at - at % fanout
        out.append({"before": level[low:at], "after": level[at + 1 : low + fanout]})
        at //= fanout
    return out


def fold(node: str, path: list[dict[str, list[str]]]) -> str:
    for level in path:
        node = digest(*level["before"], node, *level["after"])
    return node


def _block(fanout: int) -> int:
    """Levels that one task call reduces."""
    depth = 1
    while fanout ** (depth + 1) <= BLOCK:
        depth += 1
    return depth


def _ordered(t: pa.Table) -> pa.Table:
    return t.sort_by("rank")


def reduced(nodes: DataFrame, fanout: int) -> list[DataFrame]:
    """The nodes (g, rank, node), those of every few levels above them, and last one of each g."""
    depth = _block(fanout)
    size = fanout**depth
    stages = [nodes]
    while (stages[-1].agg(F.max("rank")).first()[0] or 0) > 0:

        def up(key: tuple, t: pa.Table) -> pa.Table:
            g, b = (x.as_py() for x in key)
            top = _levels(_ordered(t).column("node").to_pylist(), depth, fanout, b == 0)[-1][0]
            return pa.table({"g": pa.array([g], pa.string()), "rank": pa.array([b], pa.int64()), "node": pa.array([top], pa.string())})

        below = stages[-1].select("g", "rank", "node", F.floor(F.col("rank") / size).cast("long").alias("b"))
        stages.append(checkpointed(below.groupBy("g", "b").applyInArrow(up, "g string, rank long, node string")))
    return stages


def _down(nodes: DataFrame, above: DataFrame, fanout: int, columns: list[str], emit: Callable, schema: str) -> DataFrame:
    """emit(nodes, own paths, the row above) for all nodes of one row above them.

    nodes: g, rank, node and columns; above: g, rank (the prefix of the nodes' ranks), path, subroot, root.
    """
    depth = _block(fanout)

    def run(key: tuple, t: pa.Table, up: pa.Table) -> pa.Table:
        t, b = _ordered(t), key[1].as_py()
        levels = _levels(t.column("node").to_pylist(), depth, fanout, b == 0)
        return emit(t, [_siblings(levels, i, fanout) for i in range(t.num_rows)], up.to_pylist()[0])

    left = nodes.select("g", "rank", "node", *columns, F.floor(F.col("rank") / fanout**depth).cast("long").alias("b"))
    right = above.select("g", F.col("rank").alias("b"), "path", "subroot", "root")
    return left.groupBy("g", "b").cogroup(right.groupBy("g", "b")).applyInArrow(run, schema)


def _paths(stages: list[DataFrame], above: DataFrame, fanout: int) -> DataFrame:
    """g, rank, path, subroot, root of the nodes of the first stage; above has them for those of the last."""

    def emit(t: pa.Table, own: list, up: dict) -> pa.Table:
        n = t.num_rows
        return pa.table({"g": t.column("g"), "rank": t.column("rank"), "path": pa.array([p + up["path"] for p in own], _path), "subroot": pa.array([up["subroot"]] * n, pa.string()), "root": pa.array([up["root"]] * n, pa.string())})

    for nodes in reversed(stages[:-1]):
        above = checkpointed(_down(nodes, above, fanout, [], emit, f"g string, rank long, path {PATH}, subroot string, root string"))
    return above


def manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "lang", fanout: int = FANOUT, claims: dict[str, Column] | None = None, siblings: bool = False) -> DataFrame:
    """One row a row: id_col, group_col, place, leaf, subroot, root, proof_sha256, folded_root, verified (and siblings).

    The leaf is leaf(fields). In each group leaves ascend by id_col (an integer), null ids first, rows of one id by their
    leaves; every `fanout` consecutive nodes, fewer in the last run, become the digest of their digests until one is left,
    the subroot. The subroots, null group first and the others in order of their UTF-8 bytes, give the root likewise.
    siblings: array of struct(before, after), the other nodes of the row's run on each level up to the root; proof_sha256
    is the digest of all of them. folded_root is what these and the row's claimed leaf give; claims replace columns by
    what is to be checked, by default nothing, and verified tells whether folded_root is the root.

    Equal rows have a place each. A table without rows has no manifest: no rows. Columns beyond those named aren't read.
    """
    changed = claims or {}
    f = docs.select(F.col(id_col).cast("long").alias("id"), F.col(group_col).cast("string").alias("grp"), leaf([F.col(c) for c in fields]).alias("node"), F.when(F.lit(False) if not changed else _differs(docs, changed), leaf([changed.get(c, F.col(c)) for c in fields])).alias("claimed"))
    rows = checkpointed(f.withColumn("u", F.monotonically_increasing_id()))  # the serial number is fixed by the checkpoint
    name = lambda c: F.coalesce(F.concat(F.lit("x"), c), F.lit(""))  # noqa: E731  null first, then by bytes
    wide = lambda c: F.lpad(F.hex(c), 16, "0")
    signed = F.col("id").bitwiseXOR(F.lit(-(1 << 63)))
    key = F.concat(F.when(F.col("id").isNull(), "00").otherwise("01"), F.coalesce(wide(signed), F.lit("0" * 16)), "node", wide(F.col("u")))
    leaves = checkpointed(ranks(rows.withColumn("g", name(F.col("grp"))).withColumn("key", key), ROW_WIDTHS).select("g", "rank", "node", "claimed", "id", "grp"))

    stages = reduced(leaves, fanout)
    subroots = stages[-1].select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("node"))
    groups = checkpointed(ranks(subroots.withColumn("key", F.hex("name")), NAME_WIDTHS).select("g", "rank", "node", "name"))
    tops = reduced(groups, fanout)
    empty = F.array().cast(PATH)
    above = tops[-1].select("g", "rank", empty.alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("node").alias("root"))
    of_group = groups.join(_paths(tops, above, fanout).select("rank", "path", "root"), "rank")
    above = of_group.select(F.col("name").alias("g"), F.lit(0).cast("long").alias("rank"), "path", F.col("node").alias("subroot"), "root")
    if len(stages) > 1:
        above = _paths(stages[1:], above, fanout)

    def emit(t: pa.Table, own: list, up: dict) -> pa.Table:
        flat = lambda path: [x for level in path for x in (*level["before"], *level["after"])]
        rest, ends, done = "".join(flat(up["path"])), {}, []
        for node, claimed, path in zip(t.column("node").to_pylist(), t.column("claimed").to_pylist(), own, strict=True):
            top = fold(claimed or node, path)
            if top not in ends:
                ends[top] = fold(top, up["path"])
            done.append((digest(*flat(path), rest), ends[top]))
        n = t.num_rows
        out = {"id": t.column("id"), "grp": t.column("grp"), "place": t.column("rank"), "leaf": t.column("node")}
        out |= {"subroot": pa.array([up["subroot"]] * n, pa.string()), "root": pa.array([up["root"]] * n, pa.string())}
        out |= {"proof_sha256": pa.array([x[0] for x in done], pa.string()), "folded_root": pa.array([x[1] for x in done], pa.string())}
        return pa.table(out | ({"siblings": pa.array([p + up["path"] for p in own], _path)} if siblings else {}))

    schema = "id long, grp string, place long, leaf string, subroot string, root string, proof_sha256 string, folded_root string" + (f", siblings {PATH}" if siblings else "")
    out = _down(leaves, above, fanout, ["claimed", "id", "grp"], emit, schema)
    more = ["siblings"] if siblings else []
    return out.select(F.col("id").alias(id_col), F.col("grp").alias(group_col), "place", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), *more)


def _differs(docs: DataFrame, claims: dict[str, Column]) -> Column:
    out = F.lit(False)
    for c, claim in claims.items():
        out = out | ~claim.cast("string").eqNullSafe(F.col(c).cast("string"))
    return out
