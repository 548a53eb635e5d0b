"""Packing of whole documents into as few sequences as can be: dominance reduction, then best fit.

Documents longer than a sequence are cut into full sequences and a rest; nothing else is cut. The pieces' lengths, at most
`window` different ones, are counted, and everything is decided on these counts, for many sequences at once:

1. Dominance (Martello and Toth): a filling that contains a piece j is fixed for good if any other that contains j could be
   exchanged for it. With k the longest piece that fits beside j:
   - nothing fits beside j: j alone;
   - no set of pieces that fits beside j is longer than k: j and k, since any such set fits into k's place. A bitset of the
     sums that the remaining lengths can make decides this for sets of all sizes;
   - no three pieces fit beside j, and of any two that do, together longer than k, the shorter one is no longer than b, the
     longest piece that fits beside j and k: j, k and b.
   Fixing goes on, longest pieces first, until a whole pass fixes nothing.
2. Best fit, longest pieces first, for what remains: a piece goes to the sequence with the least room that holds it.

A piece's place follows from its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscope.llm.common import bucketed_rank, checkpointed, map_texts
from firmscope.llm.encode import encoder

WINDOW = 2048


def _sum_between(counts: dict[int, int], low: int, high: int) -> bool:
    """Whether some of the lengths, each up to its count, add up to more than low and at most high."""
    if high <= low:
        return False
    mask, wanted, reach = (1 << high + 1) - 1, ((1 << high - low) - 1) << low + 1, 1
    for size in sorted((x for x in counts if x <= high), reverse=True):
        left, take = min(counts[size], high // size), 1
        while left > 0:  # binary splitting of the count
            take = min(take, left)
            reach |= reach << size * take & mask
            left, take = left - take, take * 2
        if reach & wanted:
            return True
    return False


def dominant(counts: dict[int, int], j: int, window: int = WINDOW) -> tuple[int, ...] | None:
    """A filling with j that dominates every other filling with j, longest pieces first; None where none is known."""
    rest = {k: n - (k == j) for k, n in counts.items() if n > (k == j)}
    room, sizes = window - j, sorted(rest)
    fitting = sizes[: bisect_right(sizes, room)]
    if not fitting:
        return (j,)
    k = fitting[-1]
    if not _sum_between(rest, k, room):
        return (j, k)
    least, three = 0, 3
    for x in fitting:  # the three shortest pieces
        take = min(three, rest[x])
        least, three = least + take * x, three - take
    if not three and least <= room:
        return None
    others = {x: n - (x == k) for x, n in rest.items() if n > (x == k)}
    b = max((x for x in others if x <= room - k), default=0)
    for y in fitting[bisect_right(fitting, b) :]:  # the shorter one of two, longer than b
        most = max((x for x in fitting[bisect_left(fitting, y) : bisect_right(fitting, room - y)] if x > y or rest[x] > 1), default=0)
        if most and most + y > k:
            return None
    return (j, k, b) if b else (j, k)


def reduce(counts: dict[int, int], window: int = WINDOW) -> tuple[list[tuple[int, tuple[int, ...]]], dict[int, int]]:
    """(times, lengths) of the fillings that dominance fixes, and the counts that remain.

    Fewer pieces only leave fewer alternatives, so a filling is fixed as often as its longest fitting pieces last.
    """
    left, fixed, again = {k: n for k, n in counts.items() if n > 0}, [], True
    while again and left:
        again = False
        for j in sorted(left, reverse=True):
            while left.get(j) and (found := dominant(left, j, window)):
                times = min(left[x] // found.count(x) for x in found)
                fixed.append((times, found))
                for x in found:
                    left[x] -= times
                    if not left[x]:
                        del left[x]
                again = True
    return fixed, left


def best_fit(counts: dict[int, int], window: int = WINDOW) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(length, pieces, of them to each sequence, first sequence, offset) of every run of equal places, and how many sequences.

    Sequences of the same history are one range, so the steps depend on the number of lengths, not of pieces.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # room: ranges (first, how many)
    runs, opened = [], 0
    for size in sorted(counts, reverse=True):
        left = counts[size]
        for r in sorted(x for x in room if x >= size):
            each = r // size
            while left and room.get(r):
                first, n = room[r].pop()
                use = min(n, left // each)
                if use:
                    runs.append((size, use * each, each, first, window - r))
                    room.setdefault(r - each * size, []).append((first, use))
                    left -= use * each
                if use < n and left:  # the last pieces, fewer than a sequence takes
                    runs.append((size, left, left, first + use, window - r))
                    room.setdefault(r - left * size, []).append((first + use, 1))
                    use, left = use + 1, 0
                if use < n:
                    room[r].append((first + use, n - use))
        each = window // size
        if left >= each:
            runs.append((size, left - left % each, each, opened, 0))
            room.setdefault(window - each * size, []).append((opened, left // each))
            opened, left = opened + left // each, left % each
        if left:
            runs.append((size, left, left, opened, 0))
            room.setdefault(window - left * size, []).append((opened, 1))
            opened += 1
    return runs, opened


def places(counts: dict[int, int], window: int = WINDOW) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, pieces to each sequence, first sequence, offset), by length and rank, and how many sequences."""
    fixed, left = reduce(counts, window)
    taken: dict[int, int] = {}
    table, opened = [], 0

    def add(size: int, pieces: int, each: int, first: int, offset: int) -> None:
        low = taken.get(size, 0)
        table.append((size, low, each, first, offset))
        taken[size] = low + pieces

    for times, sizes in fixed:
        at = 0
        for size in sorted(set(sizes), reverse=True):
            n = sizes.count(size)
            add(size, times * n, n, opened, at)
            at += size * n
        opened += times
    runs, more = best_fit(left, window)
    for size, pieces, each, first, offset in runs:
        add(size, pieces, each, opened + first, offset)
    return np.array(sorted(table), np.int64).reshape(-1, 5), opened + more


def pack_whole(docs: DataFrame, vocab: str, window: int = WINDOW, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: id_col, piece, start, length, ids_crc32, sequence_id, offset; whole texts are encoded.

    A null or empty text is its end_id alone. Only documents longer than `window` are cut, into pieces of `window` ids and
    a last one. Pieces of a sequence lie end to end from 0. Repeated rows and null ids are packed like any other row; other
    columns are not read; no rows give no pieces. The driver sees the counts of at most `window` lengths.
    """
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("th"), F.col(text_col).alias("t"))
    mark = np.array([end_id], "<u4").tobytes()
    kind = pa.list_(pa.struct([("piece", pa.int32()), ("length", pa.int32()), ("crc", pa.int64())]))

    def make():
        encode = encoder(vocab)

        def work(texts):
            out = []
            for ids in encode(texts):
                ids += mark
                cut = [ids[a : a + 4 * window] for a in range(0, len(ids), 4 * window)]
                out.append([{"piece": i, "length": len(x) // 4, "crc": zlib.crc32(x)} for i, x in enumerate(cut)])
            return [pa.array(out, kind)]

        return work

    pieces = map_texts(d, ["id", "th"], "t", make, "pieces array<struct<piece:int,length:int,crc:long>>").select("id", "th", F.explode("pieces").alias("p")).select("id", "th", "p.*")
    pieces = checkpointed(pieces.withColumn("u", F.monotonically_increasing_id()))  # tells repeated rows apart; fixed by the checkpoint
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `window` rows
    held = pieces.sparkSession.sparkContext.broadcast(places(counts, window)[0])  # a few rows for each length
    ranked = bucketed_rank(pieces, "length", ["id", "th", "piece", "u"]).select("id", "piece", "length", "crc", "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for b in batches:
            size, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            row = np.zeros((len(size), 5), np.int64)
            for s in np.unique(size):
                own = size == s
                lo, hi = np.searchsorted(table[:, 0], [s, s + 1])
                row[own] = table[lo + np.searchsorted(table[lo:hi, 1], rank[own], "right") - 1]
            k = rank - row[:, 1]
            added = [row[:, 3] + k // np.maximum(row[:, 2], 1), row[:, 4] + k % np.maximum(row[:, 2], 1) * size]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "piece", "length", "crc")), *map(pa.array, added)], names=["id", "piece", "length", "crc", "sequence_id", "offset"])

    placed = ranked.mapInArrow(place, f"id {d.schema['id'].dataType.simpleString()}, piece int, length int, crc long, sequence_id long, offset long")
    start = F.col("piece").cast("long") * window
    return placed.select(F.col("id").alias(id_col), "piece", start.alias("start"), F.col("length").cast("long").alias("length"), F.col("crc").alias("ids_crc32"), "sequence_id", "offset")
