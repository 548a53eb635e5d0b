"""Packing of token ids into sequences by minimum bin slack.

Documents are cut into full windows and a remainder. The remainders' lengths, fewer than `window`, are counted; each
window is then filled from these counts by the subset of lengths that comes closest to its capacity, found with a bitset
of reachable sums and traced back to counts per length. A filling is used as often as the counts allow, so the number
of fillings depends on the number of lengths, not of documents. What no subset fills is cut: laid end to end and dealt
to windows, the last of them split into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscope.llm.common import bucketed_rank, checkpointed, map_texts
from firmscope.llm.encode import encoder

WINDOW, SLACK = 4096, 4
#: Documents with pieces to cut (id and hash) that are broadcast; more of them are joined by a shuffle.
BROADCAST_DOCS = 20_000


def fill(counts: dict[int, int], capacity: int) -> tuple[int, dict[int, int]]:
    """The largest sum of at most `capacity` that the lengths, each up to its count, can make, and how many of each.

    Longer lengths enter the bitset first; it ends as soon as the capacity itself is reachable.
    """
    mask, reach, steps = (1 << capacity + 1) - 1, 1, []
    for size in sorted((x for x in counts if x <= capacity and counts[x] > 0), reverse=True):
        most, new, take = min(counts[size], capacity // size), reach, 1
        while most > 0:  # binary splitting of the count
            take = min(take, most)
            new |= new << size * take & mask
            most, take = most - take, take * 2
        steps.append((size, reach))
        reach = new
        if reach >> capacity & 1:
            break
    best = at = reach.bit_length() - 1
    used: dict[int, int] = {}
    for size, before in reversed(steps):
        n = 0
        while not before >> at & 1:
            at, n = at - size, n + 1
        if n:
            used[size] = n
    return best, used


def fillings(counts: dict[int, int], window: int = WINDOW, slack: int = SLACK) -> tuple[list[tuple[int, dict[int, int]]], dict[int, int]]:
    """(times, lengths) of each filling that leaves at most `slack` free, and the counts that are left over.

    The longest length left always takes part; the others fill what it leaves.
    """
    left, out = {k: v for k, v in counts.items() if v > 0}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        best, used = fill(left, window - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        if best + longest < window - slack:
            # no use of the longest fills a window: it is cut
            out.append((0, {longest: left.pop(longest)}))
            continue
        times = min(left[k] // n for k, n in used.items())
        out.append((times, used))
        for k, n in used.items():
            left[k] -= times * n
            if not left[k]:
                del left[k]
    rest: dict[int, int] = {}
    for times, used in out:
        if not times:
            for k, n in used.items():
                rest[k] = rest.get(k, 0) + n
    return [x for x in out if x[0]], rest


def pack(docs: DataFrame, vocab: str, window: int = WINDOW, end_id: int = 2, slack: int = SLACK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset; whole texts are encoded.

    A null or empty text is its end_id alone. Every id of every row lies in one piece; pieces of a sequence lie end to end
    from 0; at most `slack` of a full sequence is free. Repeated rows and null ids are packed like any other row. Other
    columns are not read; no rows give no pieces. The counts that the driver sees have at most `window` rows.
    """
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("th"), F.col(text_col).alias("t"))
    mark = np.array([end_id], "<u4").tobytes()
    kind = "pieces array<struct<start:long,length:long,crc:long>>, doc_tokens long"

    def make():
        encode = encoder(vocab)

        def work(texts):
            ids = [b + mark for b in encode(texts)]
            cut = [[{"start": a // 4, "length": min(window, (len(b) - a) // 4), "crc": zlib.crc32(b[a : a + 4 * window])} for a in range(0, len(b), 4 * window)] for b in ids]
            return [pa.array(cut, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64())]))), pa.array([len(b) // 4 for b in ids], pa.int64())]

        return work

    pieces = map_texts(d, ["id", "th"], "t", make, kind).select("id", "th", "doc_tokens", F.explode("pieces").alias("p")).select("id", "th", "doc_tokens", "p.*")
    pieces = checkpointed(pieces.withColumn("u", F.monotonically_increasing_id()))  # tells repeated rows apart; fixed by the checkpoint
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `window` rows
    full = counts.pop(window, 0)
    used, rest = fillings(counts, window, slack)

    # places: for each length, ranks from `low` on go to a filling, n of them to each of its sequences from `seq` on
    table: list[tuple[int, int, int, int, int]] = [(window, 0, 1, 0, 0)] if full else []
    taken: dict[int, int] = {}
    seq = full
    for times, sizes in used:
        at = 0
        for size, n in sizes.items():
            low = taken.get(size, 0)
            table.append((size, low, n, seq, at))
            taken[size] = low + times * n
            at += size * n
        seq += times
    table.sort()
    tail: dict[int, tuple[int, int]] = {}  # length: first rank that is cut, and where it begins in what is laid end to end
    total = 0
    for size in sorted(rest):
        tail[size] = (taken.get(size, 0), total)
        total += size * rest[size]
    held = pieces.sparkSession.sparkContext.broadcast((np.array(table, np.int64).reshape(-1, 5), tail))

    ranked = bucketed_rank(pieces, "length", ["id", "th", "start", "u"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, cut = held.value
        for b in batches:
            size, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.full(len(size), -1, np.int64)
            for s in np.unique(size):
                lo, hi = np.searchsorted(t[:, 0], [s, s + 1])
                own = size == s
                if hi > lo:
                    at[own] = lo + np.searchsorted(t[lo:hi, 1], rank[own], "right") - 1
                if s in cut:
                    at[own & (rank >= cut[s][0])] = -1
            row = t[at] if len(t) else np.zeros((len(size), 5), np.int64)
            k = rank - row[:, 1]
            n = np.maximum(row[:, 2], 1)
            whole = at >= 0
            seq_id, offset = np.where(whole, row[:, 3] + k // n, -1), np.where(whole, row[:, 4] + (k % n) * size, 0)
            laid = np.array([-1 if w else cut[s][1] + (r - cut[s][0]) * s for w, s, r in zip(whole.tolist(), size.tolist(), rank.tolist(), strict=True)], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("id", "th", "start", "length", "crc", "doc_tokens")] + [pa.array(seq_id), pa.array(offset), pa.array(laid)], names=names)

    names = ["id", "th", "start", "length", "crc", "doc_tokens", "sequence_id", "offset", "laid"]
    id_kind = d.schema["id"].dataType.simpleString()
    placed = ranked.select("id", "th", "start", "length", "crc", "doc_tokens", "rank").mapInArrow(place, f"id {id_kind}, th long, start long, length long, crc long, doc_tokens long, sequence_id long, offset long, laid long")
    placed = checkpointed(placed)
    columns = [F.col("id").alias(id_col), "start", "length", F.col("crc").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"]
    done = placed.filter("laid < 0").select(columns)
    if not total:
        return done

    # what is cut: encoded once more, for the checksums of the new pieces
    last = total - total % window
    marks, s = [last], last
    for bit in reversed(range(window.bit_length())):
        if (total % window) >> bit & 1:
            s += 1 << bit
            marks.append(s)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocab)
        for whole in batches:
            for lo in range(0, whole.num_rows, 500):
                b = whole.slice(lo, 500)
                out: list[list] = [[] for _ in range(8)]
                texts = encode(b.column("t").to_pylist())
                for i, (ids, start, length, laid, n) in enumerate(zip(texts, *(b.column(c).to_pylist() for c in ("start", "length", "laid", "doc_tokens")), strict=True)):
                    ids += mark
                    a = laid
                    while a < laid + length:
                        if a < last:
                            begin, end, number = a - a % window, a - a % window + window, seq + a // window
                        else:
                            k = int(np.searchsorted(marks, a, "right"))
                            begin, end, number = marks[k - 1], marks[k], seq + last // window + k - 1
                        e = min(end, laid + length)
                        x = start + a - laid
                        for c, v in zip(out, (i, x, e - a, zlib.crc32(ids[4 * x : 4 * (x + e - a)]), n, number, a - begin, 0), strict=True):
                            c.append(v)
                        a = e
                yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(out[0], pa.int64()))] + [pa.array(c, pa.int64()) for c in out[1:7]], names=["id", "start", "length", "crc", "doc_tokens", "sequence_id", "offset"])

    loose = placed.filter("laid >= 0").select("id", "th", "start", "length", "doc_tokens", "laid")
    keys = checkpointed(loose.select(F.col("id").alias("i"), F.col("th").alias("h")).distinct())
    if keys.count() <= BROADCAST_DOCS:
        keys = F.broadcast(keys)
    texts = d.join(keys, F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("h")), "left_semi").dropDuplicates(["id", "th"]).withColumnsRenamed({"id": "i", "th": "h"})
    again = loose.join(texts, F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("h"))).select("id", "start", "length", "doc_tokens", "laid", "t")
    more = again.mapInArrow(split, f"id {id_kind}, start long, length long, crc long, doc_tokens long, sequence_id long, offset long").select(columns)
    return done.unionByName(more)
