"""Removal of runs of lines that occurred earlier, by winnowing over line hashes.

A window starts at each line and ends at the first line that brings it to `words` words or `lines` lines; another ends
at each line and starts at the last line that does so. Both depend on their own lines alone, so a run that is repeated
has equal windows in every copy, and they cover it from its first line to its last. Of each window the line of the least
hash is selected (the last of several): neighbouring windows mostly select the same line, and equal windows select the
same line, so any two places of a run share a fingerprint. Fingerprints that occur once go. Positions of the others are
joined, and each match is extended both ways from the selected line, back and forth over the lines of the windows that
selected it, by hashes of what lies there. All but the first place of equal stretches have their lines removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscope.llm.common import checkpointed, join_by_count, numbered

LINES, WORDS = 4, 50


def minima_of(text: str, lines: int, words: int) -> list[tuple[int, int, list[tuple[int, int, int]]]]:
    """(line, fingerprint, windows) of each selected line; a window is (start, end, hash of its lines), end exclusive.

    Blank lines neither start nor count.
    """
    rows = text.split("\n")
    keep = [i for i, x in enumerate(rows) if x.strip()]
    if not keep:
        return []
    data = [rows[i].strip().encode("utf-8", "surrogatepass") for i in keep]
    h = [xxhash.xxh64_intdigest(x, 1) for x in data]
    count = [len(x.split()) for x in data]
    before = np.r_[0, np.cumsum(count)].tolist()
    ranges, end = set(), 0
    for a in range(len(keep)):
        while end < len(keep) and before[end] - before[a] < words and end - a < lines:
            end += 1
        if before[end] - before[a] < words and end - a < lines:
            break
        ranges.add((a, end))
    start = 0
    for end in range(1, len(keep) + 1):
        while before[end] - before[start + 1] >= words or end - start - 1 >= lines:
            start += 1
        if before[end] - before[start] >= words or end - start >= lines:
            ranges.add((start, end))
    selected: dict[int, list[tuple[int, int, int]]] = {}
    for a, e in sorted(ranges):
        least = min(range(a, e), key=lambda i: (h[i], -i))
        selected.setdefault(least, []).append((keep[a], keep[e - 1] + 1, xxhash.xxh64_intdigest(np.array([least - a, *h[a:e]], "<u8").tobytes(), 2)))
    return [(keep[i], h[i], windows) for i, windows in selected.items()]


def _signed(x: list[int]) -> pa.Array:
    return pa.array(np.array(x, np.uint64).view(np.int64), pa.int64())


def repeated_windows(docs: DataFrame, id_col: str, text_col: str, lines: int = LINES, words: int = WORDS, null_ids: bool = False) -> DataFrame:
    """id, th (hash of the text), a and e (lines a to e - 1) of every window that occurred earlier.

    Earlier: a smaller id, or the same id and a smaller line; with null_ids rows without an id count too, as the last.
    Of rows that agree in id and text each counts alike. A fingerprint or stretch that many places share is joined by
    a broadcast, so no task gets all its places.
    """
    window = pa.struct([("a", pa.int32()), ("e", pa.int32()), ("g", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                row, f, ends, a, e, g = [], [], [0], [], [], []
                for i, x in enumerate(b.column(2).to_pylist()):
                    for _, print_, windows in minima_of(x or "", lines, words):
                        row.append(i), f.append(print_)
                        for w in windows:
                            a.append(w[0]), e.append(w[1]), g.append(w[2])
                        ends.append(len(a))
                take = pa.array(row, pa.int64())
                around = pa.StructArray.from_arrays([pa.array(a, pa.int32()), pa.array(e, pa.int32()), _signed(g)], fields=list(window))
                yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), _signed(f), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), around)], names=["id", "th", "f", "around"])

    kind = docs.schema[id_col].dataType.simpleString()
    d = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("th"), F.col(text_col).alias("t")).filter("t is not null")
    d = d if null_ids else d.filter("id is not null")
    w = checkpointed(d.mapInArrow(run, f"id {kind}, th long, f long, around array<struct<a:int,e:int,g:long>>"))
    again = checkpointed(w.groupBy("f").agg(F.count("*").alias("n")).filter("n > 1"))
    met = checkpointed(join_by_count(w, again, ["f"], "n").select("id", "th", F.explode("around").alias("x")).select("id", "th", "x.*"))
    place = F.struct(F.col("id").isNull(), "id", "th", "a")
    first = checkpointed(met.groupBy("g").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1"))
    return join_by_count(met, first, ["g"], "n").filter(place > F.col("first")).select("id", "th", "a", "e")


def free_name(name: str, taken: list[str]) -> str:
    """name, or name_1, name_2 and so on: the first that is not taken."""
    low = {x.lower() for x in taken}
    return next(x for x in (name, *(f"{name}_{i}" for i in range(1, len(taken) + 2))) if x.lower() not in low)


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines: int = LINES, words: int = WORDS, null_ids: bool = False) -> DataFrame:
    """docs with later copies of runs of lines removed from text_col, and a count of removed lines (long) added.

    The count is the last column, named removed_lines, or removed_lines_1 and so on where docs has that name already.
    A run counts from `lines` lines or `words` words on (blank lines aside, which go with a window around them; lines compare without outer blanks). Its
    first place, by id and then line, stays; where a document repeats itself all but the first window go, too. Texts
    without a repeated run stay exactly as they are; null texts are left alone. Null ids are left alone and are no first
    places, unless null_ids is set: then they come after all ids and lose their repeats. A text may become empty. Of rows
    that agree in id and text, each loses the same lines. Other columns pass through, whatever their names.
    """
    flat = numbered(docs)
    at = docs.columns.index(text_col)
    own, text = F.col(f"c{docs.columns.index(id_col)}"), F.col(f"c{at}")
    gone = repeated_windows(docs, id_col, text_col, lines, words, null_ids)
    spans = gone.groupBy("id", "th").agg(F.collect_set(F.struct("a", "e")).alias("spans"))
    joined = flat.join(spans, own.eqNullSafe(F.col("id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("th")), "left")
    cut = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["a"], s["e"] - 1))))
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size("rows") - 1), cut), lambda i: F.get(F.col("rows"), i)), "\n")
    out = joined.withColumn("rows", F.split(text, "\n", -1)).withColumn("new", F.when(F.col("spans").isNull(), text).otherwise(kept))
    count = F.when(F.col("spans").isNull(), 0).otherwise(F.size(cut)).cast("long")
    return out.select(*(F.col("new") if i == at else F.col(c) for i, c in enumerate(flat.columns)), count).toDF(*docs.columns, free_name("removed_lines", docs.columns))
