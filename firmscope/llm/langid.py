"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscope.llm.common import map_texts

BITS, ORDERS, PER_LANG = 16, (1, 2, 3), 20_000
#: Languages that a model may have: each takes 512 kB on the driver and 256 kB in the broadcast. More are an error.
MOST_LANGS = 500
#: Letters of a text that are cut into n-grams at once, and slots of texts that are scored at once.
BLOCK, TOGETHER = 1 << 20, 1 << 19
_rest = re.compile(r"[\W\d_]+").sub


def grams(text: str, bits: int = BITS, orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """Slots of all character n-grams of a whole text, lower-cased, anything but letters as one blank."""
    return _slots(f" {_rest(' ', text.lower()).strip()} ", bits, orders)


def _slots(letters: str, bits: int, orders: tuple[int, ...]) -> np.ndarray:
    c = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    out = []
    for n in orders:
        if len(c) >= n:
            h = np.full(len(c) - n + 1, n, np.uint64)
            for i in range(n):
                h = (h ^ c[i : len(c) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            out.append((h >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def gram_counts(text: str, bits: int = BITS, orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """How often each slot occurs among grams(text); a long text is taken in blocks of BLOCK letters."""
    letters = f" {_rest(' ', text.lower()).strip()} "
    total = np.zeros(1 << bits, np.int64)
    for at in range(0, len(letters), BLOCK):
        for n in orders:  # grams that begin in this block
            total += np.bincount(_slots(letters[at : at + BLOCK + n - 1], bits, (n,)), minlength=1 << bits)
    return total


def fit(examples: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text", per_lang: int = PER_LANG) -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and their log-probabilities (slots x languages), add-one smoothed, plus a last row of priors.

    Learnt from about per_lang whole documents of each language, chosen by a hash of the id; priors from all of them.
    Rows with null text, language or id take no part. Slots are summed by Spark: a row for each language and 1,024 slots.
    More than MOST_LANGS languages are an error, not a cut.
    """
    rows = examples.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    found = rows.groupBy(F.col(lang_col).alias("l")).agg(F.count("*").alias("n")).limit(MOST_LANGS + 1).collect()
    if len(found) > MOST_LANGS:
        raise ValueError(f"over {MOST_LANGS} languages")
    counts = {r["l"]: r["n"] for r in found}
    if not counts:
        return [], np.zeros(((1 << BITS) + 1, 0))
    langs = sorted(counts)
    share = F.lit(0)
    for lang in langs:
        share = F.when(F.col(lang_col) == lang, int(1e6 * min(1.0, per_lang / counts[lang]))).otherwise(share)
    chosen = rows.filter(F.pmod(F.xxhash64(F.lit("language"), F.col(id_col)), F.lit(1_000_000)) < share).select(F.col(lang_col).alias("l"), F.col(text_col).alias("t"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if lang not in total:
                    total[lang] = np.zeros(1 << BITS, np.int64)
                total[lang] += gram_counts(text)
        for lang, c in total.items():
            blocks = c.reshape(-1, 1024)
            used = np.flatnonzero(blocks.any(1))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array([blocks[i].tobytes() for i in used], pa.binary())], names=["l", "block", "c"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"l": pdf["l"].iloc[:1], "block": pdf["block"].iloc[:1], "c": [sum(np.frombuffer(x, np.int64) for x in pdf["c"]).tobytes()]})

    kind = "l string, block int, c binary"
    matrix = np.zeros((1 << BITS, len(langs)))
    for r in chosen.mapInArrow(count, kind).groupBy("l", "block").applyInPandas(add, kind).toLocalIterator():
        matrix[r["block"] * 1024 : (r["block"] + 1) * 1024, langs.index(r["l"])] = np.frombuffer(r["c"], np.int64)
    matrix = np.log(matrix + 1) - np.log(matrix.sum(0) + (1 << BITS))
    prior = np.log(np.array([counts[x] for x in langs]) / sum(counts.values()))
    return langs, np.vstack([matrix, prior])


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], keep: list[str], text_col: str = "text") -> DataFrame:
    """keep, `lang_pred` and `score`: the likeliest language of each whole text and its posterior chance.

    Texts that are null or have no letter, and all texts under a model without languages, get `und` and score 0. Of
    equally likely languages the first in order is taken. One row for each row of docs.
    """
    langs, table = model
    held = docs.sparkSession.sparkContext.broadcast(table.astype("f4"))  # 256 kB a language, MOST_LANGS at most

    def make():
        logs = held.value

        def scored(slots: list[np.ndarray], n: list[np.ndarray]) -> np.ndarray:
            """Log-probabilities of texts, one a row: their sparse counts times the matrix, plus the priors."""
            at = np.cumsum([0, *map(len, slots[:-1])])
            rows = np.concatenate(n)[:, None] * logs[np.concatenate(slots)].astype(float)
            return logs[-1].astype(float) + np.add.reduceat(rows, at, axis=0)

        def work(texts):
            pred, score = ["und"] * len(texts), [0.0] * len(texts)
            rows, slots, n, size = [], [], [], 0
            for i, x in enumerate([*texts, None]):
                if langs and x and any(map(str.isalpha, x)):
                    c = gram_counts(x)
                    rows.append(i), slots.append(np.flatnonzero(c)), n.append(c[slots[-1]])
                    size += len(slots[-1])
                if rows and (size > TOGETHER or i == len(texts)):
                    z = scored(slots, n)
                    p = np.exp(z - z.max(1, keepdims=True))
                    best = p.argmax(1)
                    for j, row in enumerate(rows):
                        pred[row], score[row] = langs[best[j]], float(p[j, best[j]] / p[j].sum())
                    rows, slots, n, size = [], [], [], 0
            return [pa.array(pred, pa.string()), pa.array(score, pa.float64())]

        return work

    return map_texts(docs, keep, text_col, make, "lang_pred string, score double")
