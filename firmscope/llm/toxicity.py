"""Toxicity by multiple-instance learning: sentence scores joined by noisy-or, trained from labels of documents."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmscope.llm.common import map_texts, numbered

#: Words of the sample are screened: their shares of documents of either label differ by this many standard errors.
SCREEN = 3.5
_sentences = re.compile(r"[^.!?\n]+").finditer
_words = re.compile(r"[^\W_]+(?:'[^\W_]+)*").findall


class Table(dict):
    """What find() returns for a word, by its hash; the table is emptied when it is full."""

    def __init__(self, find):
        self.find = find

    def __missing__(self, word: str):
        if len(self) > 500_000:
            self.clear()
        v = self[word] = self.find(zlib.crc32(word.encode("utf-8", "surrogatepass")))
        return v


def bags(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """keep, `sizes` (words of each sentence) and `slots` (their 32-bit hashes), both as little-endian uint32."""

    def make():
        slots = Table(lambda h: h)

        def work(texts):
            sizes, flat = [], []
            for x in texts:
                s = [[slots[w] for w in set(_words(m.group().lower()))] for m in _sentences(x or "")]
                s = [y for y in s if y]
                sizes.append(np.array([len(y) for y in s], "<u4").tobytes())
                flat.append(np.array([v for y in s for v in y], "<u4").tobytes())
            return [pa.array(sizes, pa.binary()), pa.array(flat, pa.binary())]

        return work

    return map_texts(docs, keep, text_col, make, "sizes binary, slots binary")


def sample_labels(labels: DataFrame, label_col: str, id_col: str, per_class: int) -> DataFrame:
    """About per_class ids of each label (0 or 1), chosen by a hash of the id."""
    rows = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
    counts = {r["y"]: r["n"] for r in rows.groupBy(F.col(label_col).cast("int").alias("y")).agg(F.count("*").alias("n")).collect()}
    part = F.pmod(F.xxhash64(F.lit("sample"), F.col(id_col)), F.lit(1_000_000))
    most = F.lit(0)
    for y, n in counts.items():
        most = F.when(F.col(label_col) == y, int(1e6 * min(1, per_class / n))).otherwise(most)
    return rows.filter(part < most)


def fit(examples: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", rounds: int = 250) -> tuple[dict[int, float], float]:
    """Weights of words, by hash, and a bias, learnt from the labels (0 or 1) of a bounded sample of whole documents.

    Both labels weigh the same, however often they occur. If one is missing altogether the model scores 0 everywhere.
    A document's chance is 1 - prod(1 - p_s) over its sentences. Its log-loss has the gradient p_s for label 0 and
    -p_s (1 - P) / P for label 1 with respect to a sentence's logit. Adam steps.
    """
    none_learnt: tuple[dict[int, float], float] = {}, -40.0
    rows = examples.select(id_col, text_col, F.col(label_col).cast("int").alias("__y"))
    got = bags(rows, [id_col, "__y"], text_col).orderBy(id_col, "slots").select(F.col("__y").alias("y"), "sizes", "slots").toPandas()
    got = got[got["slots"].str.len() > 0]
    y = got["y"].to_numpy()
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    if not n1 or not n0:
        return none_learnt
    sent = [np.frombuffer(b, "<u4").astype(np.int64) for b in got["sizes"]]
    in_doc, sent = np.array([len(x) for x in sent]), np.concatenate(sent)
    words, flat = np.unique(np.concatenate([np.frombuffer(b, "<u4") for b in got["slots"]]), return_inverse=True)
    of_sent, of_doc = np.repeat(np.arange(len(sent)), sent), np.repeat(np.arange(len(y)), in_doc)
    w, d = np.divmod(np.unique(flat * len(y) + of_doc[of_sent]), len(y))
    with1, with0 = (np.bincount(w[y[d] == k], minlength=len(words)) for k in (1, 0))
    share = (with1 + with0 + 1) / (n1 + n0 + 2)
    apart = (with1 / n1 - with0 / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
    used = np.flatnonzero((np.abs(apart) >= SCREEN) | (n1 + n0 < 20))
    place = np.full(len(words), -1)
    place[used] = np.arange(len(used))
    ok = place[flat] >= 0
    flat, of_sent = place[flat][ok], of_sent[ok]
    at_doc = np.r_[0, np.cumsum(in_doc)[:-1]]
    weight = np.where(y == 1, 1 / n1, 1 / n0)
    weight = weight / weight.mean()
    v, b = np.zeros(len(used)), -6.0
    m, s = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(of_sent, v[flat], len(sent)) + b, -40, 40)))
        none = np.exp(np.add.reduceat(np.log1p(-np.minimum(p, 1 - 1e-12)), at_doc))
        gz = p * (np.where(y == 1, -none / np.maximum(1 - none, 1e-9), 1.0) * weight / len(y))[of_doc]
        grad = np.r_[np.bincount(flat, gz[of_sent], len(used)) + 1e-6 * v, gz.sum()]
        m, s = 0.9 * m + 0.1 * grad, 0.99 * s + 0.01 * grad**2
        step = 0.25 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-7)
        v, b = v - step[:-1], b - step[-1]
    return dict(zip(words[used].tolist(), v.tolist(), strict=True)), float(b)


def score(docs: DataFrame, model: tuple[dict[int, float], float], keep: list[str], text_col: str = "text") -> DataFrame:
    """keep, `score` (chance that the document is toxic), and where its worst sentence is.

    worst_start and worst_length (in characters), worst_score; n_offending: sentences of chance 0.5 or more.
    Null, empty and wordless texts score 0 and have null positions. Every whole text is read. Rows stay as they are.
    """
    spark = docs.sparkSession
    weights, bias = model
    held = spark.sparkContext.broadcast(weights)  # a few thousand words, bounded by the sample

    def make():
        known = held.value
        look = Table(lambda h: known.get(h, 0.0)).__getitem__

        def work(texts):
            scores, starts, lengths, worst, n = [], [], [], [], []
            for x in texts:
                z, at = [], []
                for m in _sentences(x or ""):
                    if ws := set(_words(m.group().lower())):
                        z.append(sum(map(look, ws)) + bias)
                        at.append(m.span())
                if not z:
                    scores.append(0.0), starts.append(None), lengths.append(None), worst.append(None), n.append(0)
                    continue
                p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                k = int(np.argmax(p))
                scores.append(float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())))
                starts.append(at[k][0]), lengths.append(at[k][1] - at[k][0]), worst.append(float(p[k])), n.append(int((p >= 0.5).sum()))
            return [pa.array(scores, pa.float64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(worst, pa.float64()), pa.array(n, pa.int64())]

        return work

    return map_texts(docs, keep, text_col, make, "score double, worst_start long, worst_length long, worst_score double, n_offending long")


def remainder(id_col: str, n: int):
    """crc32 of the id as text, mod n; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % n, F.lit(-1))


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 3000) -> tuple[dict[int, float], float]:
    """The model of a sample of about per_class labelled documents of each label, whole texts.

    labels (doc_id, toxic) are learnt from ids whose remainder mod 3 is not 1. Of several labels of an id the largest
    counts, of several texts of an id one, chosen by its hash: so no more than the sampled ids reach the driver.
    """
    train = labels.filter(remainder("doc_id", 3).isin(0, 2)).groupBy("doc_id").agg(F.max("toxic").alias("__toxic"))
    chosen = sample_labels(train, "__toxic", "doc_id", per_class)
    # about 2 * per_class ids at most, whatever the tables hold: that bound allows the broadcast
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id").agg(F.max("__toxic").alias("__toxic"), F.min_by("text", F.xxhash64(F.coalesce("text", F.lit("")))).alias("text"))
    return fit(one, "__toxic")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, per_class: int = 3000) -> DataFrame:
    """doc_id, held_out, score, predicted and the worst sentence of every row of docs, by the model that learn() fits.

    doc_id, lang, source and the labels are no inputs of a score.
    """
    model = learn(docs, labels, per_class)
    return score(docs.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "text"), model, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, per_class: int = 3000) -> DataFrame:
    """The rows of docs whose own text scores below the threshold; all columns return as they are.

    Each row is judged by its text alone: rows with a null id go like any other, and of rows that share an id only those
    whose text is toxic. Null and empty texts score 0 and stay. No labels: all stay.
    """
    model, rows = learn(docs, labels, per_class), numbered(docs)
    scored = score(rows, model, rows.columns, f"c{docs.columns.index('text')}")
    return scored.filter(F.col("score") < threshold).select(*rows.columns).toDF(*docs.columns)
