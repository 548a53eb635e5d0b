"""Naive Bayes and noisy-or scores against plain Python versions that share no code with the operators."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmscope.llm import langid, toxicity

MASK = (1 << 64) - 1


def slot(gram):
    h = len(gram)
    for c in gram:
        h = (h ^ ord(c)) * 0x9E3779B97F4A7C15 & MASK
        h ^= h >> 29
    return h >> 48


def slots_of(text):
    letters = " " + re.sub(r"[\W\d_]+", " ", text.lower()).strip() + " "
    return Counter(slot(letters[i : i + n]) for n in (1, 2, 3) for i in range(len(letters) - n + 1))


def test_language_scores(spark):
    at = "/root/testdata/sf0.001/documents.parquet"
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(at).select("doc_id", "text", "lang").collect()]
    rows = [(i, t[:4000], x) for i, t, x in rows][:80] + [(900, "12 -- 34", "en"), (901, None, "de"), (902, "ÀÉ ß東京 x", None)]
    train = [r for r in rows if r[1] is not None and r[2] is not None]
    counts, docs = {}, Counter()
    for _, t, x in train:
        counts.setdefault(x, Counter()).update(slots_of(t))
        docs[x] += 1
    langs = sorted(counts)
    total = {x: sum(counts[x].values()) for x in langs}
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = langid.fit(df)
    got = {r["doc_id"]: r for r in langid.identify(df, model, ["doc_id"]).collect()}
    for i, t, _ in rows:
        if not t or not any(c.isalpha() for c in t):
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        # the operator's matrix has 32-bit floats
        logs = {x: sum(n * float(np.float32(math.log(counts[x][s] + 1) - math.log(total[x] + 65536))) for s, n in slots_of(t).items()) + float(np.float32(math.log(docs[x] / len(train)))) for x in langs}
        best = max(langs, key=lambda x: logs[x])
        assert got[i]["lang_pred"] == best
        assert got[i]["score"] == pytest.approx(1 / sum(math.exp(v - logs[best]) for v in logs.values()), abs=1e-6)


def test_long_texts_are_taken_in_blocks(monkeypatch):
    text = "Straße über die Brücke, 東京 x1y " * 50
    want = np.bincount(langid.grams(text), minlength=1 << 16)
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert (langid.gram_counts(text) == want).all()


def brute_toxicity(text, weights, bias):
    """(score, chances of the sentences)."""
    chances = []
    for sentence in re.split(r"[.!?\n]+", text or ""):
        words = set(re.findall(r"[^\W_]+(?:'[^\W_]+)*", sentence.lower()))
        if words:
            z = bias + sum(weights.get(zlib.crc32(w.encode()), 0.0) for w in words)
            chances.append(1 / (1 + math.exp(-max(-40.0, min(40.0, z)))))
    return 1 - math.prod(1 - min(p, 1 - 1e-12) for p in chances) if chances else 0.0, chances


def test_noisy_or_scores(spark):
    at = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{at}/documents.parquet").select("doc_id", "text")
    model = toxicity.learn(docs, spark.read.parquet(f"{at}/labels.parquet"))
    rows = {r["doc_id"]: r["text"] for r in docs.collect()} | {-1: None, -2: "", -3: "... !?", -4: "It's o'clock_now. It's"}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    for r in toxicity.score(df, model, ["doc_id"]).collect():
        score, chances = brute_toxicity(rows[r["doc_id"]], *model)
        assert r["score"] == pytest.approx(score, abs=1e-9)
        assert r["n_offending"] == sum(p >= 0.5 for p in chances)
        assert r["worst_score"] == (pytest.approx(max(chances), abs=1e-9) if chances else None)


def brute_fit(examples, rounds=250):
    """The same descent with dictionaries: documents of sentences of words."""
    parsed = []
    for text, y in examples:
        sentences = [set(re.findall(r"[^\W_]+(?:'[^\W_]+)*", s.lower())) for s in re.split(r"[.!?\n]+", text)]
        parsed.append(([{zlib.crc32(w.encode()) for w in s} for s in sentences if s], y))
    n = Counter(y for _, y in parsed)
    used = sorted({w for s, _ in parsed for x in s for w in x})
    mean = sum(1 / n[y] for _, y in parsed) / len(parsed)
    weight = [1 / n[y] / mean for _, y in parsed]
    par = dict.fromkeys([*used, "b"], 0.0) | {"b": -6.0}
    m, v = dict.fromkeys(par, 0.0), dict.fromkeys(par, 0.0)
    for t in range(1, rounds + 1):
        grad = {w: 1e-6 * par[w] for w in used} | {"b": 0.0}
        for (sentences, y), wt in zip(parsed, weight, strict=True):
            p = [1 / (1 + math.exp(-max(-40, min(40, par["b"] + sum(par[w] for w in s))))) for s in sentences]
            none = math.prod(1 - min(q, 1 - 1e-12) for q in p)
            for q, s in zip(p, sentences, strict=True):
                g = q * (-none / max(1 - none, 1e-9) if y else 1.0) * wt / len(parsed)
                grad["b"] += g
                for w in s:
                    grad[w] += g
        for k, g in grad.items():
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.99 * v[k] + 0.01 * g * g
            par[k] -= 0.25 * (m[k] / (1 - 0.9**t)) / (math.sqrt(v[k] / (1 - 0.99**t)) + 1e-7)
    return {w: par[w] for w in used}, par["b"]


def test_noisy_or_training(spark):
    texts = [("nice day. you rotten worm! tea", 1), ("you fool. nice cake", 1), ("nice tea. good cake", 0), ("good day to you", 0), ("worm in the garden. nice", 0), ("rotten fool", 1)]
    df = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(texts)], "doc_id long, text string, y int")
    weights, bias = toxicity.fit(df, "y")
    want, b = brute_fit(texts)
    assert bias == pytest.approx(b, abs=1e-6) and weights == pytest.approx(want, abs=1e-6)
