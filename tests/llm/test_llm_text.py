"""Operators on texts against brute-force versions, and their defined results for odd input."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from firmscope.llm import decontaminate, langid, licenses, line_dedup, packing, queries, simhash, token_counts, token_files, toxicity
from firmscope.llm.encode import Encoder, encoder, vocabulary

ODD = [(0, None), (1, ""), (2, " \n\t"), (3, "One two."), (4, "One two."), (4, "One two."), (None, "no id here"), (5, "It's 'll don't -- x²½ ÀÉß straße <|endoftext|>a  b\x85c 東京 é İ 12 3.4,,.\n" * 30), (6, "la " * 30000), (7, "abc,. x\x0by\x0cz\x1cw")]


def odd(spark, rows=ODD):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clash = ["length", "n_tokens", "score", "fp", "id", "th", "w", "t", "a", "e", "h", "key", "n", "rank", "offset", "p", "s", "removed_lines_", "lang", "source"]
    return df.select("*", *(F.lit("x").alias(c) for c in clash))


def whole(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def docs_of(spark, sf):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


def test_encoder_agrees_with_library(spark, sf):
    texts = [t for _, t in ODD] + [t for _, t in docs_of(spark, sf)]
    e = Encoder(vocabulary(), most=2000)
    for k in range(0, len(texts), 37):
        for got, want in zip(e(texts[k : k + 37]), whole(texts[k : k + 37]), strict=True):
            assert [int.from_bytes(got[i : i + 4], "little") for i in range(0, len(got), 4)] == want


def test_length_histogram(spark, sf):
    rows = queries.op1_length_histogram(spark, sf).collect()
    n = Counter(len(x) for x in whole([t for _, t in docs_of(spark, sf)]))
    assert {r["length"]: r["n_docs"] for r in rows} == dict(n)
    for r in rows:
        at = r["length"]
        assert r["docs_ge"] == sum(c for k, c in n.items() if k >= at)
        assert r["tokens_ge"] == sum(k * c for k, c in n.items() if k >= at)
        assert r["truncated_total"] == sum(min(k, at) * c for k, c in n.items())
        assert r["share_le"] == pytest.approx(sum(c for k, c in n.items() if k <= at) / sum(n.values()))
    h = queries.op1_length_histogram(spark, sf)
    got = {r["context_limit"]: (r["total_tokens"], r["docs_cut"]) for r in token_counts.context_totals(h, [0, 7, 512, 10**6]).collect()}
    assert got == {k: (sum(min(x, k) * c for x, c in n.items()), sum(c for x, c in n.items() if x > k)) for k in (0, 7, 512, 10**6)}
    flat = sorted(n.elements())
    got = {r["share"]: r["length"] for r in token_counts.length_quantiles(h, [0.1, 0.5, 1.0]).collect()}
    assert got == {q: next(x for x in flat if sum(y <= x for y in flat) / len(flat) >= q) for q in (0.1, 0.5, 1.0)}


def test_length_histogram_odd(spark):
    got = token_counts.token_lengths(odd(spark), vocabulary()).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got) == sorted((str(i), len(x)) for (i, _), x in zip(ODD, whole([t for _, t in ODD]), strict=True))
    empty = token_counts.length_histogram(token_counts.token_lengths(odd(spark, []), vocabulary()))
    assert empty.collect() == []
    assert [tuple(r) for r in token_counts.context_totals(empty, [5]).collect()] == [(5, 0, 0)]


def brute_fp(text):
    t = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall("[^\x20\x09-\x0d]+", t)
    sh = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    """doc_id: least doc_id reachable."""
    one = sorted(set(fps.values()))
    root = {f: f for f in one}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(one):
        for b in one[:i]:
            if (a ^ b).bit_count() <= 2 and find(a) != find(b):
                root[find(a)] = find(b)
    least = defaultdict(lambda: 1 << 62)
    for d, f in fps.items():
        least[find(f)] = min(least[find(f)], d)
    return {d: least[find(f)] for d, f in fps.items()}


def test_simhash(spark, sf):
    docs = dict(docs_of(spark, sf))
    fps = {d: brute_fp(t) for d, t in docs.items()}
    want = brute_components(fps)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op3_simhash(spark, sf).collect()}
    assert got == {d: (f"{fps[d]:016x}", want[d]) for d in docs}


def test_simhash_odd(spark):
    got = simhash.near_duplicates(odd(spark)).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got}
    assert {by[i]["component_id"] for i in (0, 1, 2)} == {0} and by[0]["fingerprint"] == "0" * 16
    assert by[3]["component_id"] == by[4]["component_id"] == 3
    assert by[5]["fingerprint"] == f"{brute_fp(ODD[7][1]):016x}" and by[7]["fingerprint"] == f"{brute_fp(ODD[9][1]):016x}"
    assert simhash.near_duplicates(odd(spark, [])).collect() == []
    kept = simhash.keep_one(odd(spark)).select("doc_id").collect()
    assert sorted(str(r[0]) for r in kept) == sorted(map(str, [0, 3, 5, 6, 7, None]))


@pytest.mark.parametrize("most", [512, 3])
def test_simhash_links_all_near_pairs(spark, most):
    rng = np.random.RandomState(1)
    base = rng.randint(-(1 << 63), (1 << 63) - 1, 40, dtype=np.int64)
    values = {int(x) for x in base}
    for x in base[:10]:
        for _ in range(30):
            y = int(np.uint64(x))
            for b in rng.choice(64, rng.randint(1, 4), replace=False):
                y ^= 1 << int(b)
            values.add(int(np.uint64(y).view(np.int64)))
    fps = {i: v % (1 << 64) for i, v in enumerate(sorted(values))}
    want = brute_components(fps)
    df = spark.createDataFrame([(v,) for v in sorted(values)], "fp long")
    got = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, most=most)).collect()}
    groups, mine = defaultdict(set), defaultdict(set)
    for i, v in enumerate(sorted(values)):
        groups[want[i]].add(v)
        mine[got.get(v, v)].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def brute_contamination(docs, items):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    words = lambda t: word.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for a in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[a : a + 10])] |= set() if i is None else {str(i)}
    sizes = {len(x) for x in windows}
    out = []
    for d, t in docs:
        w, hit, met = words(t), set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                if (x := windows.get(tuple(w[a : a + n]))) is not None:
                    hit |= set(range(a, a + n))
                    met |= x
        out.append((str(d), len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def check_contamination(spark, docs, items):
    d, b = odd(spark, docs), spark.createDataFrame(items, "item_id long, text string").withColumn("s", F.lit(1)).withColumn("p", F.lit(2))
    got = decontaminate.contamination(d, b)
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in got.collect()) == brute_contamination(docs, items)


def test_contamination(spark, sf):
    docs = docs_of(spark, sf)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = queries.op4_decontamination(spark, sf).collect()
    want = brute_contamination(docs, items)
    assert sorted((str(r[0]), *tuple(r)[1:]) for r in got) == want
    assert any(x[-1] for x in want)


def test_contamination_odd(spark):
    long = " ".join(f"w{i}" for i in range(40))
    items = [(1, long), (2, "One, two"), (3, None), (4, ""), (5, "la " * 15), (6, long), (7, "x²½"), (8, " ".join(f"w{i}" for i in range(30, 40))), (None, "no item id here")]
    docs = [*ODD, (19, "with no item id here."), (20, "pre " + long.upper() + " post"), (21, " ".join(f"w{i}" for i in range(5, 14))), (22, " ".join(f"w{i}" for i in range(5, 15)) + ". W30 " + " ".join(f"w{i}" for i in range(30, 40)))]
    check_contamination(spark, docs, items)
    check_contamination(spark, docs, [])
    check_contamination(spark, [], items)
    kept = decontaminate.clean(odd(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(str(r["doc_id"]) for r in kept.select("doc_id").collect()) == sorted(x[0] for x in brute_contamination(docs, items) if not x[-1])


def brute_line_dedup(docs, lines=4, words=50):
    """Every stretch of lines that is long enough is looked up among all earlier ones."""
    seen, out = set(), {}
    for d, t in sorted(docs):
        rows, cut = t.split("\n"), set()
        keep = [i for i, x in enumerate(rows) if x.strip()]
        for s in range(len(keep)):
            key, n = 0, 0
            for k in range(s, len(keep)):
                line = rows[keep[k]].strip()
                key, n = hash((key, line)), n + len(line.split())
                if n >= words or k - s + 1 >= lines:
                    if key in seen:
                        cut |= set(range(keep[s], keep[k] + 1))
                    seen.add(key)
        out[d] = "\n".join(r for i, r in enumerate(rows) if i not in cut) if cut else t
    return out


def test_line_dedup(spark, sf):
    docs = docs_of(spark, sf)
    want = brute_line_dedup(docs)
    got = queries.op7_line_dedup(spark, sf).collect()
    assert {r["doc_id"]: r["text_sha256"] for r in got} == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in want.items()}
    assert any(r["removed_lines"] for r in got)


def test_line_dedup_runs(spark):
    """Runs of few different lines of uneven length: matches reach from the first line of a run to its last."""
    rng = np.random.RandomState(5)
    lines = [" ".join(f"{c}{i}" for i in range(n)) for c, n in zip("abcdefgh", (3, 8, 12, 20, 28, 33, 49, 55), strict=True)] + ["", "  "]
    docs = [(d, "\n".join(lines[i] for i in rng.randint(0, len(lines), rng.randint(1, 9)))) for d in range(300)]
    docs += [(300, "\n".join([lines[5], lines[4] + " x", lines[0] + " y"])), (301, "top\n" + "\n".join([lines[5], lines[4] + " x", lines[0] + " y", "end"]))]
    filled = lambda texts: {d: [x for x in t.split("\n") if x.strip()] for d, t in texts.items()}  # noqa: E731  blanks between two windows stay
    got = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(odd(spark, docs)).collect()}
    assert filled(got) == filled(brute_line_dedup(docs)) and got[301] == "top\nend"


def test_line_dedup_odd(spark):
    run = "\n".join(["Alpha beta", "gamma", "", " delta", "eps"])
    passage = " ".join(f"p{i}" for i in range(60))
    docs = [*ODD[:3], (10, "x\n" + run + "\ny"), (11, run), (12, "a\n" + passage), (13, passage + "\n\nb"), (14, "same\n" * 9), (None, run), (15, "Alpha beta\ngamma\nend")]
    got = line_dedup.drop_repeated_lines(odd(spark, docs)).collect()
    by = {r["doc_id"]: r["text"] for r in got}
    want = brute_line_dedup([(d, t) for d, t in docs if d is not None and t is not None])
    assert len(got) == len(docs) and by[None] == run and by[0] is None
    assert {d: by[d] for d in want} == want
    assert by[11] == "" and by[13] == "\nb" and by[15].startswith("Alpha")
    assert line_dedup.drop_repeated_lines(odd(spark, [])).collect() == []


def test_licenses(spark, sf):
    got = {r["doc_id"]: r for r in queries.op6_licenses(spark, sf).collect()}
    marks = {"Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    docs = docs_of(spark, sf)
    for d, t in docs:
        assert got[d]["licenses"] == ",".join(sorted(x for m, x in marks.items() if m in (t or "").split("\n") or m in t))
    mit = "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. In no event"
    rows = licenses.scan(odd(spark, [*ODD, (30, mit), (31, mit.replace("The above copyright notice", "Some other notice")), (32, "Released under the MIT License. " * 2)]), ["doc_id"]).collect()
    by = {r["doc_id"]: r for r in rows}
    assert by[30]["licenses"] == ["MIT"] and by[30]["n_sentences"] == 3 and mit[by[30]["first_start"] :].startswith("Permission")
    assert by[31]["licenses"] == [] and by[32]["n_matches"] == 2 and by[0]["licenses"] == [] and by[0]["first_start"] is None
    assert licenses.scan(odd(spark, []), ["doc_id"]).collect() == []


def test_token_files(spark, sf):
    docs = sorted(docs_of(spark, sf))
    got = sorted(tuple(r) for r in queries.op8_token_files(spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    want, at = [], 0
    for (d, _), ids in zip(docs, whole([t for _, t in docs]), strict=True):
        ids = [*ids, 1]
        want.append((d, at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        at += len(ids)
    assert got == want


def test_token_files_odd(spark, tmp_path):
    rows = [(d if d is not None else -1, t) for d, t in ODD]
    for dtype in ("<u4", "<u2"):
        at = f"file://{tmp_path}/{dtype[1:]}"
        parts = token_files.write(odd(spark), at, vocabulary(), dtype=dtype)
        got = sorted((-1 if r[0] is None else r[0], *tuple(r)[1:]) for r in token_files.read(parts, at).collect())
        assert [g[0] for g in got] == sorted(d for d, _ in rows)
        assert [g[1] for g in got] == [sum(x[2] for x in got[:i]) for i in range(len(got))] and got[1][2] == 1
    assert token_files.round_trip(odd(spark, []), vocabulary()).collect() == []


def check_packing(rows, ids, window=4096):
    """rows: (doc, start, length, crc, doc_tokens, sequence, offset); ids: doc: list of id lists."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r[0]].append(r)
        by_seq[r[5]].append(r)
    assert set(by_doc) == set(ids)
    for d, got in by_doc.items():
        if len(ids[d]) > 1:
            continue
        at = 0
        for r in sorted(got, key=lambda r: r[1]):
            assert r[1] == at and r[4] == len(ids[d][0])
            assert r[3] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids[d][0][at : at + r[2]]))
            at += r[2]
        assert at == len(ids[d][0])
    padding = 0
    for got in by_seq.values():
        at = 0
        for r in sorted(got, key=lambda r: r[6]):
            assert r[6] == at and r[2] > 0
            at += r[2]
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    total = sum(r[2] for r in rows)
    assert total == sum(len(x) for v in ids.values() for x in v)
    return padding / total


def test_packing(spark, sf):
    docs = docs_of(spark, sf)
    got = [tuple(r) for r in queries.op10_packing(spark, sf).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset").collect()]
    assert check_packing(got, {d: [[*x, 2]] for (d, _), x in zip(docs, whole([t for _, t in docs]), strict=True)}) < 0.005


def test_packing_odd(spark):
    ids = defaultdict(list)
    for (d, _), x in zip(ODD, whole([t for _, t in ODD]), strict=True):
        ids[d].append([*x, 2])
    got = [tuple(r) for r in packing.pack(odd(spark), vocabulary()).collect()]
    assert check_packing(got, ids) < 0.01
    assert packing.pack(odd(spark, []), vocabulary()).collect() == []
    same = [(i, "word " * 2999) for i in range(7)]
    got = [tuple(r) for r in packing.pack(odd(spark, same), vocabulary()).collect()]
    assert check_packing(got, {d: [[*x, 2]] for (d, _), x in zip(same, whole([t for _, t in same]), strict=True)}) == 0


def test_fill_is_the_best_subset():
    import random
    from itertools import product

    rng = random.Random(3)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(5)}
        cap = rng.randint(1, 60)
        best, used = packing.fill(counts, cap)
        sums = [sum(k * n for k, n in zip(counts, c, strict=True)) for c in product(*(range(v + 1) for v in counts.values()))]
        assert best == max(s for s in sums if s <= cap) == sum(k * n for k, n in used.items())
        assert all(n <= counts[k] for k, n in used.items())


def test_language(spark):
    got = queries.op9_language(spark, "/root/testdata/sf0.01").collect()
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got) and len(got) == len(truth)
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.95


def test_language_odd(spark):
    model = langid.fit(spark.createDataFrame([(1, "the cat", "en"), (2, "die Katze", "de"), (3, None, "fr"), (4, "x", None)], "doc_id long, text string, lang string"))
    rows = langid.identify(odd(spark), model, ["doc_id"]).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ODD) and by[0]["lang_pred"] == by[1]["lang_pred"] == by[2]["lang_pred"] == "und"
    assert by[3]["lang_pred"] in ("de", "en") and 0 <= by[3]["score"] <= 1
    assert [r["lang_pred"] for r in langid.identify(odd(spark, [(1, "12 ²³ ½ _-")]), model, ["doc_id"]).collect()] == ["und"]
    none = langid.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r["lang_pred"] for r in langid.identify(odd(spark), none, ["doc_id"]).collect()} == {"und"}
    assert langid.identify(odd(spark, []), model, ["doc_id"]).collect() == []


def test_toxicity(spark):
    at = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in queries.op2_toxicity(spark, at).collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{at}/labels.parquet").collect()}
    held = [d for d in labels if got[d]["held_out"]]
    assert held and all(zlib.crc32(str(d).encode()) % 3 == 1 for d in held)
    hit = [got[d]["predicted"] for d in held if labels[d] == 1]
    false = [got[d]["predicted"] for d in held if labels[d] == 0]
    assert sum(hit) / len(hit) > 0.8 and sum(false) / len(false) < 0.02
    texts = dict(docs_of(spark, at))
    bad = re.compile("moron|loser|pathetic|scum|worthless|idiot|clown|trash|disgusting|stupid", re.I)
    worst = [r for d, r in got.items() if r["predicted"] and bad.search(texts[d])]
    assert sum(bool(bad.search(texts[r["doc_id"]][r["worst_start"] : r["worst_start"] + r["worst_length"]])) for r in worst) / len(worst) > 0.9


def test_toxicity_odd(spark):
    labels = spark.createDataFrame([(0, 1), (0, 0), (3, 1), (3, 1), (5, 0), (None, 1), (7, None), (99, 1)], "doc_id long, toxic int").withColumn("text", F.lit(""))
    rows = toxicity.toxicity(odd(spark), labels).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(ODD) and by[0]["score"] == by[1]["score"] == by[2]["score"] == 0 and by[None]["held_out"] is False
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows) and by[0]["worst_start"] is None
    assert all(r["predicted"] == 0 for r in toxicity.toxicity(odd(spark), labels.limit(0)).collect())
    assert toxicity.toxicity(odd(spark, []), labels).collect() == []
