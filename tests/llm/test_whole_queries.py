"""Whole queries against plain Python versions of the same definitions."""

import math
import unicodedata
import zlib
from collections import Counter

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from corpusmill.llm import langid, quality, resample

WIDE = (1 << 64) - 1


# importance resampling


def ngram_buckets(text, n):
    w = [xxhash.xxh64_intdigest(x) for x in (text or "").encode().lower().split()]
    out = []
    for i, h in enumerate(w):
        out.append(h % n)
        if i + 1 < len(w):
            pair = (h * 0x9E3779B97F4A7C15 + w[i + 1]) & WIDE
            pair = ((pair ^ (pair >> 29)) * 0xBF58476D1CE4E5B9) & WIDE
            out.append((pair >> 7) % n)
    return out


def resampled(docs, labels, p):
    """{row: (n_features, log_weight, gumbel_key, selected)} of docs, a list of (id, text), and labels {id: wanted}."""
    target = {i for i, wanted in labels.items() if wanted}
    raw, wanted = [0] * p.buckets, [0] * p.buckets
    features = [ngram_buckets(t, p.buckets) for _, t in docs]
    for (i, _), f in zip(docs, features):
        for b in f:
            raw[b] += 1
            wanted[b] += i in target
    def log_p(counts):
        total = sum(counts) + p.smoothing * p.buckets
        return [math.log((c + p.smoothing) / total) for c in counts]

    ratio = [a - b for a, b in zip(log_p(wanted), log_p(raw))] if any(wanted) else [0.0] * p.buckets
    rows = []
    for (i, _), f in zip(docs, features):
        weight = sum(ratio[b] for b in f)
        u = ((xxhash.xxh64_intdigest(str(i).encode(), p.seed) >> 11) + 0.5) / 2.0**53
        rows.append((len(f), weight, weight - math.log(-math.log(u))))
    k = round(sum(labels.values()) / len(labels) * len(docs))
    least = sorted((r[2] for r in rows), reverse=True)[k - 1] if k else math.inf
    return [(*r, r[2] >= least) for r in rows]


def compare_resampled(got, docs, labels, p):
    want = {}
    for (i, _), r in zip(docs, resampled(docs, labels, p)):
        want.setdefault(i, []).append(r)
    assert len(got) == len(docs)
    for i, rows in want.items():
        own = sorted(tuple(r)[1:] for r in got if r.doc_id == i)
        for g, w in zip(own, sorted(rows)):
            assert g[0] == w[0] and g[3] == w[3]
            assert g[1] == pytest.approx(w[1], rel=1e-9, abs=1e-9) and g[2] == pytest.approx(w[2], rel=1e-9, abs=1e-9)


def test_resampling_query(spark, tiny):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    labels = {r.doc_id: r.quality == 1 for r in spark.read.parquet(f"{tiny}/labels.parquet").collect()}
    got = resample.query(spark, tiny).collect()
    compare_resampled(got, docs, labels, resample.Params())
    assert 0 < sum(r.selected for r in got) < len(got)


def test_resampling_of_odd_rows(spark):
    docs = [(i, " ".join(f"w{(i * k) % 11}" for k in range(i % 9))) for i in range(50)]
    docs += [(60, None), (61, ""), (62, "very long " * 60_000), (7, "again with an id that is there"), (None, "no id at all")]
    labels = {i: i % 3 == 0 for i in range(40)} | {1000: True}  # one without a document
    p = resample.Params(buckets=64)
    df = spark.createDataFrame([(*d, 1, True) for d in docs], "doc_id long, text string, k int, selected boolean").select("doc_id", "text", "k", "selected")
    marks = spark.createDataFrame([(i, w, "x") for i, w in labels.items()], "doc_id long, wanted boolean, text string")
    compare_resampled(resample.resample(df, marks, p=p).collect(), docs, labels, p)


# language identification


def ngram_counts(text):
    """Counts by dimension; empty without a letter."""
    x = ["\n", *(text or "").encode("utf-8", "replace").decode().lower(), "\n"]
    kind = [unicodedata.category(c)[0] for c in x]
    if "L" not in kind:
        return Counter()
    letter = [k in "LM" for k in kind]
    code = [ord(c) if ok else 32 for c, ok in zip(x, letter)]
    keys = [c + 1 for c, ok in zip(code, letter) if ok]
    two = [code[i] * 0x1F1F1F1F + code[i + 1] + (1 << 40) for i in range(len(code) - 1)]
    keys += [two[i] for i in range(len(two)) if letter[i] or letter[i + 1]]
    keys += [two[i] * 0x2545F491 + code[i + 2] + (1 << 41) for i in range(len(code) - 2) if letter[i + 1] and (letter[i] or letter[i + 2])]
    return Counter(((k & WIDE) * 0x9E3779B97F4A7C15 & WIDE) >> 52 for k in keys)


def unit(v):
    size = math.sqrt(sum(x * x for x in v.values()))
    return {k: x / size for k, x in v.items()} if size else {}


def dot(a, b):
    return sum(x * b.get(k, 0.0) for k, x in a.items())


def clustered(vectors, k, rounds, seed):
    import numpy as np

    centres = [vectors[np.random.default_rng(seed).integers(len(vectors))]]
    while len(centres) < min(k, len(vectors)):
        near = [max(dot(v, c) for c in centres) for v in vectors]
        if min(near) > 1 - 1e-6:
            break
        centres.append(vectors[near.index(min(near))])
    for _ in range(rounds):
        sums = [Counter() for _ in centres]
        members = [0] * len(centres)
        for v in vectors:
            scores = [dot(v, c) for c in centres]
            own = scores.index(max(scores))
            members[own] += 1
            sums[own].update(v)
        centres = [unit(s) if n else c for s, n, c in zip(sums, members, centres)]
    return centres


def test_language_query(spark, tiny):
    p = langid.Params()
    rows = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text", "lang", F.xxhash64(F.lit(p.seed), "doc_id", F.xxhash64("text")).alias("h")).collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    train = [r for r in rows if not held[r.doc_id] and r.text is not None and r.lang is not None]
    counts = {id(r): ngram_counts(r.text) for r in rows}
    df = Counter(k for r in train for k in counts[id(r)])

    def vector(r):
        return unit({k: math.log1p(n) * (math.log((1 + len(train)) / (1 + df[k])) + 1) for k, n in counts[id(r)].items()})

    centroids = []
    for lang in sorted({r.lang for r in train}):
        own = [vector(r) for r in sorted((r for r in train if r.lang == lang), key=lambda r: (r.h, r.text))]
        centroids += [(lang, c) for c in clustered([v for v in own if v], p.centroids, p.rounds, p.seed)]
    got = {r.doc_id: r for r in langid.query(spark, tiny).collect()}
    assert len(got) == len(rows)
    for r in rows:
        v, g = vector(r), got[r.doc_id]
        assert g.held_out == held[r.doc_id]
        if not v:
            assert (g.lang_pred, g.score) == ("und", 0.0)
            continue
        scores = [dot(v, c) for _, c in centroids]
        assert g.score == pytest.approx(min(1.0, max(scores)), abs=2e-3)
        best = max(s for (lang, _), s in zip(centroids, scores) if lang == g.lang_pred)
        assert best >= max(scores) - 2e-3  # 32-bit sums may turn a tie


# quality rules


def fails(line):
    """The line rules, one after another, in plain words."""
    words = line.split()
    n = len(words)
    marks = regex.findall(r"\s[|»›·•→/]\s|\s>\s", line)
    if len(marks) >= 2 and len(marks) / n >= 0.25:
        return True
    if sum(c in "#*$%&|<>" for c in line) > 0.3 * n:
        return True
    letters = [c for c in line if c.lower() != c.upper() or c.isupper() or c.islower()]
    if n >= 3 and letters and not any(c.islower() for c in line) and any(c.isupper() for c in line):
        return True
    ended = regex.search(r"[.!?…:;。！？：；।؟؛][\"'”’»)\]]*$", line.strip())
    dense = sum(bool(regex.match(r"[\p{Thai}\p{Lao}\p{Myanmar}\p{Khmer}\p{Hiragana}\p{Katakana}\p{Han}]", c)) for c in line) >= 10
    if not ended:
        if n <= 3 and not dense or all(len(w) == 1 or w.lower().strip("/|>»›·•→") in quality.NAVIGATION for w in words):
            return True
        if not dense and not any(c in ".,;:!?…。，、；：！？।؟،؛" for c in line):
            return True
    if n <= 25 and quality.BOILERPLATE.search(line):
        return True
    return n >= 10 and len(set(words)) < 0.3 * n


def verdict(text):
    w = (text or "").encode().split()
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    clean, seen = 0, set()
    for line in (text or "").split("\n"):
        n = len(line.encode().split())
        if n and line not in seen and not fails(line):
            seen.add(line)
            clean += n
    failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
    return clean, failed, not failed and clean >= 0.5 * len(w)


def test_quality_query(spark, tiny):
    got = {r.doc_id: (r.n_clean_words, r.base_failed, r.kept) for r in quality.query(spark, tiny).collect()}
    docs = spark.read.parquet(f"{tiny}/documents.parquet").collect()
    assert got == {d.doc_id: verdict(d.text) for d in docs}
    assert {k for _, _, k in got.values()} == {True, False}


def test_quality_of_odd_rows(spark):
    good = "This is a clean sentence with more than ten words, as anyone can see."
    texts = [None, "", " \n\t", good, good + "\nHome | About | Contact\n" + good, "\n".join(f"{good} {k}." for k in range(20_000)), "SHOUT AT ALL OF THEM NOW!\n" + good, "ein　zwei drei", "短い行です\nこれは長い行です。", "\n".join(f"これは句点のない長い行です {k} 番目" for k in range(5)), "Startseite Kontakt Impressum Hilfe\n" + good]
    df = spark.createDataFrame([(i, t, True, 3) for i, t in enumerate(texts)] + [(None, good, False, 1), (3, good, False, 1)], "doc_id long, text string, kept boolean, n_words int")
    got = sorted(((r.doc_id is None, r.doc_id or 0), (r.n_clean_words, r.base_failed, r.kept)) for r in quality.verdicts(df).collect())
    assert got == sorted([((False, i), verdict(t)) for i, t in enumerate(texts)] + [((True, 0), verdict(good)), ((False, 3), verdict(good))])
    assert quality.verdicts(df.limit(0)).count() == 0
