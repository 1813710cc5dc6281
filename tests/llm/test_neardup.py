"""Near-duplicates by similarity against brute force."""

import random

import numpy as np
import pytest

import corpus_pipeline
from corpusmill.llm import neardup, simhash


def grams(text):
    w = text.lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}


def brute(texts):
    """Component of each index, named by its smallest index."""
    root, sets = list(range(len(texts))), [grams(t) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both * 5 >= 4 * len(sets[i] | sets[j]) and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    return root


def test_stage_equals_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").orderBy("doc_id").collect()
    want = brute([d.text or "" for d in docs])
    rows = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(docs)).collect()}
    assert rows == {d.doc_id: docs[r].doc_id for d, r in zip(docs, want)}
    kept = corpus_pipeline.near_dedup(spark, spark.createDataFrame(docs), tiny).collect()
    assert sorted(r.doc_id for r in kept) == [docs[i].doc_id for i in range(len(docs)) if want[i] == i]


@pytest.mark.parametrize("large", [neardup.LARGE, 8])
def test_changed_copies_in_one_large_group(spark, large):
    """Also where buckets are too large for one worker; some hold texts that aren't similar to their first one."""
    rnd = random.Random(5)
    texts = []
    base = [f"w{rnd.randrange(10**6)}" for _ in range(200)]
    for size, keep in ((60, 0), (60, 160), (30, 120), (2, 0), (2, 0), (2, 0)):
        base = base[:keep] + [f"w{rnd.randrange(10**6)}" for _ in range(200 - keep)]
        for _ in range(size):
            copy = list(base)
            for at in rnd.sample(range(200), 2):
                copy[at] = f"x{rnd.randrange(10**6)}"
            texts.append(" ".join(copy))
    want = brute(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df, large=large).collect()} == dict(enumerate(want))


def test_similar_goes_through_others():
    a = np.arange(100, dtype=np.uint64)
    sets = [a, a + np.uint64(5), a + np.uint64(10), a + np.uint64(15), a + np.uint64(60)]  # 0.90, 0.82, 0.74 from the first
    links = neardup.similar(sets)
    assert len(links) == 3 and {i for link in links for i in link} == {0, 1, 2, 3}


def test_odd_rows(spark):
    long = "word " * 50_000
    data = [(1, None), (2, ""), (3, long), (3, long), (None, long), (None, "only here by itself alone"), (7, "x")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = [(r.doc_id, r.component_id) for r in neardup.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (2, 1), (3, 3), (3, 3), (None, 3), (None, None), (7, 7)], key=str)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in neardup.dedup(df).collect()) == [(False, 1), (False, 3), (False, 7), (True, 0)]
    assert neardup.dedup(df.limit(0)).count() == 0


def changed_end(seed, words):
    """A text of 100 words and one that ends in other words."""
    rnd = random.Random(seed)
    a = [f"w{rnd.randrange(10**6)}" for _ in range(100)]
    return " ".join(a), " ".join(a[: 100 - words] + [f"w{rnd.randrange(10**6)}" for _ in range(words)])


def test_fingerprints_give_candidates(spark):
    """A similar pair within NEAR bits that shares no MinHash bucket is linked; a pair within NEAR bits that isn't similar is not."""

    def bits(pair):
        x, y = simhash.fingerprints_of([t.encode() for t in pair]).tolist()
        return (x ^ y).bit_count()

    alike = changed_end(4668, 10)  # 86 of 106 shingles
    x, y = (neardup.band_keys(neardup.shingles_of(t.encode())) for t in alike)
    assert not set(x.tolist()) & set(y.tolist()) and bits(alike) <= neardup.NEAR
    other = next(p for p in (changed_end(s, 14) for s in range(5000)) if bits(p) <= neardup.NEAR)  # 82 of 110
    texts = [*alike, *other, "none of these", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sigs = neardup.signatures(df, "doc_id", "text")
    found = {}
    for r in neardup.by_fingerprint(sigs).join(sigs.select("doc_id", "same"), "same").collect():
        found.setdefault(r.key, set()).add(r.doc_id)
    assert sorted(map(sorted, found.values())) == [[0, 1], [2, 3]]
    assert {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()} == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4, 5: 5, 6: 5}
