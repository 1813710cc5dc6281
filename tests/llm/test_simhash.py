"""SimHash linking against brute force."""

import random

import numpy as np
import pytest

from corpusmill.llm import simhash


def brute(fps, max_bits):
    """Component of each index, named by its smallest index."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= max_bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_bit_rule():
    import xxhash

    h = xxhash.xxh64_intdigest(b"a b", 42)
    assert int(simhash.fingerprints_of([b"A b"])[0]) == h  # fewer words: the whole sequence
    grams = [xxhash.xxh64_intdigest(g, 42) for g in (b"a b c", b"b c d")]
    assert int(simhash.fingerprints_of([b"a B\tc  d"])[0]) == grams[0] & grams[1]  # over half of two: both
    assert list(simhash.fingerprints_of([b"", b" \n"])) == [0, 0]


@pytest.mark.parametrize("max_bits,large", [(2, 2048), (2, 13), (3, 13), (5, 13)])
def test_links_equal_brute_force(spark, max_bits, large):
    rnd = random.Random(max_bits)
    fps = [rnd.getrandbits(64) for _ in range(40)]
    hot = rnd.getrandbits(64)  # many near one: large buckets
    fps += [hot ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) ^ (rnd.getrandbits(3) << 61) for _ in range(160)]
    for f in list(fps[:40]):
        for d in range(1, 5):
            for b in rnd.sample(range(64), d):
                f ^= 1 << b
            fps.append(f)
    fps = sorted(set(fps))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = [(r.a, r.b) for r in simhash.links(df, max_bits, large).collect()]
    at = {x: i for i, x in enumerate(signed)}
    assert all(bin(fps[at[a]] ^ fps[at[b]]).count("1") <= max_bits for a, b in edges)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = find(at[a]), find(at[b])
        root[max(x, y)] = min(x, y)
    assert [find(i) for i in range(len(fps))] == brute(fps, max_bits)


def test_query_equals_brute_force(spark, tiny):
    rows = {r.doc_id: r for r in simhash.query(spark, tiny).collect()}
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    fps = [int(x) for x in simhash.fingerprints_of([d.text.encode() for d in docs])]
    want = brute(fps, 2)
    assert len(rows) == len(docs)
    for i, d in enumerate(docs):
        assert rows[d.doc_id].fingerprint == f"{fps[i]:016x}"
        assert rows[d.doc_id].component_id == docs[want[i]].doc_id


def test_odd_rows(spark):
    long = "word " * 50_000
    data = [(1, None, 1), (2, "", 2), (3, long, 3), (3, long, 3), (None, long, 4), (None, "only here by itself alone", 5), (7, "x", 6)]
    df = spark.createDataFrame(data, "doc_id long, text string, fp int")  # fp clashes with an inner name
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (2, 1), (3, 3), (3, 3), (None, 3), (None, None), (7, 7)], key=str)
    kept = simhash.dedup(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, 1), (False, 3), (False, 7), (True, 0)]
    assert kept[0].asDict().keys() == {"doc_id", "text", "fp"}
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    assert simhash.dedup(df.limit(0)).count() == 0
