"""Language-model scores against a plain Python model."""

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusmill.llm import lm
from corpusmill.llm.common import held_out


def tokens(text):
    return [*(text or "").encode().lower().split(), "end"]


def brute(rows, order, mu):
    """{index: (held_out, n_tokens, n_known, N, base, score)} for rows of (id, text)."""
    counts = [Counter() for _ in range(order)]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    for (_, text), out in zip(rows, held):
        if not out:
            t = ["begin", *tokens(text)]
            for m in range(1, order + 1):
                counts[m - 1].update(tuple(t[k : k + m]) for k in range(len(t) - m + 1))
    begins = counts[0][("begin",)]
    n = sum(counts[0].values()) - begins
    v = len(counts[0]) - (begins > 0)

    def p(ctx, w):
        if not ctx:
            return (counts[0][(w,)] + 1) / (n + v + 1)
        c, m = counts[len(ctx) - 1][ctx], mu[len(ctx) - 1]
        return (counts[len(ctx)][(*ctx, w)] + m * p(ctx[1:], w)) / (c + m)

    out = []
    for (_, text), h in zip(rows, held):
        t = ["begin", *tokens(text)]
        score = sum(math.log10(p(tuple(t[max(0, k - order + 1) : k]), t[k])) for k in range(1, len(t)))
        base = sum(math.log10(p((), w)) for w in t[1:])
        out.append((h, len(t) - 1, sum(counts[0][(w,)] > 0 for w in t[1:]), n, base, score))
    return out


@pytest.mark.parametrize("order,fan", [(1, 256), (2, 256), (3, 256), (2, 2), (3, 3)])
def test_scores_equal_brute_force(spark, order, fan):
    words = "the of a The cat dog runs, sleeps. and é".split()
    rows = [(i, " ".join(words[(i * k * k + k) % (3 + i % 7)] for k in range(i % 23))) for i in range(60)]
    rows += [(100, None), (None, "the cat"), (7, "the cat"), (101, "never seen words"), (102, "the of " * 3000)]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double").repartition(3)
    p = lm.Params(order=order, mu=(4.0, 2.0), block_words=50, keys_a_range=40, fan=fan)
    got = lm.score(df, ~held_out(F.col("doc_id"), 7), p=p).collect()
    want = brute(rows, order, p.mu)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert len(got) == len(rows)
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(((i, *w) for (i, _), w in zip(rows, want)), key=key)):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


def test_pieces_grow_with_the_blocks(spark):
    """Not with their square: a block has about as many pieces at every size, and a level more for 256 times the blocks."""
    p = lm.Params()
    for n in (10, 1000, 10**5, 10**7, 10**9):
        n_levels, bits = lm.levels(n, 200, p)
        assert 2 ** (n_levels * bits) * p.keys_a_range >= n * p.block_words and p.fan**n_levels >= n
        assert 2**bits <= 256 and n_levels <= 4

    made = []
    p = lm.Params(block_words=30, keys_a_range=60, fan=4)
    for n in (40, 160):
        df = spark.createDataFrame([(i, " ".join(f"w{(i * k) % 97}" for k in range(40))) for i in range(n)], "doc_id long, text string").repartition(2)
        blocks = lm._blocks(df, F.lit(True), "doc_id", "text", p)
        n_blocks = blocks.count()
        n_levels, bits = lm.levels(n_blocks, 2, p)
        rows, pieces = 0, lm._named(blocks, n_levels, bits, p)
        for level in range(1, n_levels + 1):
            pieces = pieces.persist()
            rows += pieces.count()
            if level < n_levels:
                pieces = lm._met(pieces, level, lm.PIECES, False, bits, 4, p)
        made.append(rows / n_blocks / n_levels)
    assert made[1] < 1.6 * made[0]


def test_probabilities_sum_to_one():
    import numpy as np

    rows = [b"a b a c", b"b a", b"c c c a"]
    vocabulary = [b"a", b"b", b"c"]
    probe = lm.Block.of([*rows, *vocabulary, b"zz"], [False] * 3 + [True] * 4)
    probe.count(2)
    n = int(probe.counts[0].sum() - probe.counts[0][0])
    v = int((probe.counts[0][1:] > 0).sum())
    probe.automaton([c.astype(float) for c in probe.counts], n, v, (3.0,))
    words = [1, *(2 + k for k in range(len(probe.hashes) - 2))]
    for state in set(range(probe.n_states)) - {probe.root_next[1]}:  # no text goes on after its end
        total = 0.0
        for w in words:
            s, p = state, 0.0
            while s and s * len(probe.hashes) + w not in probe.arcs:
                p, s = p + probe.back[s], probe.fail[s]
            p += probe.arc_p[probe.arcs[s * len(probe.hashes) + w]] if s else probe.root_arc[w]
            total += 10**p
        assert np.isclose(total, 1)  # zz stands for the one unseen word


def test_held_out_text_is_likelier_than_by_unigrams(spark, tiny):
    r = lm.query(spark, tiny).filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(df, ~held_out(F.col("doc_id"), 7)).count() == 0
    only = spark.createDataFrame([(i, "x y") for i in range(60)], "doc_id long, text string").filter(held_out(F.col("doc_id"), 7))
    assert {r.score for r in lm.score(only, F.lit(False)).collect()} == {0.0}
