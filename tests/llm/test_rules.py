"""Quality rules, mixing, decontamination, resampling and language id on small data."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusmill.llm import decontam, langid, mixing, quality, resample

# quality


def brute_measures(text):
    w = (text or "").encode().split()
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    dups = sum(x in lines[:i] for i, x in enumerate(lines))
    chars = sum(len(x.decode()) for x in w)
    return len(w), chars, sum(c in "#*$%&|<>" for c in text or ""), dups, len(covered)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("ab é\n\t#.\x0b\x85 "), max_size=60)), max_size=5))
def test_measures_equal_brute_force(texts):
    m = quality.measure([(t or "").encode() for t in texts])
    got = list(zip(*(m[k].tolist() for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))))
    assert got == [brute_measures(t) for t in texts]


def test_quality_query_equals_brute_force(spark, tiny):
    got = {r.doc_id: r for r in quality.query(spark, tiny).collect()}
    for d in spark.read.parquet(f"{tiny}/documents.parquet").collect():
        b, r = brute_measures(d.text), got[d.doc_id]
        assert tuple(r)[1:6] == b
        assert r.base_failed == (b[0] < 10 or 100 * b[4] > 20 * b[0])
        assert not (r.base_failed and r.kept)


@pytest.mark.parametrize(
    "line,rule",
    [
        ("A plain sentence, as it should be.", None),
        ("word### other*** more&&& and%%% this$$$", "symbols"),
        ("ALL OF THIS IS SHOUTED!!", "shouting"),
        ("Home", "navigation"),
        ("Home | About | Contact | Login", "navigation"),
        ("one two three four five six seven", "punctuation"),
        ("Please read our cookie policy first.", "boilerplate"),
        ("go go go go go go go go go go go.", "repetition"),
    ],
)
def test_line_rules(line, rule):
    assert quality.line_fails(line) == rule


def test_cleaning_keeps_columns(spark):
    good = "This is a clean sentence with more than ten words, as anyone can see.\nHome\nAnd one more of them, for the sake of it."
    rows = [(1, good, "a", 5, 1), (2, None, "b", 0, 2), (3, "x### " * 30, "c", 9, 3), (None, good, None, None, 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, kept int")
    got = quality.cleaned(df).collect()
    assert [r.kept for r in got] == [1, 4]
    assert "Home" not in got[0].text and got[0].n_chars == len(got[0].text)
    assert quality.cleaned(df.limit(0)).count() == 0
    assert [r.kept for r in quality.verdicts(df).orderBy("n_words").collect()].count(True) == 2


# mixing


def test_targets():
    t = mixing.targets({"b": 100, "a": 100, None: 10, "c": 400})
    assert t[None] == 20  # stops at twice its size
    assert t["a"] == 200 and sum(t.values()) == pytest.approx(1.5 * 610)
    assert t["b"] == 200 and t["c"] == pytest.approx(915 - 420)  # so does b, once the excess is shared
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0}


def test_flow_prefers_fresh_words():
    patterns = [(("a",), 100), (("a", "b"), 100), (("b",), 10)]
    flow = mixing.min_cost_flow(patterns, {"a": 100.0, "b": 110.0}, 2)
    assert flow == {(0, "a"): 100.0, (1, "b"): 100.0, (2, "b"): 10.0}  # nothing twice
    flow = mixing.min_cost_flow(patterns, {"a": 150.0, "b": 170.0}, 2)
    assert sum(w for (_, s), w in flow.items() if s == "a") == pytest.approx(150)
    assert sum(w for (_, s), w in flow.items() if s == "b") == pytest.approx(170)
    for i, (_, size) in enumerate(patterns):
        assert sum(w for (k, _), w in flow.items() if k == i) <= 2 * size + 1e-6


def cheapest(patterns, quota, repeats):
    """(words, cost) of the largest flow at the least cost, by Bellman-Ford one word at a time."""
    n, sources = len(patterns), list(quota)
    sink = 1 + n + len(sources)
    arcs = [[0, 1 + i, size, k + 1] for i, (_, size) in enumerate(patterns) for k in range(repeats)]
    arcs += [[1 + i, 1 + n + sources.index(s), 10**6, 0] for i, (who, _) in enumerate(patterns) for s in who]
    arcs += [[1 + n + j, sink, quota[s], 0] for j, s in enumerate(sources)]
    arcs = [a for u, v, c, w in arcs for a in ([u, v, c, w], [v, u, 0, -w])]
    words = cost = 0
    while True:
        far, came = {0: 0}, {}
        for _ in range(sink):
            for k, (u, v, room, w) in enumerate(arcs):
                if room and u in far and far[u] + w < far.get(v, 10**9):
                    far[v], came[v] = far[u] + w, k
        if sink not in far:
            return words, cost
        at = sink
        while at:
            k = came[at]
            arcs[k][2] -= 1
            arcs[k ^ 1][2] += 1
            at = arcs[k][0]
        words, cost = words + 1, cost + far[sink]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sets(st.sampled_from("abc"), min_size=1), st.integers(0, 6)), max_size=4), st.tuples(*[st.integers(0, 12)] * 3), st.integers(1, 3))
def test_flow_is_the_cheapest(patterns, quotas, repeats):
    patterns, quota = [(tuple(sorted(who)), n) for who, n in patterns], dict(zip("abc", quotas))
    flow = mixing.min_cost_flow(patterns, {k: float(v) for k, v in quota.items()}, repeats)
    taken = [sum(w for (i, _), w in flow.items() if i == k) for k in range(len(patterns))]
    cost = sum(min(size, max(0, t - k * size)) * (k + 1) for (_, size), t in zip(patterns, taken) for k in range(repeats))
    assert (round(sum(taken)), round(cost)) == cheapest(patterns, quota, repeats)
    assert all(t <= repeats * size + 1e-6 for (_, size), t in zip(patterns, taken))
    for s, q in quota.items():
        assert sum(w for (_, k), w in flow.items() if k == s) <= q + 1e-6


def test_targets_of_many_sources(spark):
    rng = np.random.default_rng(2)
    sizes = {f"s{i}é" if i % 3 else f"S{i}": int(rng.integers(0, 400) ** 2) for i in range(200)} | {None: 77}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long").repartition(5)
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = mixing.targets(sizes)
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_mix_of_more_sources_than_come_to_the_driver(spark):
    rows = [(i, "w " * (20 + i % 13), f"host{i % 40}") for i in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    few, many = (sorted(tuple(r) for r in mixing.mix(df, F.array("source"), p=mixing.Params(max_patterns=n)).collect()) for n in (1000, 10))
    assert few == many and sum(r[-1] for r in few) == pytest.approx(1.5 * sum(len(t.split()) for _, t, _ in rows), rel=0.05)


@pytest.mark.parametrize("ids", [lambda i: 7, lambda i: None, lambda i: i % 9])
def test_repeated_and_null_ids_are_taken_as_often_as_said(spark, ids):
    rows = [(ids(i), "same words" if i % 4 == 0 else "w " * (5 + i % 31), "ab"[i % 2], i % 3) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")
    taken = mixing.mix(df, F.array("source")).groupBy("source").agg(F.sum("taken").alias("n")).collect()
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words = Counter()
    for r in out.collect():
        words[r.source] += len(r.text.split())
    assert words == {r.source: r.n for r in taken}
    most = Counter((r.doc_id, r.text, r.source, r.copies) for r in out.collect())
    there = Counter(rows)
    assert all(n <= 2 * there[k] for k, n in most.items())


def test_mix_comes_near_and_reruns_agree(spark, tiny):
    rows = mixing.query(spark, tiny).collect()
    assert sorted(map(str, rows)) == sorted(map(str, mixing.query(spark, tiny).collect()))
    docs = spark.read.parquet(f"{tiny}/documents.parquet").collect()
    assert Counter(r.doc_id for r in rows) == Counter(d.doc_id for d in docs)
    want = mixing.targets({s: sum(r.size for r in rows if r.source == s) for s in {r.source for r in rows}})
    for s, t in want.items():
        own = [r for r in rows if r.source == s]
        assert all(r.target == pytest.approx(t) and 0 <= r.taken <= 2 * r.size for r in own)
        assert abs(sum(r.taken for r in own) - t) <= max(60, 0.03 * t)


def test_mix_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (3, "w " * 9000, "b"), (4, "x y", "b"), (4, "x y", "b"), (None, "z z z", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    got = mixing.mix(df, F.array("source")).collect()
    assert len(got) == 6 and all(r.taken <= 2 * r.size for r in got)
    again = mixing.mixed_documents(df)
    assert again.columns == df.columns and again.count() >= 2
    assert mixing.mix(df.limit(0), F.array("source")).count() == 0


def test_mix_with_overlapping_sources(spark):
    rows = [(i, "w " * (5 + i % 7), ["a"] if i % 3 == 0 else ["a", "b"] if i % 3 == 1 else []) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, who array<string>")
    got = mixing.mix(df, F.col("who"), quota={"a": 900.0, "b": 500.0}).filter("source IS NOT NULL").groupBy("source").agg(F.sum("taken").alias("n")).collect()
    assert {r.source: r.n for r in got}["a"] == pytest.approx(900, abs=15)
    assert {r.source: r.n for r in got}["b"] == pytest.approx(500, abs=15)


# decontamination


def test_containment_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocabulary, n))) for i, n in enumerate([1, 3, 2, 5, 6, 9, 12, 20, 60])] + [(90, None), (91, "")]
    docs = []
    for i in range(120):
        parts = [" ".join(rng.choice(vocabulary, rng.integers(1, 80)))]
        if i % 2:
            w = items[i % 9][1].split()
            for _ in range(i % 4 if i % 5 else 0):
                w[rng.integers(len(w))] = "Other,"
            parts.insert(i % 3, " ".join(w).upper() + "!")
        docs.append((i, " ".join(parts)))
    docs += [(203, " ".join(["lead"] * 30 + [items[1][1], *["tail"] * 30])), (204, "lead " * 30 + items[0][1]), (205, "lead " * 30 + items[2][1] + "?")]
    docs += [(200, items[1][1]), (201, None), (202, ""), (None, items[8][1]), (7, docs[7][1])]

    def grams(t):
        import regex

        w = regex.findall(r"[\p{L}\p{M}\p{N}]+", (t or "").lower())
        return [{tuple(w[k : k + n]) for k in range(len(w) - n + 1)} for n in range(1, 6)]

    want = set()
    for i, t in docs:
        runs = set().union(*grams(t))
        for k, q in items:
            g = next((x for x in reversed(grams(q)) if x), set())  # of five words, or the whole of a shorter item
            if g and len(g & runs) * 100 >= 80 * len(g):
                want.add((i, k, len(g), len(g & runs)))
    assert {(203, 1), (204, 0), (205, 2)} <= {w[:2] for w in want}  # short items in longer texts
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    b = spark.createDataFrame(items, "item_id long, text string")
    for p in (decontam.Params(), decontam.Params(broadcast_rows=0)):
        got = [tuple(r)[:4] for r in decontam.contained(d, b, p=p).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    kept = [r.doc_id for r in decontam.decontaminate(d, b).collect()]
    hit = {w[0] for w in want}
    assert sorted(x for x in kept if x is not None) == sorted(i for i, _ in docs if i is not None and i not in hit)
    assert decontam.contained(d.limit(0), b).count() == 0 and decontam.contained(d, b.limit(0)).count() == 0


# resampling


def test_kth_largest(spark):
    values = [float(x) for x in np.random.default_rng(0).normal(size=500)] + [0.25] * 40
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 7, 200, 539, 540):
        assert resample.kth_largest(df, "v", k, bins=8) == sorted(values, reverse=True)[k - 1]
    assert resample.kth_largest(df, "v", 0) is None and resample.kth_largest(df, "v", 541) is None


def test_features_stay_in_their_text():
    b, n = resample.features([b"a b", b"", b"b", b"A b"], 1000)
    assert n.tolist() == [3, 0, 1, 3]
    assert b[:3].tolist() == b[4:].tolist() and b[3] == b[2]


def test_resampling_prefers_the_target(spark):
    docs = [(i, ("good plain words here " if i % 2 else "junk spam $$$ now ") * 10) for i in range(200)] + [(300, None), (300, None), (None, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2 == 1) for i in range(0, 60)] + [(1, True), (None, True), (3, None)], "doc_id long, wanted boolean")
    got = resample.resample(df, labels).collect()
    assert len(got) == len(docs)
    chosen = [r.doc_id for r in got if r.selected]
    assert abs(len(chosen) - 101) <= 2 and sum(1 for i in chosen if i and i < 200 and i % 2 == 0) <= 1
    assert all(r.log_weight == 0 for r in got if r.doc_id == 300)
    assert all(r.selected for r in resample.resample(df, labels.limit(0)).collect())
    assert resample.resample(df.limit(0), labels).count() == 0


# language id


def test_held_out_accuracy(spark, tiny):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    got = [r for r in langid.query(spark, tiny).collect()]
    assert len(got) == len(truth)
    out = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_odd_rows(spark):
    rows = [(i, "the cat and the dog" if i % 2 else "der hund und die katze", "en" if i % 2 else "de") for i in range(40)]
    rows += [(50, None, "en"), (51, "123 !?", "en"), (52, "the dog", None), (None, "die katze", "de"), (53, "und " * 30_000, "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    model = langid.fit(df, F.lit(True))
    got = {r.doc_id: r for r in langid.predict(df, model).collect()}
    assert got[50].lang_pred == got[51].lang_pred == "und" and got[50].score == 0
    assert got[52].lang_pred == "en" and got[None].lang_pred == "de" and got[53].lang_pred == "de"
    far = langid.predict(df, model, p=langid.Params(reject_below=1.1)).collect()
    assert {r.lang_pred for r in far} == {"und"}
    assert {r.lang_pred for r in langid.predict(df, langid.fit(df, F.lit(False))).collect()} == {"und"}
    assert langid.predict(df.limit(0), model).count() == 0
