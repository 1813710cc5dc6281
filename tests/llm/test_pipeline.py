"""The pipeline's stages, each on what the one before it kept."""

import glob
import os

import pyarrow as pa
import regex

import corpus_pipeline
from corpusmill.llm import decontam, mixing, pfor, quality
from corpusmill.session import shared_dir


def similar_groups(texts):
    """The smallest index of each text's group."""
    root, sets = list(range(len(texts))), []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)})
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) * 5 >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    return root


def test_stages(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    columns, rows = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tiny)
        rows[name] = docs.collect()
        docs = spark.createDataFrame(rows[name], docs.schema)
        if name != "token_ids":
            assert docs.columns == columns
    start = spark.read.parquet(f"{tiny}/documents.parquet").collect()

    # quality: exactly what the measures keep
    m = quality.measure([(d.text or "").encode() for d in start], with_text=True)
    assert {r.doc_id: r.text for r in rows["quality_rules"]} == {d.doc_id: t for d, t, k in zip(start, m["text"], m["kept"]) if k}

    # near-duplicates: one of each group that 5-word similarities of 0.8 or more connect, the smallest id
    kept = sorted(rows["quality_rules"], key=lambda r: r.doc_id)
    root = similar_groups([r.text for r in kept])
    assert sorted(r.doc_id for r in rows["near_dedup"]) == [kept[i].doc_id for i in range(len(kept)) if root[i] == i]

    # decontamination
    def grams(t):
        w = regex.findall(r"[\p{L}\p{M}\p{N}]+", t.lower())
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    items = [grams(r.text) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    clean = [r.doc_id for r in rows["near_dedup"] if not any(g and len(g & grams(r.text)) * 100 >= decontam.Params().share_percent * len(g) for g in items)]
    assert sorted(r.doc_id for r in rows["decontamination"]) == sorted(clean)

    # mixing: whole documents, at most twice, near the targets
    size = {r.doc_id: len(r.text.encode().split()) for r in rows["decontamination"]}
    source = {r.doc_id: r.source for r in rows["decontamination"]}
    taken = {}
    for r in rows["mix_sources"]:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + 1
    assert taken.keys() <= size.keys() and max(taken.values()) <= 2
    goal = mixing.targets({s: sum(n for i, n in size.items() if source[i] == s) for s in set(source.values())})
    for s, t in goal.items():
        assert abs(sum(size[i] * n for i, n in taken.items() if source[i] == s) - t) <= max(150, 0.05 * t)

    # token ids
    encode = pfor.encoder(pfor.tokenizer_path())
    want = sorted((r.doc_id, int(encode(pa.array([r.text]))[1][0]) + 1) for r in rows["mix_sources"])
    assert sorted((r.doc_id, r.n_tokens) for r in rows["token_ids"]) == want


def test_run_equals_its_stages(spark, tiny):
    assert corpus_pipeline.run(spark, tiny).count() > 100


def odd_documents(spark, rows):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, `_id` int, copies string, n long"
    return spark.createDataFrame(rows, kinds)


def test_odd_rows_pass_all_stages(spark, tiny):
    """Nulls, empty texts, repeated and null ids, a very long text, and columns with names that stages use themselves."""
    good = "This is a clean sentence number {} with more than ten words in it, as anyone can plainly see."
    rows = [(i, good.format(i) * (1 + i % 3), "en", f"src{i % 3}", 9, 1, "x", 5) for i in range(30)]
    rows += [(5, rows[5][1], None, None, None, None, None, None), (None, good.format("none"), "en", None, 3, 2, "y", None), (None, None, None, None, None, None, None, None)]
    rows += [(40, None, "en", "src0", 0, 1, "x", 1), (41, "", "en", "src1", 0, 1, "x", 1), (42, "\n".join(f"Sentence {k} of a very long text, which never says the same twice." for k in range(30_000)), "en", "src2", 1, 1, "x", 1)]
    docs = odd_documents(spark, rows)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tiny)
        kept = out.collect()
        assert kept
        if name != "token_ids":
            assert out.columns == columns
            docs = spark.createDataFrame(kept, docs.schema)
    assert {r.doc_id for r in docs.collect()} <= {*range(30), 42, None}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_documents(spark, []), tiny).count() == 0


def test_run_leaves_one_table_of_texts(spark, tiny):
    """Working tables go with their stage; the last stage's input and the token store stay, for the result is read from them."""
    folder = shared_dir(spark).removeprefix("file:")
    before = {p for p in glob.glob(f"{folder}/tables-*/*")}
    corpus_pipeline.run(spark, tiny).count()
    left = {os.path.basename(p).rsplit("-", 1)[0] for p in glob.glob(f"{folder}/tables-*/*") if p not in before}
    assert left == {"mix_sources", "token-ids"}
