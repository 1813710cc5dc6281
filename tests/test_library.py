"""The library's operators on small frames."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.functions import repair, webpage
from corpusmill.functions import text as T
from corpusmill.operators import boilerplate, features, language, minhash, perplexity, quality, sampling
from corpusmill.operators.components import connected_components
from corpusmill.plans import stages
from corpusmill.sources import files
from corpusmill.streaming import streams


def one(spark, make, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").repartition(1)
    return [r.x for r in df.select("i", make(F.col("text")).alias("x")).orderBy("i").collect()]


def test_clean_and_tokens(spark):
    assert one(spark, T.clean, "  A-b, C!　d\n ", None, "") == ["ab c d", None, ""]
    assert one(spark, T.tokens, "Añb1 中文!") == [["a", "ñ", "b1", "中", "文"]]
    assert one(spark, lambda c: T.words(c), "a b\t\nc") == [["a", "b", "c"]]


def test_ngrams_have_no_runs_of_short_lists(spark):
    got = one(spark, lambda c: F.size(T.ngrams(T.words(c), 5)), "a b c d", "a b c d e", "")
    assert got == [0, 1, 0]
    assert one(spark, lambda c: T.adaptive_shingles(T.words(c), 3), "a b", "a b c d") == [["a b"], ["a b c", "b c d"]]


def test_normalisation(spark):
    assert one(spark, T.normalized, " A B—c…１2\x07") == ["a b - c...00"]
    assert one(spark, T.modified, "see http://x now\n" + "y" * 30 + " ok") == ["see now\nok"]
    assert one(spark, T.sha1_hash32, "abc") == [910072233]


def test_repair():
    assert repair.fix_text("cafÃ© &amp; é “x” \r\nﬁ") == 'café & é "x" \nfi'
    assert repair.fix_text("naïve Ã") == "naïve Ã"
    assert webpage.main_text("<nav>n</nav><p>a <b>b</b></p><script>x</script><p>c &amp; d") == "a b\nc & d"
    assert webpage.main_text("") is None and webpage.main_text(None) is None


def test_char_features(spark):
    df = spark.createDataFrame([(1, "ab" * 40), (2, ""), (3, None), (4, "a1! ")], "doc_id long, text string")
    got = {r.doc_id: r for r in features.char_features(df).collect()}
    assert got[1].char_entropy == 1.0 and got[1].special_character_ratio == 0.0 and got[1].character_repetition_ratio == 0.0
    assert got[2].document_length == got[3].document_length == 0 and got[3].char_entropy == 0.0
    assert got[4].special_character_ratio == 0.75
    marks = spark.createDataFrame([(1, "a☃😀™é中")], "doc_id long, text string")
    assert features.char_features(marks).first().special_character_ratio == 0.5


def test_keep_is_inclusive_and_missing_fails(spark):
    cols = "doc_id long, document_length long, character_repetition_ratio double, special_character_ratio double, char_entropy double"
    f = spark.createDataFrame([(1, 100, 0.4, 0.5, 3.0), (2, 99, 0.1, 0.1, 4.0), (3, 100, 0.401, 0.1, 4.0), (4, 500, 0.1, 0.1, 4.0)], cols)
    lang = spark.createDataFrame([(1, 0.4, 0.6), (2, 1.0, 1.0), (3, 1.0, 1.0)], "doc_id long, top1_lang_freq double, top1_lang_median double")
    assert {r.doc_id: r.keep for r in quality.keep_drop(f, lang).collect()} == {1: True, 2: False, 3: False, 4: False}
    assert {(r.doc_id, r.reason) for r in quality.violations(f).collect()} == {(2, "length"), (3, "repetition")}


def test_parameters_and_permutations():
    assert minhash.optimal_param(0.7, 128) == (14, 9) and minhash.optimal_param(0.8, 128) == (9, 13)
    a, b = minhash.permutations(2, 42)
    assert (a.tolist(), b.tolist()) == ([2297359619001564596, 1973689801170867272], [1396682528897996046, 1819927849474927636])
    assert minhash.permutations(1, 1)[0].tolist() == [775169054918279404]


def test_signature_equals_big_integers():
    import hashlib

    a, b = minhash.permutations(128, 42)
    shingles = {"one two", "two three", "x"}
    h = [int.from_bytes(hashlib.sha1(s.encode()).digest()[:4], "little") for s in shingles]
    want = [min(((x * p % 2**64 + q) % 2**64) % (2**61 - 1) & 0xFFFFFFFF for x in h) for p, q in zip(a.tolist(), b.tolist())]
    assert minhash.signature(shingles, a, b).tolist() == want
    assert set(minhash.signature(set(), a, b).tolist()) == {minhash.MAX_HASH}


def test_near_dedup(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from the hungry wolf " * 6
    rows = [(1, base), (2, "short"), (3, base.replace("lazy", "Lazy!")), (4, "tiny text"), (5, "a wholly different text of more than five words here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ids = lambda d: sorted(r.doc_id for r in d.collect())
    assert ids(minhash.dedup(df)) == [1, 2, 5]  # texts without shingles are one cluster
    assert ids(minhash.dedup(df, short_docs="keep")) == [1, 2, 4, 5]
    assert ids(minhash.dedup(df, short_docs="drop")) == [1, 5]
    assert ids(minhash.dedup(minhash.dedup(df))) == [1, 2, 5]


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)] + [(200 + i, 201 + i) for i in range(70)] + [(500, 500), (7, None)]
    edges += [(900, 300 + i) for i in range(30)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_language_and_perplexity(spark):
    df = spark.createDataFrame([(1, "the cat and the dog\nder hund und die katze\nof the day"), (2, "\n \n"), (3, "zzz qqq")], "doc_id long, text string")
    dist = language.distribution(df)
    assert {(r.doc_id, r.lang): round(r.frequency, 3) for r in dist.collect()} == {(1, "en"): 0.667, (1, "de"): 0.333, (3, "und"): 1.0}
    assert {r.doc_id: r.top1_lang for r in language.top1(dist).collect()} == {1: "en", 3: "und"}
    assert language.as_map(dist).filter("doc_id = 1").first().language_distribution["en"].frequency == pytest.approx(2 / 3)
    got = perplexity.perplexities(df, perplexity.byte_scorer(perplexity.fit_bytes(df))).collect()
    assert {r.doc_id for r in got} == {1, 3} and all(np.isfinite(r.perplexity_avg) for r in got)
    lines = "\n".join(f"l{i}" for i in range(40))
    s = one(spark, perplexity.segments, lines, "a\nb")
    assert s[0].start.split("\n")[0] == "l2" and s[0].middle.count("\n") == 17 and s[0].end.split("\n")[0] == "l38"
    assert (s[1].start, s[1].middle, s[1].end) == ("a", "", "a\nb")


def test_tail_trimming(spark):
    docs = [(i, f"own{i} words{i} here{i}\n\nshared tail line") for i in range(8)]
    df = spark.createDataFrame([(i, t, "f") for i, t in docs], "doc_id long, text string, source string")
    cuts = boilerplate.tail_cuts(df, boilerplate.idf(df), 1.5)
    assert {(r.doc_id, r.end_index) for r in cuts.collect()} == {(i, 2) for i in range(8)}
    assert boilerplate.trimmed(df, cuts).filter("doc_id = 3").first().text == "own3 words3 here3\n"
    assert {(r.doc_id, r.end_index) for r in boilerplate.tail_cuts_minhash(df).collect()} == {(i, 2) for i in range(1, 8)}


def test_samples_and_shapes(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i}", "s") for i in range(50)], "doc_id long, text string, source string")
    assert sampling.split_chunks(df, line_count=20).filter("chunk = 's.002'").count() == 10
    assert sampling.interleaved(df, {"s": 2.0}).count() == 100 and sampling.interleaved(df, {"s": 0.0}).count() == 0
    assert sampling.histogram(df, "doc_id", 10).agg(F.sum("n_rows")).first()[0] == 50
    assert sampling.exact_dedup(df.union(df)).count() == 100  # rows that repeat their id too
    assert quality.without_outliers(df.withColumn("c", F.lit(1.0)), ("c",)).count() == 0
    assert files.to_meta_text(df).first().meta == '{"doc_id":0,"source":"s"}'
    with pytest.raises(ValueError):
        files.load(spark)
    (tmp_path / "a.jsonl").write_text('{"text": "x", "meta": {"u": 1}}\n{"text": "y", "meta": null}\n')
    rows = files.documents_of(files.read_lines(spark, str(tmp_path))).orderBy("doc_id").collect()
    assert [(r.file_name, r.doc_id, r.text) for r in rows] == [("a.jsonl", 0, "x"), ("a.jsonl", 1, "y")]
    assert rows[0].meta == '{"u":1}'
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "pages.json").write_text('["http://a", "<p>b</p>"]\nbroken\n')
    assert [r.text for r in files.pages_to_documents(files.read_pages(spark, f"{tmp_path}/p")).collect()] == ["b"]
    idfs = spark.createDataFrame([("null", 1.5), ('"', 2.0), ("nan", 3.0)], "word string, idf double")
    files.write_idf(idfs, f"{tmp_path}/idf")
    assert {r.word for r in files.read_idf(spark, f"{tmp_path}/idf").collect()} == {"null", '"', "nan"}


def test_lang_stage_judges_whole_texts(spark, tmp_path):
    text = "the cat and the dog\n" * 120 + "der hund und die katze\n" * 480
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/norm")
    got = stages.STAGES["lang"](stages.Run(spark, "", str(tmp_path), stages.Settings()))
    assert {r.lang: round(r.frequency, 3) for r in got.collect()} == {"de": 0.8, "en": 0.2}


def test_stages_of_json_lines_with_a_perplexity_bound(spark, tmp_path):
    import json

    rng = random.Random(1)
    (tmp_path / "in").mkdir()
    texts = [" ".join(rng.choice("the cat and the dog of that house were not here at all".split()) for _ in range(60)) for _ in range(25)]
    texts.append("".join(chr(rng.randrange(33, 127)) if k % 7 else " the of " for k in range(400)))  # of the language, but noise
    for name, part in (("b", texts[:12]), ("a", texts[12:])):
        (tmp_path / "in" / f"{name}.jsonl").write_text("".join(json.dumps({"text": t, "meta": {"n": i}}) + "\n" for i, t in enumerate(part)))
    lax = {"character_repetition_max": 1.0, "lang_freq_min": 0.0, "lang_score_min": 0.0, "char_entropy_min": 0.0}
    settings = stages.Settings(quality.FilterProfile(**lax, perplexity_max=6.0), format="jsonl", line_count=5)
    done = stages.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", settings=settings)
    assert done == list(stages.STAGES)
    rows = spark.read.parquet(f"{tmp_path}/out/split").orderBy("doc_id").collect()
    assert [(r.file_name, r.line, r.chunk) for r in rows[:7]] == [("a.jsonl", i, f"a.{i // 5:03d}") for i in range(7)]
    assert len({r.doc_id for r in rows}) == 26 and [r.text for r in rows] == texts[12:] + texts[:12]
    kept = {r.text for r in spark.read.parquet(f"{tmp_path}/out/dump").collect()}
    assert texts[-1] not in kept and len(kept) == 25
    n = files.write_jsonl_zst(files.to_meta_text(spark.read.parquet(f"{tmp_path}/out/dump").select("text", "line")), f"{tmp_path}/zst")
    assert n == 25 and {r.text for r in files.read_jsonl_zst(spark, f"{tmp_path}/zst").collect()} == kept


def test_zstd_sink(spark, tmp_path):
    df = spark.createDataFrame([(i, f"täxt\n{i}", {"u": "x"}) for i in range(50)] + [(90, None, None)], "doc_id long, text string, meta map<string,string>").repartition(3)
    assert files.write_jsonl_zst(df.select("text", F.to_json("meta").alias("meta")), f"{tmp_path}/all") == 51
    names = sorted(p.name for p in (tmp_path / "all").iterdir() if not p.name.startswith("."))
    assert names == ["_SUCCESS", *(f"part-{k:05d}.jsonl.zst" for k in range(3))]
    assert {r.text for r in files.read_jsonl_zst(spark, f"{tmp_path}/all").collect()} == {r.text for r in df.collect()}
    some = spark.createDataFrame([(3,), (3,), (7,), (1000,)], "doc_id long")
    assert files.write_subset_zst(df, f"{tmp_path}/some", some) == 2
    assert files.write_jsonl_zst(df.limit(0).select("text"), f"{tmp_path}/none") == 0 and files.read_jsonl_zst(spark, f"{tmp_path}/none").count() == 0


def seven_zip(name, data, method, header_packed):
    """A small archive of one file, written by the format's rules."""
    import lzma
    import struct
    import zlib

    def number(n):
        return bytes([n]) if n < 0x80 else b"\xff" + struct.pack("<Q", n)

    def packed(raw, m):
        if m == "copy":
            return raw, bytes([1]) + b"\x00"
        if m == "lzma2":
            return lzma.compress(raw, lzma.FORMAT_RAW, filters=[{"id": lzma.FILTER_LZMA2, "dict_size": 1 << 20}]), bytes([0x21]) + b"\x21" + number(1) + bytes([16])
        f = {"id": lzma.FILTER_LZMA1, "dict_size": 1 << 20, "lc": 3, "lp": 0, "pb": 2}
        return lzma.compress(raw, lzma.FORMAT_RAW, filters=[f]), bytes([0x23]) + b"\x03\x01\x01" + number(5) + bytes([93]) + struct.pack("<I", 1 << 20)

    def streams(at, size, coder, full):
        return bytes([6]) + number(at) + number(1) + bytes([9]) + number(size) + bytes([0, 7, 11]) + number(1) + b"\0" + number(1) + coder + bytes([12]) + number(full) + bytes([0, 0])

    body, coder = packed(data, method)
    names = (name + "\0").encode("utf-16-le")
    header = bytes([1, 4]) + streams(0, len(body), coder, len(data)) + bytes([5]) + number(1) + bytes([17]) + number(len(names) + 1) + b"\0" + names + bytes([0, 0])
    if header_packed:
        small, how = packed(header, "lzma")
        full, header = body + small, bytes([23]) + streams(len(body), len(small), how, len(header))
    else:
        full = body
    tail = struct.pack("<QQI", len(full), len(header), zlib.crc32(header))
    return b"7z\xbc\xaf\x27\x1c\0\4" + struct.pack("<I", zlib.crc32(tail)) + tail + full + header


def test_seven_zip_pages(spark, tmp_path):
    import json

    from corpusmill.sources import sevenzip

    lines = "".join(json.dumps([f"http://h/{i}", f"<p>page {i} ü</p>"]) + "\n" for i in range(3000)) + "broken\n"
    for k, (method, small) in enumerate([("copy", False), ("lzma", True), ("lzma2", True), ("lzma2", False)]):
        data = seven_zip("a.jsonl", lines.encode(), method, small)
        assert b"".join(sevenzip.first_file(data)).decode() == lines
        (tmp_path / f"{k}.7z").write_bytes(data)
    pages = files.read_archived_pages(spark, str(tmp_path))
    assert pages.count() == 4 * 3000 and pages.filter("url = 'http://h/7'").first().html == "<p>page 7 ü</p>"
    with pytest.raises(ValueError):
        next(sevenzip.first_file(b"something else" * 5))


def test_numbers_in_groups(spark):
    rows = [(("a", "b", None)[i % 3] if i % 5 else "a", i * 7919 % 1000) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, o long").repartition(5)
    want = {}
    for g, o in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        want.setdefault(g, []).append(o)
    got = sampling.numbered(df, "g", "o").collect()
    assert {(r.g, r.n): r.o for r in got} == {(g, k): o for g, os in want.items() for k, o in enumerate(os)}


def test_tail_cuts_equal_the_sequential_rule(spark):
    """Lines of a document after its cut, and the line that is cut at, are no earlier lines for the others."""
    rng = random.Random(9)
    lines = [f"tail line number {k} with some words of its own {k * 7}" for k in range(9)]
    docs = [(i, "\n".join([f"own{i} text"] + [rng.choice(lines) for _ in range(rng.randrange(1, 5))]), "fg"[i % 2]) for i in range(60)]
    p = minhash.MinHashParams(1, 0.8, 1, "raw")
    n, r = minhash.optimal_param(p.threshold, p.num_perm)
    a, b = minhash.permutations(p.num_perm, p.seed)
    want, seen = {}, {"f": set(), "g": set()}
    for i, text, file in docs:
        all_lines = text.split("\n")
        for at in range(max(0, len(all_lines) - 5), len(all_lines)):
            sig = minhash.signature(p.shingles(all_lines[at]), a, b).tolist()
            keys = {(k, tuple(sig[k * r : k * r + r])) for k in range(n)}
            if keys & seen[file]:
                want[i] = at
                break
            seen[file] |= keys
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    assert {r.doc_id: r.end_index for r in boilerplate.tail_cuts_minhash(df).collect()} == want


def test_whole_texts_by_default(spark):
    head = " ".join(f"w{k}" for k in range(11_000))
    df = spark.createDataFrame([(1, head), (2, head + " " + " ".join(f"v{k}" for k in range(30_000)))], "doc_id long, text string")
    ids = lambda p: sorted(r.doc_id for r in minhash.dedup(df, p).collect())
    assert ids(minhash.SIMPLE) == ids(minhash.MAIN) == [1, 2]
    assert ids(minhash.SIMPLE_LIMITED) == ids(minhash.MAIN_LIMITED) == [1]
    assert one(spark, lambda c: F.size(T.tokens(c)), head) == [11_000] and one(spark, lambda c: F.size(T.tokens(c, 10_000)), head) == [10_000]
    long = spark.createDataFrame([(1, "a" * 100_000 + "b" * 100_000)], "doc_id long, text string")
    assert features.char_features(long).first().char_entropy == 1.0
    assert features.char_features(long, max_chars=features.MAX_CHARS).first().char_entropy == 0.0


def test_gram_counts_are_exact():
    from collections import Counter

    rng = np.random.default_rng(6)
    for top, n in ((1, 30), (2, 200), (60, 3000), (90, 3000), (3000, 3000), (0x10FFFF, 500), (5, 9)):
        x = rng.integers(0, top, n).astype(np.uint32)
        x[n // 2 :] = x[: n - n // 2]
        want = Counter(tuple(x[k : k + 10].tolist()) for k in range(n - 9))
        assert sorted(features._gram_counts(x, 10).tolist()) == sorted(want.values())


def test_lists_labels_and_tokenizers(spark, tmp_path):
    from corpusmill.functions import lexicons

    (tmp_path / "sv.txt").write_text("och\natt\n\n det \n")
    (tmp_path / "more.json").write_text('{"nl": ["de", "het"]}')
    lists = lexicons.word_lists(spark, str(tmp_path))
    assert lists == {"sv": ("och", "att", "det"), "nl": ("de", "het")} and lexicons.words_for("xx", lists) is None
    df = spark.createDataFrame([(1, "och det var så\nhet de de")], "doc_id long, text string")
    dist = language.distribution(df, scorer=lambda line: language.stopword_scorer(line, lists), langs=[*lists, "und"])
    assert {r.lang for r in dist.collect()} == {"sv", "nl"}
    assert one(spark, T.without_prefix, "__label__en", "en") == ["en", "en"]
    assert one(spark, lambda c: T.pieces(c, lambda texts: [[w[:2] for w in t.split()] for t in texts]), "abc de", None) == [["ab", "de"], []]
    assert one(spark, lambda c: T.adaptive_shingles(T.characters(c), 2, ""), "中文 字", "中") == [["中文", "文 ", " 字"], ["中"]]


def test_working_tables_go_with_their_scope(spark):
    from corpusmill import session

    df = spark.range(3)
    with session.scope(spark):
        kept = session.stored(df, "gone")
        path = kept.inputFiles()[0]
        assert kept.count() == 3
    with pytest.raises(Exception, match="(?i)exist|found"):
        spark.read.parquet(path).count()
    assert session.stored(df, "stays").count() == 3


def test_small_tables_are_spread(spark, tmp_path):
    from corpusmill import session

    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/one")
    spark.range(100).repartition(9).write.parquet(f"{tmp_path}/many")
    one_file, many = spark.read.parquet(f"{tmp_path}/one"), spark.read.parquet(f"{tmp_path}/many")
    assert session.spread(one_file).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert session.spread(many) is many and sorted(r.id for r in session.spread(one_file).collect()) == list(range(100))


def test_entry_lives_without_optional_packages(tmp_path):
    """A package that only the subpackage needs is missing: the library's queries are still there."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import sys; sys.modules['xxhash'] = None\nimport __spark_entry__ as e\nq = e.queries(); assert 'dedup_near' in q and 'pipeline' not in q and not any(n.startswith('op1_') for n in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, env=os.environ | {"PYTHONPATH": root})


def test_stages_run_and_resume(spark, tiny, tmp_path):
    done = stages.run(spark, f"{tiny}/documents.parquet", str(tmp_path))
    assert done == [n for n in stages.STAGES if n != "perplexity"]  # no bound in the profile looks at it
    assert stages.run(spark, f"{tiny}/documents.parquet", str(tmp_path)) == []
    kept = spark.read.parquet(f"{tmp_path}/dump")
    assert 0 < kept.count() < 200
    with pytest.raises(ValueError):
        stages.run(spark, "x", "y", ["nope"])


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a" * 300), (2, "a" * 300), (3, "short"), (4, None)], "doc_id long, text string").withColumn("arrived", F.current_timestamp())
    rows.repartition(1).write.parquet(f"{tmp_path}/in")
    out = streams.first_of_each_text(streams.cleaned_stream(streams.read_stream(spark, f"{tmp_path}/in")))
    q = out.writeStream.format("memory").queryName("firsts").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    q.awaitTermination(120)
    assert spark.table("firsts").count() == 1


def test_queries_have_the_columns_of_their_sql(spark, tiny):
    import duckdb

    import __spark_entry__ as entry

    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "benchmark", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny}/{t}.parquet'")
    quick = ["clean_text", "tokens_simple", "keep_drop", "top1_lang", "tail_trim_idf", "holdout_split", "to_meta_text", "dedup_exact"]
    found, sql = entry.queries(), entry.oracle_sql()
    for name in quick:
        got = [tuple(r) for r in found[name](spark, tiny).select(*sorted(found[name](spark, tiny).columns)).collect()]
        want = con.execute(sql[name]).fetchdf()
        assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in want[sorted(want.columns)].astype(object).itertuples(index=False)), name
