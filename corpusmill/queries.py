"""The library's registered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import repair, webpage
from corpusmill.functions import text as T
from corpusmill.functions.lexicons import FLAGGED, LANGUAGE_NAMES, PUNCTUATION, PUNCTUATION_MAP, SPACE_CLASS, STOPWORDS, WIDE_SPACES, WITH_FLAGGED, WITH_STOPWORDS, special_characters
from corpusmill.operators import boilerplate, features, language, minhash, perplexity, quality, sampling
from corpusmill.operators.components import connected_components
from corpusmill.session import spread
from corpusmill.sources import files

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_table(spark, sf_dir, "documents"))


def _add(name: str, query: Callable[[DataFrame], DataFrame], sql: str | None = None) -> None:
    """A query over documents alone."""
    _QUERIES[name] = lambda spark, sf_dir: query(_docs(spark, sf_dir))
    if sql:
        _SQL[name] = sql


def _add_tables(name: str, query: Query, sql: str | None = None) -> None:
    _QUERIES[name] = query
    if sql:
        _SQL[name] = sql


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(items) -> str:
    return "(" + ", ".join(map(_quoted, items)) + ")"


# Texts and tokens

_CLEAN = f"trim(regexp_replace(translate(lower(text), {_quoted(PUNCTUATION)}, ''), '{SPACE_CLASS}+', ' ', 'g'))"
_TOKENS = f"list_filter(regexp_extract_all({_CLEAN}, '[A-Za-z0-9]+|[^A-Za-z0-9]'), lambda x: trim(x) <> '')"


def _words_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '{SPACE_CLASS}+'), lambda w: w <> '')"


def _grams_sql(items: str, n: int) -> str:
    return f"list_transform(range(1, len({items}) - {n - 2}), lambda i: array_to_string({items}[i:i + {n - 1}], ' '))"


def _digest(items: Column) -> list[Column]:
    return [F.size(items).cast("long").alias("n_items"), F.md5(F.array_join(items, "\x01")).alias("items_md5")]


def _digest_sql(items: str) -> str:
    return f"SELECT doc_id, len(x)::BIGINT AS n_items, md5(array_to_string(x, chr(1))) AS items_md5 FROM (SELECT doc_id, {items} AS x FROM documents)"


def _items(make: Callable[[Column], Column]) -> Callable[[DataFrame], DataFrame]:
    return lambda d: d.select("doc_id", make(F.col("text")).alias("x")).select("doc_id", *_digest(F.col("x")))


_add("clean_text", lambda d: d.select("doc_id", F.md5(T.clean(F.col("text"))).alias("clean_md5")), f"SELECT doc_id, md5({_CLEAN}) AS clean_md5 FROM documents")
_add("tokens_simple", _items(T.tokens), _digest_sql(_TOKENS))
_add("tokens_simple_limited", _items(lambda c: T.tokens(c, 10_000)), _digest_sql(f"{_TOKENS}[1:10000]"))
_add("words_clean", _items(lambda c: T.words(T.clean(c))), _digest_sql(_words_sql(_CLEAN)))
_add("split_on_space", _items(lambda c: T.split_on_space(c, True, True)), _digest_sql("list_filter(regexp_split_to_array(text, '[ \\n\\t]+'), lambda w: w <> '')"))
_STRIPPED = f"list_filter(list_transform(list_filter(regexp_split_to_array(lower(text), '[ \\n\\t]+'), lambda w: w <> ''), lambda w: trim(w, {_quoted(PUNCTUATION)})), lambda w: w <> '')"
_add("document_words", _items(T.words_of_document), _digest_sql(_STRIPPED))
_add("stripped_lines", _items(T.stripped_lines), _digest_sql(f"list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^{SPACE_CLASS}+|{SPACE_CLASS}+$', '', 'g')), lambda x: x <> '')"))


def _shingle_query(n: int, items: Callable[[Column], Column]) -> Callable[[DataFrame], DataFrame]:
    def run(d: DataFrame) -> DataFrame:
        w = d.select("doc_id", items(F.col("text")).alias("w")).select("doc_id", F.transform(T.ngrams(F.col("w"), n), lambda g: F.array_join(g, " ")).alias("g"))
        return w.select("doc_id", F.size(F.array_distinct("g")).cast("long").alias("n_shingles"))

    return run


def _shingle_sql(n: int, items: str) -> str:
    return f"SELECT doc_id, len(list_distinct({_grams_sql('w', n)}))::BIGINT AS n_shingles FROM (SELECT doc_id, {items} AS w FROM documents)"


_add("shingles_5", _shingle_query(5, T.tokens), _shingle_sql(5, _TOKENS))
_add("shingles_13", _shingle_query(13, lambda c: T.words(T.clean(c))), _shingle_sql(13, _words_sql(_CLEAN)))
_add("shingles_13_limited", _shingle_query(13, lambda c: F.slice(T.words(T.clean(c)), 1, 1000)), _shingle_sql(13, f"{_words_sql(_CLEAN)}[1:1000]"))
_add(
    "adaptive_shingles",
    lambda d: d.select("doc_id", T.words(T.clean(F.col("text"))).alias("w")).select("doc_id", T.adaptive_shingles(F.col("w"), 13).alias("x")).select("doc_id", *_digest(F.col("x"))),
    "SELECT doc_id, len(x)::BIGINT AS n_items, md5(array_to_string(x, chr(1))) AS items_md5 FROM (SELECT doc_id, CASE WHEN len(w) > 0 THEN"
    f" list_transform(range(1, len(w) - least(len(w), 13) + 2), lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' ')) ELSE [] END AS x FROM (SELECT doc_id, {_words_sql(_CLEAN)} AS w FROM documents))",
)
_add(
    "adaptive_shingles_characters",
    lambda d: d.select("doc_id", T.characters(F.col("text")).alias("w")).select("doc_id", T.adaptive_shingles(F.col("w"), 5, "").alias("x")).select("doc_id", *_digest(F.col("x"))),
    f"WITH c AS (SELECT doc_id, list_filter(string_split({_CLEAN}, ''), lambda c: c <> '') AS w FROM documents), e AS (SELECT doc_id, unnest(w) AS ch, generate_subscripts(w, 1) AS pos FROM c),"
    f" g AS (SELECT doc_id, pos, ch || {' || '.join(f'lead(ch, {k}) OVER w' for k in range(1, 5))} AS gram FROM e WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),"
    " a AS (SELECT doc_id, count(gram) AS n, string_agg(gram, chr(1) ORDER BY pos) AS s FROM g GROUP BY doc_id)"
    " SELECT doc_id, CASE WHEN len(w) >= 5 THEN n ELSE least(len(w), 1) END::BIGINT AS n_items, md5(CASE WHEN len(w) >= 5 THEN s ELSE array_to_string(w, '') END) AS items_md5 FROM c LEFT JOIN a USING (doc_id)",
)

_HASH32 = "('0x' || substr({0}, 7, 2) || substr({0}, 5, 2) || substr({0}, 3, 2) || substr({0}, 1, 2))::BIGINT"
_add("sha1_hash32", lambda d: d.select("doc_id", T.sha1_hash32(F.col("text")).alias("h")), f"SELECT doc_id, {_HASH32.format('s')} AS h FROM (SELECT doc_id, sha1(text) AS s FROM documents)")
_add("text_checksums", lambda d: d.select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("n_bytes")), "SELECT doc_id, sha256(text) AS sha256, strlen(text)::BIGINT AS n_bytes FROM documents")

_one = {a: b for a, b in PUNCTUATION_MAP.items() if len(b) == 1}
_many = {a: b for a, b in PUNCTUATION_MAP.items() if len(b) > 1}
_NORMAL = f"regexp_replace(translate(lower(regexp_replace(regexp_replace(text, '[\\x00-\\x1f\\x7f-\\x{{9f}}]', '', 'g'), '^{SPACE_CLASS}+|{SPACE_CLASS}+$', '', 'g')), {_quoted(WIDE_SPACES)}, {_quoted(' ' * len(WIDE_SPACES))}), '\\p{{Nd}}', '0', 'g')"
_NORMAL = f"translate({_NORMAL}, {_quoted(''.join(_one))}, {_quoted(''.join(_one.values()))})"
for _a, _b in _many.items():
    _NORMAL = f"replace({_NORMAL}, {_quoted(_a)}, {_quoted(_b)})"
_add("normalized_text", lambda d: d.select("doc_id", F.md5(T.normalized(F.col("text"))).alias("normal_md5")), f"SELECT doc_id, md5({_NORMAL}) AS normal_md5 FROM documents")

_WRONG = ("http", "www", ".com", "href", "//")
_P = _quoted(PUNCTUATION)
_RIGHT = " AND ".join(f"NOT contains(trim(w, {_P}), {_quoted(s)})" for s in _WRONG)


def _each_word_sql(text: str, keep: str) -> str:
    fields = f"list_filter(list_transform(string_split(l, chr(9)), lambda f: list_filter(string_split(f, ' '), lambda w: w <> '' AND {keep})), lambda f: len(f) > 0)"
    lines = f"list_filter(list_transform(string_split({text}, chr(10)), lambda l: {fields}), lambda l: len(l) > 0)"
    return f"array_to_string(list_transform({lines}, lambda l: array_to_string(list_transform(l, lambda f: array_to_string(f, ' ')), chr(9))), chr(10))"


_SHORT = f"(length(w) <= 25 OR (length(trim(w, {_P})) > 0 AND length(trim(w, {_P})) <= 25))"
_add(
    "modify_documents",
    lambda d: d.select("doc_id", F.md5(T.modified(F.col("text"))).alias("modified_md5")),
    f"SELECT doc_id, md5({_each_word_sql('t', _SHORT)}) AS modified_md5 FROM (SELECT doc_id, {_each_word_sql(f'translate(text, {_quoted(WIDE_SPACES)}, {_quoted(chr(32) * len(WIDE_SPACES))})', _RIGHT)} AS t FROM documents)",
)
_add("nfc_normalize", lambda d: d.select("doc_id", F.md5(repair.nfc(F.col("text"))).alias("nfc_md5")), "SELECT doc_id, md5(nfc_normalize(text)) AS nfc_md5 FROM documents")
_add("fix_text", lambda d: d.filter(F.length("text") > 0).select("doc_id", repair.fixed(F.col("text")).alias("text")))

# Filters

_add("nonempty_text", lambda d: d.filter(F.length("text") > 0).select("doc_id"), "SELECT doc_id FROM documents WHERE text IS NOT NULL AND text <> ''")
_add("short_doc_filter", lambda d: quality.long_enough(d).select("doc_id"), f"SELECT doc_id FROM documents WHERE length(translate(text, {_quoted(PUNCTUATION)} || ' ' || chr(10) || chr(9) || chr(13), '')) >= 200")

# Features

_SPECIAL = _list(sorted(c for c in special_characters() if c != "\0"))
_CHAR_SQL = f"""
c AS (SELECT doc_id, text, string_split(text, '') AS cs FROM documents),
e AS (SELECT doc_id, unnest(cs) AS ch, generate_subscripts(cs, 1) AS pos FROM c),
n AS (SELECT doc_id, lower(ch) AS ch, count(*) AS k FROM e GROUP BY ALL),
s AS (SELECT doc_id, sum(k) FILTER (ch IN {_SPECIAL}) / sum(k) AS special, sum(k) AS total, log2(sum(k)) - sum(k * log2(k)) / sum(k) AS entropy FROM n GROUP BY doc_id),
g AS (SELECT doc_id, ch || {" || ".join(f"lead(ch, {k}) OVER w" for k in range(1, 10))} AS gram FROM e WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
gc AS (SELECT doc_id, gram, count(*) AS k FROM g WHERE gram IS NOT NULL GROUP BY ALL),
gr AS (SELECT doc_id, k, row_number() OVER (PARTITION BY doc_id ORDER BY k DESC) AS r, count(*) OVER (PARTITION BY doc_id) AS u,
    count(*) FILTER (k > 1) OVER (PARTITION BY doc_id) AS again, sum(k) OVER (PARTITION BY doc_id) AS total FROM gc),
rep AS (SELECT doc_id, coalesce(sum(k) FILTER (r <= least(floor(sqrt(u)), u - again)), 0) / any_value(total) AS rep FROM gr GROUP BY doc_id),
f AS (SELECT doc_id, length(text)::BIGINT AS document_length, round(coalesce(rep, 0), 3) AS character_repetition_ratio,
    round(coalesce(special, 0), 3) AS special_character_ratio, round(coalesce(entropy, 0), 3) AS char_entropy FROM c LEFT JOIN s USING (doc_id) LEFT JOIN rep USING (doc_id))
"""
_add("doc_features_char", features.char_features, f"WITH {_CHAR_SQL} SELECT * FROM f")
_add(
    "doc_features_char_limited",
    lambda d: features.char_features(d, max_chars=1000),
    f"WITH {_CHAR_SQL.replace("string_split(text, '')", "string_split(substring(text, 1, 1000), '')")} SELECT * FROM f",
)


def _ratio_sql(words: tuple[str, ...]) -> str:
    return f"CASE WHEN len(w) > 0 THEN least(1.0, len(list_filter(w, lambda x: x IN {_list(words)})) / len(w)) ELSE 0.0 END::DOUBLE"


_add(
    "doc_features_word",
    features.word_features,
    f"""WITH d AS (SELECT doc_id, {_STRIPPED} AS w FROM documents),
wc AS (SELECT doc_id, count(*) AS k FROM (SELECT doc_id, unnest(w) AS x FROM d) GROUP BY doc_id, x),
we AS (SELECT doc_id, abs(log2(sum(k)) - sum(k * log2(k)) / sum(k)) AS entropy FROM wc GROUP BY doc_id),
gc AS (SELECT doc_id, count(*) AS k FROM (SELECT doc_id, unnest({_grams_sql("w", 5)}) AS x FROM d) GROUP BY doc_id, x),
ge AS (SELECT doc_id, coalesce(sum(k) FILTER (k > 1), 0) / sum(k) AS rep FROM gc GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS number_of_words, round(coalesce(rep, 0), 3) AS word_repetition_ratio, round({_ratio_sql(STOPWORDS["en"])}, 3) AS stopword_ratio,
    round({_ratio_sql(FLAGGED["en"])}, 3) AS flagged_word_ratio, round(coalesce(entropy, 0), 3) AS word_entropy FROM d LEFT JOIN we USING (doc_id) LEFT JOIN ge USING (doc_id)""",
)

# Languages

_SPC_STRIP = f"regexp_replace(x, '^{SPACE_CLASS}+|{SPACE_CLASS}+$', '', 'g')"
_LINES_SQL = f"list_filter(list_transform(string_split(text, chr(10)), lambda x: {_SPC_STRIP}), lambda x: x <> '')"
_HITS = " UNION ALL ".join(f"SELECT doc_id, i, w, '{lang}' AS lang, len(list_filter(w, lambda x: x IN {_list(words)})) AS n FROM lw" for lang, words in sorted(STOPWORDS.items()))
_LANG_SQL = f"""
ls AS (SELECT doc_id, {_LINES_SQL} AS l FROM documents),
lx AS (SELECT doc_id, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM ls),
lw AS (SELECT doc_id, i, {_words_sql("translate(lower(x), '.,;:!?', '')")} AS w FROM lx),
h AS ({_HITS}),
b AS (SELECT doc_id, i, len(w) AS nw, n, CASE WHEN n > 0 THEN lang ELSE 'und' END AS lang, CASE WHEN len(w) > 0 THEN n / len(w) ELSE 0.0 END AS score,
    row_number() OVER (PARTITION BY doc_id, i ORDER BY n DESC, h.lang) AS k FROM h),
dist AS (SELECT doc_id, lang, count(*) / sum(count(*)) OVER (PARTITION BY doc_id) AS frequency, round(median(score), 3) AS median_score FROM b WHERE k = 1 GROUP BY doc_id, lang),
top AS (SELECT doc_id, lang AS top1_lang, frequency AS top1_lang_freq, median_score AS top1_lang_median FROM dist QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY frequency DESC, lang) = 1)
"""


def _rounded(dist: DataFrame, *cols: str) -> DataFrame:
    return dist.withColumns({c: F.round(c, 6) for c in cols})


_add("lang_distribution", lambda d: _rounded(language.distribution(d), "frequency"), f"WITH {_LANG_SQL} SELECT doc_id, lang, round(frequency, 6) AS frequency, median_score FROM dist")
_add(
    "lang_distribution_limited",
    lambda d: _rounded(language.distribution(d, lines=100), "frequency"),
    f"WITH {_LANG_SQL.replace(f'{_LINES_SQL} AS l', f'{_LINES_SQL}[1:100] AS l')} SELECT doc_id, lang, round(frequency, 6) AS frequency, median_score FROM dist",
)
_SAMPLED = f"""lz AS (SELECT doc_id, {_LINES_SQL} AS l FROM documents), ly AS (SELECT doc_id, unnest(l) AS x, generate_subscripts(l, 1) - 1 AS i FROM lz),
ls AS (SELECT doc_id, list(x) AS l FROM (SELECT * FROM ly QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY ('0x' || substr(md5('7:' || doc_id || ':' || i), 1, 8))::BIGINT, i) <= 20) GROUP BY doc_id),"""
_add(
    "lang_distribution_sampled",
    lambda d: _rounded(language.distribution(d, lines=20, seed=7), "frequency"),
    f"WITH {_LANG_SQL.replace(f'ls AS (SELECT doc_id, {_LINES_SQL} AS l FROM documents),', _SAMPLED)} SELECT doc_id, lang, round(frequency, 6) AS frequency, median_score FROM dist",
)
_add("top1_lang", lambda d: _rounded(language.top1(language.distribution(d)), "top1_lang_freq"), f"WITH {_LANG_SQL} SELECT doc_id, top1_lang, round(top1_lang_freq, 6) AS top1_lang_freq, top1_lang_median FROM top")
_add(
    "lang_share_top10",
    lambda d: _rounded(language.shares(language.top1(language.distribution(d))), "share"),
    f"WITH {_LANG_SQL} SELECT top1_lang AS lang, count(*)::BIGINT AS n_docs, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM top GROUP BY top1_lang ORDER BY n_docs DESC, lang LIMIT 10",
)
_add(
    "explore_language",
    lambda d: quality.language_violations(language.top1(language.distribution(d))).select("doc_id", "top1_lang"),
    f"WITH {_LANG_SQL} SELECT doc_id, top1_lang FROM top WHERE top1_lang_freq <= 0.65 AND top1_lang_median <= 0.75",
)

# Keep and drop

#: Scores of the stop-word scorer are shares of stop words, so its bound is lower than that of a classifier.
_PROFILE = quality.FilterProfile(lang_score_min=0.1)
_KEEP = (
    "document_length BETWEEN 100 AND 100000000 AND character_repetition_ratio <= 0.4 AND special_character_ratio <= 0.5 AND char_entropy >= 3.0"
    " AND top1_lang_freq >= 0.4 AND top1_lang_median >= 0.1"
)


def _decided(d: DataFrame) -> DataFrame:
    """Both kinds of features in one pass over the texts, without a shuffle."""
    top = ("top1_lang_freq", "top1_lang_median")
    found = features.char_features(language.with_top1(d.select("doc_id", "text")), carried=top)
    keep = quality.keep_condition(_PROFILE)
    return found.withColumn("keep", keep).withColumn("drop", ~F.col("keep"))


_add("keep_drop", lambda d: _decided(d).select("doc_id", "keep", "drop"), f"WITH {_CHAR_SQL}, {_LANG_SQL} SELECT doc_id, coalesce({_KEEP}, false) AS keep, NOT coalesce({_KEEP}, false) AS drop FROM f LEFT JOIN top USING (doc_id)")
_add(
    "explore_violations",
    lambda d: quality.violations(features.char_features(d)),
    f"""WITH {_CHAR_SQL} SELECT doc_id, 'repetition' AS reason FROM f WHERE character_repetition_ratio > 0.4 UNION ALL SELECT doc_id, 'entropy' FROM f WHERE char_entropy < 3
UNION ALL SELECT doc_id, 'special' FROM f WHERE special_character_ratio > 0.5 UNION ALL SELECT doc_id, 'length' FROM f WHERE document_length < 100 OR document_length > 10000000""",
)
_add(
    "violation_report",
    lambda d: sampling.violation_report(d, quality.violations(features.char_features(d))),
    f"""WITH {_CHAR_SQL}, v AS (SELECT doc_id, 'repetition' AS reason FROM f WHERE character_repetition_ratio > 0.4 UNION ALL SELECT doc_id, 'entropy' FROM f WHERE char_entropy < 3
UNION ALL SELECT doc_id, 'special' FROM f WHERE special_character_ratio > 0.5 UNION ALL SELECT doc_id, 'length' FROM f WHERE document_length < 100 OR document_length > 10000000)
SELECT source AS file_name, source || '-' || doc_id || chr(10) || '[' || string_agg(reason, ',' ORDER BY reason) || ']' || chr(10) || any_value(text) || chr(10) || repeat('*', 100) AS value
FROM v JOIN documents USING (doc_id) GROUP BY source, doc_id""",
)
_add(
    "zscore_outliers",
    lambda d: quality.without_outliers(features.char_features(d), ("document_length", "char_entropy")).select("doc_id"),
    f"WITH {_CHAR_SQL}, s AS (SELECT avg(document_length) AS ml, stddev_pop(document_length) AS sl, avg(char_entropy) AS me, stddev_pop(char_entropy) AS se FROM f)"
    " SELECT doc_id FROM f, s WHERE (document_length - ml) / nullif(sl, 0) < 3 AND (char_entropy - me) / nullif(se, 0) < 3".replace(", s AS (", ", st AS (").replace("FROM f, s ", "FROM f, st "),
)
_add(
    "feature_histogram",
    lambda d: sampling.histogram(d.select(F.length("text").alias("n")), "n"),
    "WITH x AS (SELECT length(text)::DOUBLE AS n FROM documents), m AS (SELECT min(n) AS a, max(n) AS b FROM x)"
    " SELECT CASE WHEN b > a THEN least(floor((n - a) / ((b - a) / 100)), 99) ELSE 0 END::INTEGER AS bin, count(*)::BIGINT AS n_rows FROM x, m GROUP BY ALL",
)

# Near-duplicates


def _perms_sql(p: minhash.MinHashParams) -> str:
    a, b = minhash.permutations(p.num_perm, p.seed)
    return ", ".join(f"({i}, {x}::HUGEINT, {y}::HUGEINT)" for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())))


def _sig_sql(p: minhash.MinHashParams) -> str:
    items = (_TOKENS if p.unit == "token" else _words_sql(_CLEAN)) + (f"[1:{p.max_len}]" if p.max_len else "")
    return f"""
perm(i, a, b) AS (VALUES {_perms_sql(p)}),
toks AS (SELECT doc_id, {items} AS w FROM documents),
shin AS (SELECT DISTINCT doc_id, unnest({_grams_sql("w", p.ngram)}) AS g FROM toks),
hs AS (SELECT doc_id, {_HASH32.format("sha1(g)")}::HUGEINT AS h FROM shin),
mins AS (SELECT doc_id, i, min(((((h * a) % 18446744073709551616 + b) % 18446744073709551616) % 2305843009213693951)::BIGINT & 4294967295) AS v FROM hs, perm GROUP BY ALL),
sig AS (SELECT doc_id, coalesce(list(v ORDER BY i) FILTER (v IS NOT NULL), list_transform(range({p.num_perm}), lambda x: 4294967295::BIGINT)) AS s FROM documents LEFT JOIN mins USING (doc_id) GROUP BY doc_id)
"""


def _band_sql(p: minhash.MinHashParams) -> str:
    n, r = minhash.optimal_param(p.threshold, p.num_perm)
    return f"{_sig_sql(p)}, band AS (SELECT doc_id, k::INTEGER AS band, md5(array_to_string(s[k * {r} + 1:k * {r} + {r}], ',')) AS band_hash FROM sig, range({n}) t(k)), star AS (SELECT DISTINCT doc_id AS src, m AS dst FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY band, band_hash) AS m FROM band) WHERE doc_id <> m)"


_COMPONENTS_SQL = """
sym AS (SELECT src AS a, dst AS b FROM star UNION SELECT dst, src FROM star),
reach(id, r) AS (SELECT DISTINCT a, a FROM sym UNION SELECT sym.b, reach.r FROM reach JOIN sym ON sym.a = reach.id),
comp AS (SELECT id, min(r) AS component FROM reach GROUP BY id)
"""


def _banded(d: DataFrame, p: minhash.MinHashParams = minhash.SIMPLE) -> DataFrame:
    return minhash.bands(minhash.signatures(d, p), p)


_S = minhash.SIMPLE
_add(
    "minhash_signature",
    lambda d: minhash.signatures(d).select("doc_id", F.md5(F.array_join("signature", ",")).alias("signature_md5"), F.aggregate("signature", F.lit(0).cast("long"), lambda a, x: a + x).alias("signature_sum")),
    f"WITH {_sig_sql(_S)} SELECT doc_id, md5(array_to_string(s, ',')) AS signature_md5, list_sum(s)::BIGINT AS signature_sum FROM sig",
)
_add("lsh_bands", _banded, f"WITH {_band_sql(_S)} SELECT doc_id, band, band_hash FROM band")
_add("duplicate_pairs", lambda d: minhash.star_edges(minhash.stored_bands(d)), f"WITH {_band_sql(_S)} SELECT src, dst FROM star")
_add(
    "lsh_candidates",
    lambda d: minhash.candidates_of(minhash.stored_bands(d), d.filter("doc_id % 50 = 0")),
    f"WITH {_band_sql(_S)} SELECT DISTINCT a.doc_id AS src, b.doc_id AS dst FROM band a JOIN band b USING (band, band_hash) WHERE a.doc_id % 50 = 0 AND a.doc_id > b.doc_id",
)
_add("connected_components", lambda d: minhash.clusters(d), f"WITH RECURSIVE {_band_sql(_S)}, {_COMPONENTS_SQL} SELECT id AS doc_id, component FROM comp")
_add("dedup_near", lambda d: minhash.dedup(d).select("doc_id"), f"WITH RECURSIVE {_band_sql(_S)}, {_COMPONENTS_SQL} SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT id FROM comp WHERE id <> component)")
for _name, _p in (("dedup_near_main", minhash.MAIN), ("dedup_near_limited", minhash.SIMPLE_LIMITED), ("dedup_near_main_limited", minhash.MAIN_LIMITED)):
    _add(
        _name,
        lambda d, p=_p: minhash.dedup(d, p).select("doc_id"),
        f"WITH RECURSIVE {_band_sql(_p)}, {_COMPONENTS_SQL} SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT id FROM comp WHERE id <> component)",
    )
_add_tables(
    "optimal_param",
    lambda spark, _: spark.createDataFrame([(t, 128, *minhash.optimal_param(t, 128)) for t in (0.7, 0.8)], "threshold double, num_perm int, bands int, rows int"),
    "SELECT * FROM (VALUES (0.7::DOUBLE, 128, 14, 9), (0.8::DOUBLE, 128, 9, 13)) t(threshold, num_perm, bands, rows)",
)
_add("dedup_exact", lambda d: sampling.exact_dedup(d).select("doc_id"), "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
_add_tables(
    "components_of_edges",
    lambda spark, d: connected_components(_table(spark, d, "orders").select(F.col("o_custkey").cast("long").alias("src"), F.shiftleft(F.floor(F.col("o_custkey") / 64), 6).cast("long").alias("dst"))).select("id", "component"),
    "WITH RECURSIVE e AS (SELECT DISTINCT o_custkey::BIGINT AS a, (o_custkey // 64 * 64)::BIGINT AS b FROM orders WHERE o_custkey <> o_custkey // 64 * 64), sym AS (SELECT a, b FROM e UNION SELECT b, a FROM e),"
    " reach(id, r) AS (SELECT DISTINCT a, a FROM sym UNION SELECT sym.b, reach.r FROM reach JOIN sym ON sym.a = reach.id) SELECT id, min(r) AS component FROM reach GROUP BY id",
)


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    return sampling.dedup_stats(d, sampling.exact_dedup(d))


_add_tables("dedup_stats", _stats, "SELECT count(*)::BIGINT AS n_before, count(DISTINCT text)::BIGINT AS n_after, (count(*) - count(DISTINCT text))::BIGINT AS n_dup, round((count(*) - count(DISTINCT text)) / count(*), 6) AS dup_ratio FROM documents")


def _dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    kept = sampling.exact_dedup(d).select("doc_id")
    duplicates = d.select("doc_id").join(kept, "doc_id", "left_anti")
    left = quality.survivors(d, _decided(d).filter("keep").select("doc_id"), duplicates)
    return left.groupBy(F.col("source").alias("file_name")).agg(F.count(F.lit(1)).alias("n_survivors"))


_add_tables(
    "dry_run_survivors",
    _dry_run,
    f"WITH {_CHAR_SQL}, {_LANG_SQL}, k AS (SELECT doc_id FROM f LEFT JOIN top USING (doc_id) WHERE {_KEEP}) SELECT source AS file_name, count(*)::BIGINT AS n_survivors FROM documents"
    " WHERE doc_id IN (SELECT doc_id FROM k) AND doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text) GROUP BY source",
)

# Boilerplate

_DF_SQL = f"df AS (SELECT word, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest({_words_sql('text')}) AS word FROM documents) GROUP BY word), idf AS (SELECT word, df, 1 + ln((SELECT count(*) FROM documents) / df) AS idf FROM df)"
_add("idf", lambda d: _rounded(boilerplate.idf(d), "idf"), f"WITH {_DF_SQL} SELECT word, df, round(idf, 6) AS idf FROM idf")
_add(
    "idf_topk_partial",
    lambda d: _rounded(boilerplate.idf(d, topk=50, file_col="source"), "idf"),
    f"WITH p AS (SELECT source, word, count(*) AS df FROM (SELECT DISTINCT source, doc_id, unnest({_words_sql('text')}) AS word FROM documents) GROUP BY source, word),"
    " t AS (SELECT word, sum(df)::BIGINT AS df FROM (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY source ORDER BY df DESC, word) <= 50) GROUP BY word)"
    " SELECT word, df, round(1 + ln((SELECT count(*) FROM documents) / df), 6) AS idf FROM t",
)
_CUT = 4.0
_CUTS_SQL = f"""{_DF_SQL},
l AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
x AS (SELECT doc_id, len(ls) AS n, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS pos FROM l),
w AS (SELECT doc_id, pos, unnest({_words_sql("line")}) AS word FROM x WHERE pos >= greatest(n - 5, 0)),
m AS (SELECT doc_id, pos, avg(coalesce(idf, 20)) AS mean FROM w LEFT JOIN idf USING (word) GROUP BY doc_id, pos),
cut AS (SELECT doc_id, 0 AS start_index, min(pos)::INTEGER AS end_index FROM m WHERE mean < {_CUT} GROUP BY doc_id)
"""


def _cuts(d: DataFrame) -> DataFrame:
    return boilerplate.tail_cuts(d, boilerplate.idf(d), _CUT)


_add("tail_trim_idf", _cuts, f"WITH {_CUTS_SQL} SELECT * FROM cut")
_add(
    "tail_trim_text",
    lambda d: boilerplate.trimmed(d, _cuts(d)).select("doc_id", F.md5("text").alias("text_md5")),
    f"WITH {_CUTS_SQL} SELECT doc_id, md5(CASE WHEN end_index IS NULL THEN text ELSE array_to_string(string_split(text, chr(10))[1:end_index], chr(10)) END) AS text_md5 FROM documents LEFT JOIN cut USING (doc_id)",
)
_add("tail_trim_minhash", boilerplate.tail_cuts_minhash)

# Perplexity

_SEG = "array_to_string(l[{0}:{1}], chr(10))"
_add(
    "perplexity_segments",
    lambda d: d.select("doc_id", perplexity.segments(F.col("text")).alias("s")).select("doc_id", *(F.md5(f"s.{p}").alias(f"{p}_md5") for p in ("start", "middle", "end"))),
    f"SELECT doc_id, md5({_SEG.format('len(l) // 20 + 1', 'len(l) // 2')}) AS start_md5, md5(CASE WHEN len(l) // 2 < len(l) // 20 * 19 THEN {_SEG.format('len(l) // 2 + 1', 'len(l) // 20 * 19')} ELSE '' END) AS middle_md5,"
    f" md5({_SEG.format('len(l) // 20 * 19 + 1', 'len(l)')}) AS end_md5 FROM (SELECT doc_id, {_LINES_SQL} AS l FROM documents)",
)


def _perplexities(d: DataFrame, max_token: int | None = None) -> DataFrame:
    return perplexity.perplexities(d, perplexity.byte_scorer(perplexity.fit_bytes(d)), max_token=max_token)


def _perplexity_parts(d: DataFrame, max_token: int | None = None) -> DataFrame:
    parts = ("start", "middle", "end")
    found = _perplexities(d, max_token)
    rounded = [F.col(f"perplexity_{p}.perplexity").alias(f"{p}_perplexity") for p in parts]
    return found.select("doc_id", *rounded, *(F.col(f"perplexity_{p}.num_token").cast("long").alias(f"{p}_tokens") for p in parts), F.col("total_num_token").cast("long").alias("total_num_token"))


def _perplexity_sql(limit: str = "") -> str:
    """Bytes and their bigrams by hex; a text begins after a line break."""
    hexes = "list_transform(range(1, length({0}) // 2 + 1), lambda i: substr({0}, 2 * i - 1, 2))"
    seg = ", ".join(f"{_SEG.format(*ab)} AS x_{p}" for p, ab in {"start": ("len(l) // 20 + 1", "len(l) // 2"), "end": ("len(l) // 20 * 19 + 1", "len(l)")}.items())
    middle = f"CASE WHEN len(l) // 2 < len(l) // 20 * 19 THEN {_SEG.format('len(l) // 2 + 1', 'len(l) // 20 * 19')} ELSE '' END AS x_middle"
    parts = " UNION ALL ".join(f"SELECT doc_id, '{p}' AS part, '0A' || hex(encode(x_{p})) AS h FROM seg" for p in ("start", "middle", "end"))
    return f"""WITH tx AS (SELECT '0A' || hex(encode(coalesce(text, ''))) AS h FROM documents), tb AS (SELECT {hexes.format("h")} AS b FROM tx),
pairs AS (SELECT unnest(list_transform(range(1, len(b)), lambda i: b[i] || b[i + 1])) AS g FROM tb),
n AS (SELECT g, count(*) AS k FROM pairs GROUP BY g), tot AS (SELECT substr(g, 1, 2) AS a, sum(k) + 256 AS t FROM n GROUP BY 1),
seg AS (SELECT doc_id, {seg}, {middle} FROM (SELECT doc_id, {_LINES_SQL} AS l FROM documents) WHERE len(l) > 0),
sp AS ({parts}), sb AS (SELECT doc_id, part, {hexes.format("h")}{limit} AS b FROM sp),
sg AS (SELECT doc_id, part, len(b) AS m, unnest(CASE WHEN len(b) > 1 THEN list_transform(range(1, len(b)), lambda i: b[i] || b[i + 1]) ELSE [NULL] END) AS g FROM sb),
sc AS (SELECT doc_id, part, any_value(m)::BIGINT AS m, coalesce(round(exp(-avg(CASE WHEN sg.g IS NOT NULL THEN ln((coalesce(k, 0) + 1) / coalesce(t, 256)) END)), 2), 1.0) AS p
    FROM sg LEFT JOIN n ON n.g = sg.g LEFT JOIN tot ON tot.a = substr(sg.g, 1, 2) GROUP BY doc_id, part)
SELECT doc_id, {", ".join(f"any_value(p) FILTER (part = '{p}') AS {p}_perplexity, any_value(m) FILTER (part = '{p}') AS {p}_tokens" for p in ("start", "middle", "end"))}, sum(m)::BIGINT AS total_num_token
FROM sc GROUP BY doc_id"""


_add("perplexity", _perplexity_parts, _perplexity_sql())
_UNDER = f"coalesce({_KEEP} AND round((start_perplexity + middle_perplexity + end_perplexity) / 3, 2) <= 14, false)"
_add(
    "keep_drop_joined",
    lambda d: quality.keep_drop(features.char_features(d), language.top1(language.distribution(d)), _perplexities(d), replace(_PROFILE, perplexity_max=14.0)).select("doc_id", "keep", "drop"),
    f"WITH {_CHAR_SQL}, {_LANG_SQL}, px AS ({_perplexity_sql()}) SELECT doc_id, {_UNDER} AS keep, NOT {_UNDER} AS drop FROM f LEFT JOIN top USING (doc_id) LEFT JOIN px USING (doc_id)",
)
_add("perplexity_fixed_length", lambda d: _perplexity_parts(d, 100), _perplexity_sql("[1:100]"))

# Splits, samples, shapes

_N = "row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1"
_add("split_chunks", lambda d: sampling.split_chunks(d, line_count=20), f"SELECT doc_id, source || '.' || lpad((({_N}) // 20)::VARCHAR, 3, '0') AS chunk FROM documents")
_add(
    "sample_snippets",
    lambda d: d.select("doc_id", T.snippets(F.col("text")).alias("s")).select("doc_id", *(F.md5(f"s.{p}").alias(f"{p}_md5") for p in ("start", "middle", "end"))),
    "SELECT doc_id, md5(substring(text, length(text) // 20 + 1, 100)) AS start_md5, md5(substring(text, length(text) // 2 + 1, 100)) AS middle_md5, md5(substring(text, length(text) * 19 // 20 + 1, 100)) AS end_md5 FROM documents",
)


def _cell(key: str, seed: int, cells: int) -> str:
    return f"(('0x' || substr(md5('{seed}:' || {key}::VARCHAR), 1, 8))::BIGINT % {cells})"


_add(
    "sample_sheet",
    lambda d: sampling.sample_sheet(d, first=20).select("file_name", F.col("line_index").cast("long").alias("line_index"), F.md5("start").alias("start_md5")),
    f"SELECT source AS file_name, n AS line_index, md5(substring(text, length(text) // 20 + 1, 100)) AS start_md5 FROM (SELECT *, {_N} AS n FROM documents) WHERE n = {_cell('source', 22, 20)}",
)
_add("first_lines", lambda d: d.select("doc_id", F.md5(F.array_join(F.slice(F.split("text", "\n"), 1, 3), "\n")).alias("first_md5")), "SELECT doc_id, md5(array_to_string(string_split(text, chr(10))[1:3], chr(10))) AS first_md5 FROM documents")
_add("holdout_split", lambda d: sampling.holdout(d).select("doc_id", "is_holdout"), f"SELECT doc_id, {_cell('doc_id', 42, 1000)} < 100 AS is_holdout FROM documents")
_WEIGHTS = {"src0": 2.0, "src1": 1.5, "src2": 0.25, "src3": 0.0}
_W_SQL = "CASE " + " ".join(f"WHEN source = '{s}' THEN {w}" for s, w in _WEIGHTS.items()) + " ELSE 1.0 END::DOUBLE"
_add(
    "interleave_shuffle",
    lambda d: sampling.interleaved(d, _WEIGHTS).select("doc_id", "copy", "shuffle_key"),
    f"SELECT doc_id, c::INTEGER AS copy, md5('42:' || doc_id || ':' || c) AS shuffle_key FROM (SELECT doc_id, unnest(range(1, (floor(w) + ({_cell('doc_id', 42, 1000000)} < (w - floor(w)) * 1000000)::INTEGER)::BIGINT + 1)) AS c FROM (SELECT doc_id, {_W_SQL} AS w FROM documents))",
)
_add("cycle_documents", lambda d: sampling.epochs(d, 3).select("doc_id", "epoch"), "SELECT doc_id, e::INTEGER AS epoch FROM documents, range(3) t(e) WHERE length(text) > 0")
_add(
    "to_meta_text",
    lambda d: files.to_meta_text(d.select("doc_id", "text", "lang", "source")).select(F.md5("text").alias("text_md5"), "meta"),
    """SELECT md5(text) AS text_md5, '{"doc_id":' || doc_id || ',"lang":' || coalesce('"' || lang || '"', 'null') || ',"source":' || coalesce('"' || source || '"', 'null') || '}' AS meta FROM documents""",
)


def _union(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = _docs(spark, sf_dir).select("doc_id", "text", "source")
    b = _table(spark, sf_dir, "conversations").select("text", "role")
    out = a.unionByName(b, allowMissingColumns=True)
    return out.groupBy("source", "role").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("text")).alias("n_chars"))


_add_tables(
    "union_sources",
    _union,
    "SELECT source, role, count(*)::BIGINT AS n_rows, sum(length(text))::BIGINT AS n_chars FROM (SELECT source, NULL AS role, text FROM documents UNION ALL SELECT NULL, role, text FROM conversations) GROUP BY source, role",
)


def _decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sampling.holdout(_docs(spark, sf_dir))
    return sampling.not_in_holdout(d.filter(~F.col("is_holdout")), d.filter("is_holdout")).select("doc_id")


_add_tables(
    "train_holdout_decontam",
    _decontam,
    f"WITH h AS (SELECT *, {_cell('doc_id', 42, 1000)} < 100 AS o FROM documents) SELECT doc_id FROM h WHERE NOT o AND text NOT IN (SELECT text FROM h WHERE o)",
)


def _resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    return files.not_done(d.select("source", "doc_id"), d.filter("source IN ('src0', 'src1')").select("source").distinct(), ("source",)).select("doc_id")


_add_tables("resume_filter", _resume, "SELECT doc_id FROM documents WHERE source NOT IN ('src0', 'src1')")
_add(
    "keep_sets",
    lambda d: sampling.id_sets(d.filter("n_chars >= 100")).select(F.col("file_name").alias("source"), "part", F.size("ids").cast("long").alias("n_ids"), F.md5(F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")).alias("ids_md5")),
    "SELECT source, doc_id // 10000 AS part, count(DISTINCT doc_id)::BIGINT AS n_ids, md5(string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id)) AS ids_md5 FROM documents WHERE n_chars >= 100 GROUP BY source, part",
)
_add_tables("html_to_text", lambda spark, d: _table(spark, d, "pages").select("page_id", webpage.extracted(F.col("html")).alias("text")))



def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of each language with its name, and whether it has lists."""
    table = [(c, n, c in WITH_STOPWORDS, c in WITH_FLAGGED) for c, n in LANGUAGE_NAMES.items()]
    known = spark.createDataFrame(table, "code string, name string, stopwords boolean, flagged boolean")
    n = _docs(spark, sf_dir).groupBy(T.without_prefix(F.concat(F.lit("__label__"), F.col("lang"))).alias("lang")).agg(F.count(F.lit(1)).alias("n_docs"))
    return n.join(F.broadcast(known), n["lang"] == known["code"], "left").select("lang", "n_docs", "name", "stopwords", "flagged")


_LANGUAGES_SQL = ", ".join(f"({_quoted(c)}, {_quoted(n)}, {c in WITH_STOPWORDS}, {c in WITH_FLAGGED})" for c, n in LANGUAGE_NAMES.items())
_add_tables(
    "language_table",
    _languages,
    f"SELECT lang, n_docs, name, stopwords, flagged FROM (SELECT lang, count(*)::BIGINT AS n_docs FROM documents GROUP BY lang) LEFT JOIN (VALUES {_LANGUAGES_SQL}) t(code, name, stopwords, flagged) ON lang = code",
)
