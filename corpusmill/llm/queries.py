"""The queries of this subpackage and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import decontam, html, langid, lm, mixing, pfor, quality, quotes, resample, simhash


#: Words of a text, and its lower case of A-Z alone.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: crc32 of doc_id as text, bit by bit for its table and byte by byte for the id.
_CRC = """crc AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: xor(a >> 1, (a & 1) * 3988292384))) AS t),
h AS (SELECT doc_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295::BIGINT) AS crc FROM (SELECT DISTINCT doc_id FROM documents), crc)"""

_QUALITY_SQL = rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
x AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4])) AS g, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5),
r AS (SELECT doc_id, i FROM x QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
n AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
k AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^ 	-
]') GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda t: length(t))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(w) < 10 OR 100 * coalesce(n, 0) > 20 * len(w) AS base_failed
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)"""

_LM_SQL = f"""WITH {_CRC}, d AS (SELECT doc_id, crc % 7 = 2 AS held_out, list_append({_WORDS.replace("coalesce(text, '')", _LOWER.format("coalesce(text, '')"))}, ' end') AS w FROM documents JOIN h USING (doc_id)),
t AS (SELECT doc_id, held_out, unnest(w) AS x FROM d), c AS (SELECT x, count(*) AS c FROM t WHERE NOT held_out GROUP BY x), s AS (SELECT sum(c) AS n, count(*) AS v FROM c)
SELECT doc_id, held_out, count(*)::BIGINT AS n_tokens, count(c)::BIGINT AS n_known, any_value(n)::BIGINT AS train_tokens,
    round(sum(log10((coalesce(c, 0) + 1) / (n + 1 * (v + 1)))), 6) AS base_score FROM t LEFT JOIN c USING (x), s GROUP BY doc_id, held_out"""

_MIX_SQL = f"""WITH d AS (SELECT doc_id, source, len({_WORDS}) AS size FROM documents),
s AS (SELECT source, sum(size) AS size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, [3.0, 1.0, 2.0][i % 3 + 1]::DOUBLE AS weight, 1.5 * sum(size) OVER () AS total FROM s),
o AS (SELECT *, 2 * size / weight AS ratio, coalesce(sum(2 * size) OVER p, 0) AS spent, sum(weight) OVER q AS free, row_number() OVER (ORDER BY 2 * size / weight, i) AS k FROM w
    WINDOW p AS (ORDER BY 2 * size / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), q AS (ORDER BY 2 * size / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (SELECT (total - spent) / free AS level, k FROM o WHERE (total - spent) / free <= ratio ORDER BY k LIMIT 1),
goal AS (SELECT source, size, CASE WHEN o.k < coalesce(level.k, 1000000) THEN 2.0 * size ELSE weight * level END AS target FROM o LEFT JOIN level ON true)
SELECT d.doc_id, d.size::BIGINT AS size, goal.size::BIGINT AS source_size, round(target, 6) AS target FROM d JOIN goal ON d.source IS NOT DISTINCT FROM goal.source"""

_LANGUAGE_SQL = rf"WITH {_CRC} SELECT doc_id, crc % 4 = 2 AS held_out, text IS NULL OR NOT regexp_matches(text, '\p{{L}}') AS unknown FROM documents JOIN h USING (doc_id)"


def _part(query: Callable[[SparkSession, str], DataFrame], *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    """Those columns of a query, as SQL expressions, that SQL can express."""
    return lambda spark, sf_dir: query(spark, sf_dir).selectExpr(*columns)


#: Each with its SQL: columns of the queries above that SQL can express, and quotation linking where there are quotes.
_PARTS = {
    "lm_base_scores": (_part(lm.query, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "round(base_score, 6) AS base_score"), _LM_SQL),
    "mixing_targets": (_part(mixing.query, "doc_id", "size", "source_size", "round(target, 6) AS target"), _MIX_SQL),
    "quality_base_measures": (_part(quality.query, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"), _QUALITY_SQL),
    "language_unknown": (_part(langid.query, "doc_id", "held_out", f"lang_pred = '{langid.UNKNOWN}' AS unknown"), _LANGUAGE_SQL),
    "quotation_linking_planted": (quotes.planted, quotes.PLANTED_SQL),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_ids": pfor.query,
        "op2_lm_score": lm.query,
        "op3_mixing": mixing.query,
        "op4_html_extraction": html.query,
        "op5_quotation_linking": quotes.query,
        "op6_decontamination": decontam.query,
        "op7_quality_rules": quality.query,
        "op8_importance_resampling": resample.query,
        "op9_simhash": simhash.query,
        "op10_language_id": langid.query,
        **{name: query for name, (query, _) in _PARTS.items()},
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_quotation_linking": quotes.SQL, "op6_decontamination": decontam.SQL, **{name: sql for name, (_, sql) in _PARTS.items()}}
