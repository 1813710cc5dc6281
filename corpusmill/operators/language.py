"""Language profiles of documents from their lines, with a pluggable line scorer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions import text as T
from corpusmill.functions.lexicons import STOPWORDS
from corpusmill.operators.sampling import hash_share



def stopword_scorer(line: Column, lists: dict[str, tuple[str, ...]] = STOPWORDS) -> Column:
    """struct(lang, score): the language with most stop words in the line, and their share of the words."""
    w = T.words(F.translate(F.lower(line), ".,;:!?", ""))

    def hits(ws: Column, lang: str) -> Column:
        return F.struct((-F.size(F.filter(ws, lambda x: x.isin(*lists[lang])))).alias("n"), F.lit(lang).alias("lang"))

    def best(ws: Column) -> Column:
        top = F.least(*(hits(ws, lang) for lang in sorted(lists)))
        return F.struct(F.when(top["n"] < 0, top["lang"]).otherwise("und").alias("lang"), (F.when(F.size(ws) > 0, -top["n"] / F.size(ws)).otherwise(0.0)).alias("score"))

    return F.get(F.transform(F.array(w), best), F.lit(0))  # the words are split once


def scored_lines(docs: DataFrame, id_col: str, text_col: str, scorer: Callable[[Column], Column], lines: int | None, seed: int | None, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, scores, carried...): struct(lang, score) of each line that is scored, an array in the document's row."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"), *carried)
    found = T.stripped_lines(F.col("_text"))
    if lines is not None and seed is None:
        found = F.slice(found, 1, lines)
    elif lines is not None:
        order = lambda i: hash_share(F.concat_ws(":", F.col("doc_id").cast("string"), i.cast("string")), seed, 1 << 32)
        placed = F.array_sort(F.transform(found, lambda x, i: F.struct(order(i).alias("h"), i.alias("i"), x.alias("x"))))
        found = F.transform(F.slice(placed, 1, lines), lambda s: s["x"])
    return named.select("doc_id", F.transform(found, lambda x: scorer(x)).alias("scores"), *carried)


def _profile(scores: Column, langs: list[str]) -> Column:
    """struct(lang, n, median_score) for each language of the scores, by name."""

    def of(lang: str) -> Column:
        own = F.array_sort(F.transform(F.filter(scores, lambda s: s["lang"] == lang), lambda s: s["score"]))

        def middle(x: Column) -> Column:
            n = F.size(x)
            low, high = F.get(x, F.floor((n - 1) / 2).cast("int")), F.get(x, F.floor(n / 2).cast("int"))
            return F.struct(F.lit(lang).alias("lang"), n.cast("long").alias("n"), F.round((low + high) / 2, 3).alias("median_score"))

        return F.get(F.transform(F.array(own), middle), F.lit(0))  # sorted once

    return F.filter(F.array(*(of(lang) for lang in sorted(langs))), lambda s: s["n"] > 0)


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scorer: Callable[[Column], Column] = stopword_scorer, langs: list[str] | None = None, lines: int | None = None, seed: int | None = None, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, profile, n_lines, carried...): all in the document's row, without a shuffle. langs: all that the scorer can give."""
    scored = scored_lines(docs, id_col, text_col, scorer, lines, seed, carried)
    known = langs if langs is not None else [*STOPWORDS, "und"]
    return scored.select("doc_id", _profile(F.col("scores"), known).alias("profile"), F.size("scores").alias("n_lines"), *carried)


def distribution(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scorer: Callable[[Column], Column] = stopword_scorer, lines: int | None = None, seed: int | None = None, langs: list[str] | None = None) -> DataFrame:
    """(doc_id, lang, frequency, median_score): shares of the document's lines by language.

    All non-blank lines are scored, or at most `lines`: the first, or with a seed a seeded sample. Documents without lines have no row.
    """
    # outer, for else a filter on the profile's size is pushed down, and the lines are scored again for it
    flat = profiles(docs, id_col, text_col, scorer, langs, lines, seed).select("doc_id", "n_lines", F.explode_outer("profile").alias("p")).filter("p IS NOT NULL")
    return flat.select("doc_id", "p.lang", (F.col("p.n") / F.col("n_lines")).alias("frequency"), "p.median_score")


def with_top1(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines: int | None = None) -> DataFrame:
    """docs with top1_lang, top1_lang_freq and top1_lang_median, null for documents without lines; ties go to the first by name."""
    found = profiles(docs, id_col, text_col, lines=lines, carried=tuple(c for c in docs.columns if c != id_col))
    best = F.array_min(F.transform("profile", lambda p: F.struct((-p["n"] / F.col("n_lines")).alias("f"), p["lang"].alias("lang"), p["median_score"].alias("m"))))
    own = [F.col("doc_id").alias(id_col) if c == id_col else F.col(c) for c in docs.columns]
    return found.withColumn("_best", best).select(*own, F.col("_best.lang").alias("top1_lang"), (-F.col("_best.f")).alias("top1_lang_freq"), F.col("_best.m").alias("top1_lang_median"))


def as_map(dist: DataFrame) -> DataFrame:
    """(doc_id, language_distribution) with a map from language to its share and score."""
    entry = F.struct("lang", F.struct("frequency", "median_score"))
    return dist.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("language_distribution"))


def top1(dist: DataFrame) -> DataFrame:
    """(doc_id, top1_lang, top1_lang_freq, top1_lang_median); ties go to the first by name."""
    best = dist.groupBy("doc_id").agg(F.min(F.struct((-F.col("frequency")).alias("f"), "lang", "median_score")).alias("b"))
    return best.select("doc_id", F.col("b.lang").alias("top1_lang"), (-F.col("b.f")).alias("top1_lang_freq"), F.col("b.median_score").alias("top1_lang_median"))


def shares(top: DataFrame, n: int = 10) -> DataFrame:
    """(lang, n_docs, share) of the n most frequent languages."""
    counted = top.groupBy(F.col("top1_lang").alias("lang")).agg(F.count(F.lit(1)).alias("n_docs"))
    return counted.withColumn("share", F.col("n_docs") / F.sum("n_docs").over(Window.partitionBy())).orderBy(F.desc("n_docs"), "lang").limit(n)
