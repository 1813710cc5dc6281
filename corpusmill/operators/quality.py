"""Keep and drop decisions from features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.lexicons import PUNCTUATION


@dataclass(frozen=True)
class FilterProfile:
    """Inclusive bounds; a missing value fails its bound."""

    document_length_min: int = 100
    document_length_max: int = 100_000_000
    character_repetition_max: float = 0.4
    special_characters_max: float = 0.5
    char_entropy_min: float = 3.0
    lang_freq_min: float = 0.4
    lang_score_min: float = 0.6
    perplexity_max: float | None = None


PROFILES = {"default": None, "book-v2": FilterProfile()}


def keep_condition(p: FilterProfile, language: bool = True) -> Column:
    c = F.col("document_length").between(p.document_length_min, p.document_length_max)
    c = c & (F.col("character_repetition_ratio") <= p.character_repetition_max) & (F.col("special_character_ratio") <= p.special_characters_max)
    c = c & (F.col("char_entropy") >= p.char_entropy_min)
    if language:
        c = c & (F.col("top1_lang_freq") >= p.lang_freq_min) & (F.col("top1_lang_median") >= p.lang_score_min)
    if p.perplexity_max is not None:
        c = c & (F.col("perplexity_avg") <= p.perplexity_max)
    return F.coalesce(c, F.lit(False))


def keep_drop(features: DataFrame, languages: DataFrame | None = None, perplexities: DataFrame | None = None, p: FilterProfile = FilterProfile(), keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """features with keep and drop; languages(keys, top1_lang_freq, top1_lang_median) and perplexities(keys, perplexity_avg) are joined on."""
    out = features
    for more in (languages, perplexities):
        if more is not None:
            out = out.join(more, list(keys), "left")
    keep = keep_condition(p, languages is not None)
    return out.withColumn("keep", keep).withColumn("drop", ~F.col("keep"))


def violations(features: DataFrame, p: FilterProfile = FilterProfile(), longest: int = 10_000_000) -> DataFrame:
    """(doc_id, reason): a row for each feature that is out of bounds."""
    tests = {
        "repetition": F.col("character_repetition_ratio") > p.character_repetition_max,
        "entropy": F.col("char_entropy") < p.char_entropy_min,
        "special": F.col("special_character_ratio") > p.special_characters_max,
        "length": (F.col("document_length") < p.document_length_min) | (F.col("document_length") > longest),
    }
    reasons = F.array_compact(F.array(*(F.when(c, F.lit(r)) for r, c in tests.items())))
    return features.select("doc_id", F.explode(reasons).alias("reason"))


def language_violations(top1: DataFrame, freq: float = 0.65, score: float = 0.75) -> DataFrame:
    """Documents whose main language is both rare and unsure."""
    return top1.filter((F.col("top1_lang_freq") <= freq) & (F.col("top1_lang_median") <= score))


def long_enough(docs: DataFrame, least: int = 200, text_col: str = "text") -> DataFrame:
    """Documents with so many characters besides ASCII punctuation, spaces and tabs."""
    return docs.filter(F.length(F.translate(F.col(text_col), PUNCTUATION + " \n\t\r", "")) >= least)


def without_outliers(df: DataFrame, columns: tuple[str, ...], most: float = 3.0) -> DataFrame:
    """Rows whose z-score is below `most` in every column; a column without spread drops all rows."""
    stats = df.agg(*(f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))))
    z = [(F.col(c) - F.col(f"_m_{c}")) / F.nullif(F.col(f"_s_{c}"), F.lit(0.0)) < most for c in columns]
    keep = z[0]
    for c in z[1:]:
        keep = keep & c
    row = stats.first()  # one row of two numbers a column
    for name, value in row.asDict().items():
        keep_value = F.lit(None).cast("double") if value is None else F.lit(float(value))
        df = df.withColumn(name, keep_value)
    return df.filter(F.coalesce(keep, F.lit(False))).drop(*row.asDict())


def survivors(docs: DataFrame, keep: DataFrame, duplicates: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """docs in keep(keys) and not in duplicates(keys)."""
    return docs.join(keep.select(*keys), list(keys), "left_semi").join(duplicates.select(*keys), list(keys), "left_anti")
