"""A corpus pipeline: quality rules, near-duplicates, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept. run() writes each stage's result as Parquet and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusmill.llm import decontam, mixing, neardup, pfor, quality
from corpusmill.llm.common import table
from corpusmill.session import drop_path, scope, write_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-first rules keep, without the lines that failed."""
    return quality.cleaned(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that 5-word similarities of 0.8 or more connect."""
    return neardup.dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' place, length and checksum in the token store."""
    return pfor.encoded(docs, pfor.tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
    ("token_ids", token_ids),
]

#: None: the MinHash candidates, the seeded mix and the tokenizer are beyond SQL. tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table. A stage's working tables go with it, its result once the next one is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scope(spark):
            path = write_table(made := stage(spark, docs, sf_dir), name)
        docs = spark.read.schema(made.schema).parquet(path)
        if before:
            drop_path(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
