"""The cleaning pipeline as named stages over working folders, and its command line.

Stages run in one fixed order; any subset can be named. Each writes Parquet
under the output folder and is skipped when it has been written to the end.

    python -m corpusmill.plans.stages INPUT OUTPUT [--stages split,norm,...] [--format jsonl|parquet]

INPUT is a folder of *.jsonl files of (text, meta), or Parquet of (doc_id, text,
...). Of JSON lines, split numbers the lines of each file and gives each
document its chunk; a document is then known by a doc_id over all files.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions import repair
from corpusmill.operators import features, language, minhash, perplexity, quality, sampling
from corpusmill.operators.components import connected_components
from corpusmill.session import scope, stored
from corpusmill.sources import files


@dataclass(frozen=True)
class Settings:
    """format: jsonl or parquet. Perplexities are looked at if the profile has perplexity_max."""

    profile: quality.FilterProfile = quality.FilterProfile(lang_score_min=0.1)
    dedup: minhash.MinHashParams = minhash.MAIN
    format: str = "parquet"
    line_count: int = 10_000


@dataclass
class Run:
    spark: SparkSession
    input: str
    output: str
    settings: Settings

    def read(self, stage: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.output}/{stage}")


def _split(r: Run) -> DataFrame:
    """(doc_id, text, ..., chunk). The doc_ids of JSON lines are the numbers of files and lines together."""
    if r.settings.format == "parquet":
        docs = r.spark.read.parquet(r.input)
        file_col = next((c for c in ("file_name", "source") if c in docs.columns), None)
        named = docs if file_col else docs.withColumn("file_name", F.lit("documents"))
        chunks = sampling.split_chunks(named.filter("doc_id IS NOT NULL"), file_col or "file_name", "doc_id", r.settings.line_count)
        return docs.join(chunks.dropDuplicates(["doc_id"]), "doc_id", "left")
    lines = files.documents_of(stored(files.read_lines(r.spark, r.input), "lines"))
    part = F.floor(F.col("doc_id") / r.settings.line_count).cast("string")
    stem = F.regexp_replace("file_name", r"\.[^.]*$", "")
    chunk = F.concat(stem, F.lit("."), F.when(F.length(part) < 3, F.lpad(part, 3, "0")).otherwise(part))
    names = lines.select("file_name").distinct()
    placed = names.withColumn("_file", F.row_number().over(Window.orderBy("file_name")) - 1)  # a row for each file
    own = lines.join(F.broadcast(placed), "file_name").withColumn("chunk", chunk).withColumnRenamed("doc_id", "line")
    return own.select(F.shiftleft("_file", 40).bitwiseOR(F.col("line")).alias("doc_id"), "file_name", "line", "text", "meta", "chunk")


def _norm(r: Run) -> DataFrame:
    docs = r.read("split") if files.stage_done(r.spark, f"{r.output}/split") else r.spark.read.parquet(r.input)
    return docs.filter(F.length("text") > 0).withColumn("text", repair.fixed(F.col("text")))


def _perplexity(r: Run) -> DataFrame:
    d = r.read("norm")
    return perplexity.perplexities(d, perplexity.byte_scorer(perplexity.fit_bytes(d)))


def _hash(r: Run) -> DataFrame:
    return minhash.signatures(r.read("norm"), r.settings.dedup)


def _duppair(r: Run) -> DataFrame:
    return minhash.star_edges(stored(minhash.band_keys(r.read("hash"), r.settings.dedup), "bands"))


def _baddoc(r: Run) -> DataFrame:
    used = r.settings.profile.perplexity_max is not None
    marks = r.read("perplexity").select("doc_id", "perplexity_avg") if used else None
    return quality.keep_drop(r.read("docfeat"), language.top1(r.read("lang")), marks, r.settings.profile)


def _dump(r: Run) -> DataFrame:
    return quality.survivors(r.read("norm"), r.read("baddoc").filter("keep"), r.read("dupdict"))


STAGES: dict[str, Callable[[Run], DataFrame]] = {
    "split": _split,
    "norm": _norm,
    "docfeat": lambda r: features.char_features(r.read("norm")),
    "lang": lambda r: language.distribution(r.read("norm")),
    "perplexity": _perplexity,
    "hash": _hash,
    "duppair": _duppair,
    "dupconn": lambda r: connected_components(r.read("duppair")),
    "dupdict": lambda r: r.read("dupconn").filter("id <> component").select(F.col("id").alias("doc_id")),
    "baddoc": _baddoc,
    "dump": _dump,
}


def run(spark: SparkSession, source: str, output: str, stages: list[str] | None = None, settings: Settings = Settings()) -> list[str]:
    """Run the named stages in their fixed order; returns those that had not been done."""
    wanted = list(STAGES) if stages is None else list(stages)
    if stages is None and settings.profile.perplexity_max is None:
        wanted.remove("perplexity")  # nothing would look at it
    if unknown := set(wanted) - STAGES.keys():
        raise ValueError(f"no such stage: {', '.join(sorted(unknown))}")
    r, done = Run(spark, source, output, settings), []
    for name, stage in STAGES.items():
        if name in wanted and not files.stage_done(spark, f"{output}/{name}"):
            with scope(spark):
                files.write_documents(stage(r), f"{output}/{name}")
            done.append(name)
    return done


def main() -> None:
    from corpusmill.session import build_session

    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    p.add_argument("input")
    p.add_argument("output")
    p.add_argument("--stages", help="comma-separated; all by default")
    p.add_argument("--format", choices=["jsonl", "parquet"], default="jsonl", help="of the input")
    p.add_argument("--line-count", type=int, default=10_000, help="documents of a chunk")
    p.add_argument("--perplexity-max", type=float, help="drop documents above it")
    p.add_argument("--dump-zst", help="also write the documents that stay as .jsonl.zst here")
    a = p.parse_args()
    settings = Settings(quality.FilterProfile(lang_score_min=0.1, perplexity_max=a.perplexity_max), format=a.format, line_count=a.line_count)
    spark = build_session()
    print(*run(spark, a.input, a.output, a.stages.split(",") if a.stages else None, settings), sep="\n")
    if a.dump_zst:
        print(files.write_jsonl_zst(files.to_meta_text(spark.read.parquet(f"{a.output}/dump")), a.dump_zst), "documents")


if __name__ == "__main__":
    main()
