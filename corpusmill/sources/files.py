"""Sources and sinks: documents as JSON lines, CSV and TSV tables, web pages, Parquet."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions import webpage
from corpusmill.operators.sampling import numbered
from corpusmill.sources import sevenzip

DOCUMENT = "text string, meta string"


def read_jsonl(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Documents of the *.jsonl files in a folder: (file_name, text, meta); meta is kept as JSON text."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    rows = spark.read.schema(DOCUMENT).option("mode", mode).option("pathGlobFilter", "*.jsonl").json(path)
    return rows.select(F.col("_metadata.file_name").alias("file_name"), "text", "meta")


def read_lines(spark: SparkSession, path: str, glob: str = "*.jsonl") -> DataFrame:
    """(file_name, doc_id, line): doc_id counts the lines of each file from 0, block by block of the file."""
    raw = spark.read.option("pathGlobFilter", glob).text(path)
    place = F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    named = raw.select(F.col("_metadata.file_name").alias("file_name"), place.alias("place"), F.col("value").alias("line"))
    return numbered(named, "file_name", "place", "doc_id").select("file_name", F.col("doc_id").cast("long").alias("doc_id"), "line")


def documents_of(lines: DataFrame) -> DataFrame:
    """(file_name, doc_id, text, meta) of read_lines()."""
    doc = F.from_json("line", DOCUMENT, {"mode": "FAILFAST"})
    return lines.select("file_name", "doc_id", doc.alias("d")).select("file_name", "doc_id", "d.text", "d.meta")


def read_keep(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("file_name string, doc_id long").option("header", True).csv(path)


def read_idf(spark: SparkSession, path: str) -> DataFrame:
    """(word, idf): words such as null or a quote are read as they are."""
    return spark.read.schema("word string, idf double").option("sep", "\t").option("quote", "").option("emptyValue", "").option("nullValue", "\0").csv(path)


def write_idf(idfs: DataFrame, path: str) -> None:
    idfs.select("word", "idf").orderBy("idf", "word").write.mode("overwrite").option("sep", "\t").option("quote", "\0").option("emptyValue", "").csv(path)


def load(spark: SparkSession, path: str | None = None, paths: list[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """One dataset, or the union of several by column names; exactly one of path and paths is given."""
    if (path is None) == (not paths):
        raise ValueError("give either path or paths")
    found = [spark.read.format(fmt).load(p) for p in ([path] if path else paths)]
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """(url, html) of files of JSON arrays [url, html], a line each, plain or compressed by their extension; a line that can't be read is dropped."""
    return _pages(spark.read.text(path))


def _pages(lines: DataFrame) -> DataFrame:
    pair = F.from_json(F.col("value"), "array<string>")
    found = lines.select(pair.alias("p")).filter((F.size("p") == 2) & F.get("p", F.lit(1)).isNotNull())
    return found.select(F.get("p", F.lit(0)).alias("url"), F.get("p", F.lit(1)).alias("html"))


def read_archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """(url, html) of the first file of each 7z archive.

    An archive can't be split: a worker holds its bytes, and unpacks them piece by piece.
    """
    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.7z").load(path).select("content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                for lines in sevenzip.line_groups(content):
                    yield pd.DataFrame({"value": lines})

    return _pages(archives.mapInPandas(run, "value string"))


def pages_to_documents(pages: DataFrame) -> DataFrame:
    """(text, meta): the pages' main texts; text is null where there is none."""
    return pages.select(webpage.extracted(F.col("html")).alias("text"), F.to_json(F.struct("url")).alias("meta"))


def to_meta_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """(text, meta): meta as it is, or all other columns packed as JSON, nulls too."""
    if "meta" in df.columns:
        return df.select(F.col(text_col).alias("text"), "meta")
    others = [c for c in df.columns if c != text_col]
    return df.select(F.col(text_col).alias("text"), F.to_json(F.struct(*others), {"ignoreNullFields": "false"}).alias("meta"))


def write_documents(df: DataFrame, path: str, fmt: str = "parquet", compression: str | None = None) -> None:
    """Parquet (zstd) or JSON lines (gzip)."""
    codec = compression or ("zstd" if fmt == "parquet" else "gzip")
    df.write.mode("overwrite").option("compression", codec).format(fmt).save(path)


def write_jsonl_zst(df: DataFrame, path: str, level: int = 3) -> int:
    """Documents as .jsonl.zst files, one for each partition; returns how many were written.

    A task writes under a name of its own and renames at its end, so that a repeated task leaves one file. _SUCCESS marks the end.
    """
    spark = df.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    store.delete(hadoop, True)
    store.mkdirs(hadoop)
    uri = re.sub("^file:/+", "file:///", store.makeQualified(hadoop).toString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get(), 0
        fs, folder = pyarrow.fs.FileSystem.from_uri(uri)
        own = f"{folder}/part-{task.partitionId():05d}.jsonl.zst"
        held = f"{folder}/_{task.partitionId():05d}-{task.taskAttemptId()}"
        with fs.open_output_stream(held) as raw, zstandard.ZstdCompressor(level=level).stream_writer(raw, closefd=False) as out:
            for b in batches:
                for line in b.column(0).to_pylist():
                    out.write(line.encode("utf-8", "replace") + b"\n")
                    n += 1
        fs.move(held, own)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    lines = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("line"))
    n = lines.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    store.create(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")).close()
    return n


def read_jsonl_zst(spark: SparkSession, path: str, schema: str = DOCUMENT) -> DataFrame:
    """What write_jsonl_zst wrote. A file is read by one task, piece by piece."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jsonl.zst").load(path).select("content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                with zstandard.ZstdDecompressor().stream_reader(io.BytesIO(content)) as raw:
                    for lines in sevenzip.grouped(io.TextIOWrapper(raw, "utf-8")):
                        yield pd.DataFrame({"line": lines})

    return files.mapInPandas(run, "line string").select(F.from_json("line", schema).alias("d")).select("d.*")


def write_subset_zst(df: DataFrame, path: str, indices: DataFrame, key: str = "doc_id") -> int:
    """The documents (text, meta) whose key is in indices(key), as write_jsonl_zst; returns how many."""
    return write_jsonl_zst(to_meta_text(df.join(indices.select(key).distinct(), key, "left_semi")), path)


def write_decisions(decided: DataFrame, path: str) -> None:
    """keep and drop as two CSV folders."""
    for name in ("keep", "drop"):
        decided.filter(name).write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


def write_report(report: DataFrame, path: str) -> None:
    """(file_name, value) as text files, a folder for each file."""
    report.select("file_name", "value").write.mode("overwrite").partitionBy("file_name").text(path)


def not_done(rows: DataFrame, done: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows whose keys an earlier run has not written."""
    return rows.join(done.select(*keys), list(keys), "left_anti")


def stage_done(spark: SparkSession, path: str) -> bool:
    """Whether a stage's folder was written to the end."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
