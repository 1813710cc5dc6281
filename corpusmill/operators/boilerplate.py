"""Inverse document frequencies and the trimming of boilerplate at a document's end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions import text as T
from corpusmill.operators import minhash as M
from corpusmill.session import checkpoint, stored

UNKNOWN_IDF = 20.0
PARTS = 64


def idf(docs: DataFrame, text_col: str = "text", topk: int | None = None, file_col: str | None = None) -> DataFrame:
    """(word, df, idf): 1 + ln(documents / documents with the word).

    With topk the document frequency sums up only each file's topk words.
    """
    n = docs.count()
    rows = docs.select(*([F.col(file_col).alias("file")] if topk else []), F.explode(F.array_distinct(T.words(F.col(text_col)))).alias("word"))
    if topk:
        by = rows.groupBy("file", "word").agg(F.count(F.lit(1)).alias("df"))
        # the best of each part of a file's words, then the best of those, so that a large file is many tasks' work
        part = F.pmod(F.xxhash64("word"), F.lit(PARTS))
        for keys in ((F.col("file"), part), (F.col("file"),)):
            top = Window.partitionBy(*keys).orderBy(F.desc("df"), "word")
            by = by.withColumn("k", F.row_number().over(top)).filter(F.col("k") <= topk).drop("k")
        counted = by.groupBy("word").agg(F.sum("df").alias("df"))
    else:
        counted = rows.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    return counted.withColumn("idf", 1 + F.log(F.lit(float(n)) / F.col("df")))


def tail_cuts(docs: DataFrame, idfs: DataFrame, threshold: float, lastk: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start_index, end_index): the lines that stay, for documents that are cut.

    A cut is made at the first of the last lastk lines whose words have a mean idf below the threshold; blank lines are skipped.
    """
    lines = F.split(F.col(text_col), "\n")
    flat = docs.select(F.col(id_col).alias("doc_id"), F.size(lines).alias("n"), F.posexplode(lines).alias("pos", "line"))
    flat = flat.filter(F.col("pos") >= F.greatest(F.col("n") - lastk, F.lit(0)))
    words = flat.select("doc_id", "pos", F.explode(T.words(F.col("line"))).alias("word"))
    scored = words.join(idfs.select("word", "idf"), "word", "left").groupBy("doc_id", "pos").agg(F.avg(F.coalesce("idf", F.lit(UNKNOWN_IDF))).alias("mean"))
    cut = scored.filter(F.col("mean") < threshold).groupBy("doc_id").agg(F.min("pos").alias("end_index"))
    return cut.select("doc_id", F.lit(0).alias("start_index"), "end_index")


def trimmed(docs: DataFrame, cuts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the lines before each cut."""
    c = cuts.select(F.col("doc_id").alias("_cut_id"), "end_index")
    text = F.when(F.col("end_index").isNull(), F.col(text_col)).otherwise(F.array_join(F.slice(F.split(F.col(text_col), "\n"), 1, F.col("end_index")), "\n"))
    out = docs.join(c, docs[id_col] == c["_cut_id"], "left")
    return out.select(*(text.alias(n) if n == text_col else docs[n] for n in docs.columns))


def tail_cuts_minhash(docs: DataFrame, lastk: int = 5, threshold: float = 0.8, file_col: str = "source", id_col: str = "doc_id", text_col: str = "text", max_rounds: int = 60) -> DataFrame:
    """(doc_id, start_index, end_index): cuts at the first of the last lines that resembles an earlier tail line of its file.

    Lines are earlier by (doc_id, position). A document is cut at its first hit, and the lines after the cut are not there for later ones.
    Whether a line is there so depends on the lines before it: each round settles the documents that depend on settled ones alone. Raises RuntimeError rather than return partial cuts if that takes more than max_rounds.
    """
    lines = F.split(F.col(text_col), "\n")
    flat = docs.select(F.col(file_col).alias("file"), F.col(id_col).alias("doc_id"), F.size(lines).alias("n"), F.posexplode(lines).alias("pos", "line"))
    flat = flat.filter((F.col("pos") >= F.greatest(F.col("n") - lastk, F.lit(0))) & (F.size(T.words(F.col("line"))) > 0))
    keyed = flat.select(F.struct("file", "doc_id", "pos").alias("at"), "line")
    p = M.MinHashParams(1, threshold, 1, "raw")
    banded = stored(M.band_keys(M.signatures(keyed, p, "at", "line"), p), "tail-bands").select("doc_id.*", "band", "band_hash")
    bucket = ["file", "band", "band_hash"]
    shared = banded.groupBy(*bucket).agg(F.count(F.lit(1)).alias("m")).filter("m > 1").drop("m")
    left = stored(banded.join(shared, bucket, "left_semi"), "tail-shared")
    cuts = None
    for _ in range(max_rounds):
        # lines that are there for later ones: those before their document's cut, as far as cuts are known
        there = left if cuts is None else left.join(cuts, "doc_id", "left").filter("end_index IS NULL OR pos < end_index").drop("end_index")
        firsts = there.groupBy(*bucket).agg(F.min(F.struct("doc_id", "pos")).alias("first"))
        hit = left.join(firsts, bucket).filter(F.struct("doc_id", "pos") > F.col("first"))
        found = checkpoint(hit.groupBy("doc_id").agg(F.min("pos").alias("end_index")))
        if cuts is not None and not found.exceptAll(cuts).limit(1).count() and not cuts.exceptAll(found).limit(1).count():
            return found.select("doc_id", F.lit(0).alias("start_index"), "end_index")
        cuts = found
    raise RuntimeError(f"cuts were not settled in {max_rounds} rounds")
