"""Splitting, sampling, mixing and reports."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.functions import text as T
from corpusmill.session import stored


def hash_share(key: Column, seed: int, cells: int = 1000) -> Column:
    """A number below cells from the key and the seed, the same in every engine that has MD5."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(cells))


def numbered(rows: DataFrame, group: str, order: str, name: str = "n") -> DataFrame:
    """rows with the number of each in its group from 0, by order.

    Numbers are given within ranges of (group, order) and added up over the ranges, so a large group is many tasks' work.
    """
    placed = stored(rows.repartitionByRange(group, order).withColumn("_range", F.spark_partition_id()), "numbered")
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))  # a row for each range that a group lies in
    counts = counts.select(F.col(group).alias("_g"), F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_low"))
    own = placed.withColumn("_own", F.row_number().over(Window.partitionBy(group, "_range").orderBy(order)) - 1)
    found = own.join(counts, own[group].eqNullSafe(counts["_g"]) & (own["_range"] == counts["_r"]))
    return found.withColumn(name, F.col("_low") + F.col("_own")).drop("_range", "_own", "_g", "_r", "_low")


def split_chunks(docs: DataFrame, file_col: str = "source", id_col: str = "doc_id", line_count: int = 10_000) -> DataFrame:
    """(doc_id, chunk): documents of a file in chunks of line_count, named file.000 and so on."""
    rows = numbered(docs.select(F.col(file_col).alias("file"), F.col(id_col).alias("doc_id")), "file", "doc_id")
    part = F.floor(F.col("n") / line_count).cast("string")
    name = F.concat(F.col("file"), F.lit("."), F.when(F.length(part) < 3, F.lpad(part, 3, "0")).otherwise(part))
    return rows.select("doc_id", name.alias("chunk"))


def holdout(docs: DataFrame, per_mille: int = 100, seed: int = 42, id_col: str = "doc_id") -> DataFrame:
    """docs with is_holdout, by a hash of the id."""
    return docs.withColumn("is_holdout", hash_share(F.col(id_col), seed) < per_mille)


def interleaved(docs: DataFrame, weights: dict[str, float], source_col: str = "source", id_col: str = "doc_id", seed: int = 42) -> DataFrame:
    """docs repeated by their source's weight, with shuffle_key to order by; a fraction of a weight is a hashed share of the documents."""
    w = reduce(lambda c, kv: F.when(F.col(source_col) == kv[0], kv[1]).otherwise(c), weights.items(), F.lit(1.0))
    extra = (hash_share(F.col(id_col), seed, 1_000_000) < (w - F.floor(w)) * 1_000_000).cast("int")
    times = (F.floor(w) + extra).cast("int")
    copies = docs.withColumn("copy", F.explode(F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>"))))
    return copies.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"), F.col("copy").cast("string"))))


def epochs(docs: DataFrame, n: int, text_col: str = "text") -> DataFrame:
    """docs n times over, with epoch; empty texts are left out."""
    return docs.filter(F.length(text_col) > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def sample_sheet(docs: DataFrame, file_col: str = "source", id_col: str = "doc_id", text_col: str = "text", first: int = 100, seed: int = 22) -> DataFrame:
    """(start, middle, end, file_name, line_index, annotation, comment): one hashed pick of each file's first rows; none of shorter files.

    Only ids are numbered; the texts of the picks, one a file, are joined on.
    """
    rows = numbered(docs.select(F.col(file_col).alias("file_name"), F.col(id_col).alias("_id")), "file_name", "_id", "line_index")
    picks = rows.filter(F.col("line_index") == hash_share(F.col("file_name"), seed, first))
    texts = docs.select(F.col(id_col).alias("_i"), F.col(file_col).alias("_f"), F.col(text_col).alias("text"))
    found = picks.join(texts, (picks["_id"] == texts["_i"]) & (picks["file_name"] == texts["_f"])).dropDuplicates(["file_name"])
    s = T.snippets(F.col("text"))
    return found.select(s["start"].alias("start"), s["middle"].alias("middle"), s["end"].alias("end"), "file_name", "line_index", F.lit(None).cast("int").alias("annotation"), F.lit("").alias("comment"))


def id_sets(docs: DataFrame, file_col: str = "source", id_col: str = "doc_id", span: int = 10_000) -> DataFrame:
    """(file_name, part, ids): the distinct ids of each file, as sorted arrays of the ids of a span each, so that no array grows with its file."""
    part = F.floor(F.col(id_col) / span).alias("part")
    return docs.groupBy(F.col(file_col).alias("file_name"), part).agg(F.array_sort(F.collect_set(id_col)).alias("ids"))


def histogram(df: DataFrame, column: str, bins: int = 100) -> DataFrame:
    """(bin, n_rows): equal bins from the least to the largest value; the largest value is in the last bin."""
    low, high = df.agg(F.min(column), F.max(column)).first()
    if low is None:
        return df.select(F.lit(0).alias("bin"), F.lit(0).cast("long").alias("n_rows")).limit(0)
    x = F.col(column).cast("double")
    cell = F.least(F.floor((x - float(low)) / ((float(high) - float(low)) / bins)), F.lit(bins - 1)) if high > low else F.lit(0)
    return df.filter(x.isNotNull()).groupBy(cell.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n_rows"))


def dedup_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """(n_before, n_after, n_dup, dup_ratio)."""
    a, b = before.count(), after.count()
    spark = before.sparkSession
    return spark.range(1).select(F.lit(a).cast("long").alias("n_before"), F.lit(b).cast("long").alias("n_after"), F.lit(a - b).cast("long").alias("n_dup"), F.lit(round((a - b) / a, 6) if a else 0.0).alias("dup_ratio"))


def violation_report(docs: DataFrame, violations: DataFrame, file_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(file_name, value): a block of text for each document with its reasons."""
    reasons = violations.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons"))
    rows = docs.join(reasons, docs[id_col] == reasons["doc_id"]).select(docs[file_col].alias("file_name"), docs[id_col].alias("_i"), docs[text_col].alias("_t"), "reasons")
    return rows.select("file_name", F.concat(F.col("file_name"), F.lit("-"), F.col("_i").cast("string"), F.lit("\n["), F.col("reasons"), F.lit("]\n"), F.col("_t"), F.lit("\n" + "*" * 100)).alias("value"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the smallest id of each text. Hashes are compared, not texts, so texts aren't shuffled."""
    first = docs.groupBy(F.sha2(text_col, 256).alias("_h")).agg(F.min(id_col).alias("_first"))
    return docs.join(first.select("_first"), docs[id_col] == F.col("_first"), "left_semi")


def not_in_holdout(train: DataFrame, held: DataFrame, text_col: str = "text") -> DataFrame:
    """train without texts that the held-out set has."""
    h = held.select(F.sha2(text_col, 256).alias("_h")).distinct()
    return train.join(h, F.sha2(train[text_col], 256) == h["_h"], "left_anti")


def checksum(text: str) -> str:
    """SHA-256 in hex; lone surrogates are replaced."""
    return hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
