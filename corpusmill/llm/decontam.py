"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so that their Jaccard similarity says
nothing; what counts is the containment, the share of an item's distinct
shingles that a document holds. Items are partitioned by size. In a partition
each item is represented by its MinHash sketch, its k smallest shingle hashes,
with k so large that a document which holds the wanted share of an item of
that size must hold one of them: k = u - ceil(share * u) + 1 for the largest
size u of the partition. Every document's shingles are looked up in the index of sketches, and
the candidate pairs are verified by exact containment, string by string.

Words are maximal runs of letters, marks and digits, lower-cased. A shingle
is five words. An item of fewer words has one shingle, the whole sequence;
documents are looked up with their runs of every length that such items have,
so a short item is found inside a long document too.

Everything on this path is made of DataFrame functions. The index is broadcast
only up to ``broadcast_rows`` rows of two longs; a larger one is joined by
shuffle, where a document has each shingle once and adaptive execution splits
those that are common. The candidates are a join of a key with few rows a document.

Defined cases: null and empty texts have no shingles, so they match nothing; a
document or item table without rows gives no pairs. Very long texts are looked up whole. There
are no ties: an item is contained to the share or not. Repeated rows give a pair once. Items that repeat each match by themselves.
Rows with a null doc_id can't be told apart: their pairs have a null doc_id,
and decontaminate() removes all of them if one holds an item. Other columns
are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import table
from corpusmill.session import stored


@dataclass(frozen=True)
class Params:
    words: int = 5
    share_percent: int = 80
    broadcast_rows: int = 200_000


def _wanted(n: Column, p: Params) -> Column:
    """The least number of shared shingles, in whole numbers."""
    return F.floor((n * p.share_percent + 99) / 100).cast("long")


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text.cast("string")), r"[^\p{L}\p{M}\p{N}]+"), lambda w: w != "")


def _runs(w: Column, n: int, of) -> Column:
    """of(word columns) for each n words in a row."""
    runs = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: of([F.get(w, i + k) for k in range(n)]))
    return F.when(F.size(w) >= n, runs).otherwise(F.array().cast("array<bigint>" if of is hashed else "array<string>"))


def _item_shingles(w: Column, p: Params, of) -> Column:
    """An item's shingles: its runs, or the whole of a shorter one."""
    found = _runs(w, p.words, of)
    for n in range(1, p.words):
        found = F.when(F.size(w) == n, _runs(w, n, of)).otherwise(found)
    return F.array_distinct(found)


def _shingles(w: Column, p: Params, short: list[int], of) -> Column:
    """A document's shingles: its runs, and those of the lengths that short items have."""
    found = _runs(w, p.words, of)
    return F.concat(found, *(_runs(w, n, of) for n in short)) if short else found


def hashed(ws: list[Column]) -> Column:
    return F.xxhash64(*ws)


def spelled(ws: list[Column]) -> Column:
    return F.concat_ws(" ", *ws)


def items_of(benchmark: DataFrame, id_col: str, text_col: str, p: Params) -> DataFrame:
    """(item_id, shingles, hashes, n, k, short): distinct shingles of each item, the length of its sketch, and its words if they are too few for a shingle."""
    rows = benchmark.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("w"))
    rows = rows.select("item_id", _item_shingles(F.col("w"), p, spelled).alias("shingles"), F.array_sort(_item_shingles(F.col("w"), p, hashed)).alias("hashes"), F.size("w").alias("n_words"))
    n = F.size("shingles")
    largest = (F.pow(F.lit(2), F.length(F.bin(n.cast("long")))) - 1).cast("long")  # of its size partition
    k = largest - _wanted(largest, p) + 1
    return rows.filter(n > 0).select("item_id", "shingles", "hashes", n.cast("long").alias("n"), k.cast("int").alias("k"), F.when(F.col("n_words") < p.words, F.col("n_words")).alias("short"))


def contained(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", p: Params = Params()) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) for each document that holds an item to the share or more."""
    items = stored(items_of(benchmark, item_col, item_text, p), "decontam-items")
    sketch = items.select("item_id", F.explode(F.slice("hashes", 1, F.col("k"))).alias("h"))
    n_rows, short = items.agg(F.coalesce(F.sum("n"), F.lit(0)), F.array_sort(F.collect_set("short"))).first()  # short: at most four numbers
    small = n_rows <= p.broadcast_rows
    bounded = F.broadcast if small else lambda df: df
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    split = texts.select("doc_id", words(F.col("text")).alias("w"))  # apart, so that a text is split once
    own = _shingles(F.col("w"), p, short, hashed)
    shingles = split.select("doc_id", F.explode(own if small else F.array_distinct(own)).alias("h"))
    pairs = shingles.join(bounded(sketch), "h").select("doc_id", "item_id").distinct()
    pairs = stored(pairs.select(F.col("doc_id").alias("_d"), "item_id"), "decontam-candidates")
    # verify: both sides' shingles as strings
    near = texts.join(pairs, texts["doc_id"].eqNullSafe(pairs["_d"])).select("doc_id", "item_id", words(F.col("text")).alias("w"))
    near = near.select("doc_id", "item_id", _shingles(F.col("w"), p, short, spelled).alias("own"))
    both = near.join(bounded(items.select("item_id", "shingles", "n")), "item_id")
    shared = F.size(F.array_intersect("shingles", "own")).cast("long")
    found = both.select("doc_id", "item_id", F.col("n").alias("n_shingles"), shared.alias("n_shared"))
    found = found.filter(F.col("n_shared") * 100 >= F.col("n_shingles") * p.share_percent).distinct()
    return found.withColumn("containment", F.round(F.col("n_shared") / F.col("n_shingles"), 6))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """docs without the documents that hold an item, in the columns of docs."""
    hits = stored(contained(docs, benchmark, id_col, text_col, p=p).select(F.col("doc_id").alias("_hit")).distinct(), "decontam-hits")
    return docs.join(hits, docs[id_col].eqNullSafe(hits["_hit"]), "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The same pairs by brute force: all runs of one to five words of all documents against all shingles of all items.
SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{M}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(flatten(list_transform([1, 2, 3, 4, 5], lambda n: list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))))) AS s
    FROM d WHERE len(w) > 0),
bs AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM b WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n FROM bs GROUP BY item_id),
c AS (SELECT doc_id, item_id, count(*) AS k FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n AS n_shingles, k AS n_shared, round(k / n, 6) AS containment
FROM c JOIN n USING (item_id) WHERE k * 100 >= n * 80
"""
