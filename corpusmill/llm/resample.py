"""Importance resampling towards a target distribution.

Two generative models are fitted over hashed word unigrams and bigrams: one of
the target texts, one of the raw texts. A document's log importance weight is
the sum over its n-grams of log p_target - log p_raw; with Gumbel noise added,
the k largest keys are a sample without replacement in proportion to the
weights (Gumbel top-k).

The raw model covers all documents. The target model is fitted on a bounded
sample of labelled rows, at most ``target_rows`` of them, by the smallest hash
of their ids. k is a share of all documents; by default the share of target
rows among labelled rows.

The k-th largest key is found by radix selection, 12 bits of the key a round,
so nothing is sorted or gathered. Rows that tie with the k-th key, as repeated
rows do, are all selected.

Defined cases: a null or empty text has no n-grams and log weight 0. The noise
depends on the doc_id and the seed alone; a null doc_id counts as an id of its
own. Very long texts are weighed whole, slice by slice of a batch. An empty table
gives no rows. Other columns are not read. Labels without a document have no effect; repeated labels count once.
Without target rows all weights are 0; without labels all documents are selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import codes, released, slices, table, utf8
from corpusmill.session import stored


@dataclass(frozen=True)
class Params:
    buckets: int = 10_000
    target_rows: int = 20_000
    smoothing: float = 1.0
    seed: int = 5


def features(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all n-grams of the texts, one text after the other, and how many each text has."""
    split = [t.lower().split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    number, words = codes([w for ws in split for w in ws])
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    h = hashes[number] if len(words) else np.zeros(0, np.uint64)
    last = np.zeros(len(h), bool)
    ends = np.cumsum(sizes)
    last[ends[sizes > 0] - 1] = True
    pair = h * np.uint64(0x9E3779B97F4A7C15) + np.roll(h, -1)
    pair = (pair ^ (pair >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    both = np.stack([h % np.uint64(buckets), (pair >> np.uint64(7)) % np.uint64(buckets)], axis=1).astype(np.int64)
    keep = np.ones(both.shape, bool)
    keep[last, 1] = False  # a bigram does not leave its text
    return both[keep], np.where(sizes > 0, 2 * sizes - 1, 0)


def model(docs: DataFrame, target: DataFrame, p: Params = Params()) -> np.ndarray:
    """log p_target - log p_raw by bucket. docs(doc_id, text); target(doc_id) is of bounded size."""
    marks = target.select(F.col("doc_id").alias("_target")).distinct()
    rows = docs.join(F.broadcast(marks), docs["doc_id"] == marks["_target"], "left").select("text", F.col("_target").isNotNull().alias("is_target"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, wanted = np.zeros(p.buckets, np.int64), np.zeros(p.buckets, np.int64)
        for b in batches:
            texts, own = utf8(b.column(0)), b.column(1).to_numpy(zero_copy_only=False)
            for i, j in slices(texts):
                bucket, sizes = features(texts[i:j], p.buckets)
                raw += np.bincount(bucket, minlength=p.buckets)
                wanted += np.bincount(bucket[np.repeat(own[i:j], sizes)], minlength=p.buckets)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(p.buckets, dtype=np.int32)), pa.array(raw), pa.array(wanted)], ["i", "raw", "wanted"])

    counted = rows.mapInArrow(released(run), "i int, raw long, wanted long").groupBy("i").agg(F.sum("raw").alias("raw"), F.sum("wanted").alias("wanted"))
    raw, wanted = np.zeros(p.buckets), np.zeros(p.buckets)
    for r in counted.collect():
        raw[r.i], wanted[r.i] = r.raw, r.wanted
    if not wanted.any():
        return np.zeros(p.buckets)

    def log_p(n: np.ndarray) -> np.ndarray:
        return np.log((n + p.smoothing) / (n.sum() + p.smoothing * p.buckets))

    return log_p(wanted) - log_p(raw)


def weigh(docs: DataFrame, ratio: np.ndarray, p: Params = Params()) -> DataFrame:
    """(doc_id, n_features, log_weight, gumbel_key) for docs(doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, ids = utf8(b.column(1)), b.column(0).to_pylist()
            n, w = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            for i, j in slices(texts):
                bucket, sizes = features(texts[i:j], p.buckets)
                n[i:j] = sizes
                w[i:j] = np.bincount(np.repeat(np.arange(j - i), sizes), weights=ratio[bucket], minlength=j - i)
            h = np.array([xxhash.xxh64_intdigest(str(x).encode(), p.seed) for x in ids], np.uint64)
            u = ((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n), pa.array(w), pa.array(w - np.log(-np.log(u)))], ["doc_id", "n_features", "log_weight", "gumbel_key"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(released(run), f"doc_id {kind}, n_features long, log_weight double, gumbel_key double")


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 4096) -> float | None:
    """The k-th largest value of a column without nulls or NaN, by repeated histograms; None if k < 1 or there are not so many rows."""
    low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if k < 1 or not n or k > n:
        return None
    while low < high:
        width = (high - low) / bins
        inside = df.filter(F.col(column).between(low, high))
        cell = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)) if width > 0 else F.lit(0)
        rows = inside.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).orderBy(F.desc("cell")).collect()
        for r in rows:  # at most `bins` of them
            if k <= r.n:
                if (r.low, r.high) == (low, high):
                    return high if k <= df.filter(F.col(column) == high).count() else low
                low, high = r.low, r.high
                break
            k -= r.n
    return low


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None, p: Params = Params()) -> DataFrame:
    """(doc_id, n_features, log_weight, gumbel_key, selected) for docs(doc_id, text) and labels(doc_id, wanted boolean)."""
    labelled = labels.filter("doc_id IS NOT NULL AND wanted IS NOT NULL").groupBy("doc_id").agg(F.max("wanted").alias("wanted"))
    if share is None:
        share = labelled.agg(F.avg(F.col("wanted").cast("double"))).first()[0]
    target = labelled.filter("wanted").orderBy(F.xxhash64(F.lit(p.seed), "doc_id"), "doc_id").limit(p.target_rows).select("doc_id")
    scored = stored(weigh(docs, model(docs, target, p), p), "importance")
    k = scored.count() if share is None else round(share * scored.count())
    at = kth_largest(scored, "gumbel_key", k)
    selected = F.lit(False) if at is None else F.col("gumbel_key") >= at
    return scored.withColumn("selected", selected)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("wanted"))
    return resample(docs, labels)
