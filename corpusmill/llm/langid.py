"""Language identification by nearest centroid.

A text becomes a vector of hashed character n-grams (one to three code points
of lower-cased letters, with word boundaries), weighted by TF-IDF and
normalised. Each language has several centroids, found by clustering the
vectors of a bounded sample of its training texts. A text gets the language of
the centroid with the largest cosine, unless all centroids are too far.

The inverse document frequencies cover all training documents; only the
clustering works on a sample of about ``sample`` documents a language, by the
hash of id and text. At most ``languages`` languages are learned, the most
frequent ones: a model must fit a worker, whatever stands in the column.

Defined cases: a null text, a text without letters and any text when nothing
was learned, as from an empty table, are ``und`` with score 0. Training rows with a null text or
language are left out. A null doc_id counts as the empty text when rows are
dealt to training and held-out rows. Rows that repeat id and text count each in
the frequencies and once in the sample. Very long texts are read whole. Ties go
to the first language by name. Other columns are not read.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import held_out, released, slices, table, utf8

DIMENSIONS = 4096
UNKNOWN = "und"

_kind_of: np.ndarray | None = None


@dataclass(frozen=True)
class Params:
    """sample: training documents a language that are clustered, about; reject_below: the least cosine; languages: most that are learned."""

    centroids: int = 4
    sample: int = 1500
    rounds: int = 8
    reject_below: float = 0.0
    seed: int = 17
    languages: int = 1000


def _kinds() -> np.ndarray:
    """By code point: 2 for letters, 1 for marks, which belong to letters, else 0."""
    global _kind_of
    if _kind_of is None:
        known = {"L": 2, "M": 1}
        _kind_of = np.fromiter((known.get(unicodedata.category(chr(c))[0], 0) for c in range(sys.maxunicode + 1)), np.int8, sys.maxunicode + 1)
    return _kind_of


def counts(texts: list[bytes]) -> np.ndarray:
    """(texts, DIMENSIONS) counts of hashed character n-grams; a row is zero only if its text has no letter."""
    decoded = [t.decode("utf-8", "replace").lower() for t in texts]
    c = np.frombuffer("\n".join(["", *decoded, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = np.array([len(t) + 1 for t in decoded] + [1], np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)  # a text begins with the boundary before it
    kind = _kinds()[c]
    letter = kind > 0
    x = np.where(letter, c, 32).astype(np.uint64)
    lettered = np.bincount(doc[kind == 2], minlength=len(sizes))[:-1] > 0
    out = np.zeros(len(texts) * DIMENSIONS)
    one = np.uint64(0x9E3779B97F4A7C15)

    def add(key: np.ndarray, at: np.ndarray) -> None:
        h = (key[at] * one) >> np.uint64(64 - 12)
        out[:] += np.bincount(doc[at] * DIMENSIONS + h.astype(np.int64), minlength=len(out))

    add(x + np.uint64(1), np.flatnonzero(letter))
    two = x[:-1] * np.uint64(0x1F1F1F1F) + x[1:] + np.uint64(1 << 40)
    add(two, np.flatnonzero(letter[:-1] | letter[1:]))
    three = two[:-1] * np.uint64(0x2545F491) + x[2:] + np.uint64(1 << 41)
    add(three, np.flatnonzero(letter[1:-1] & (letter[:-2] | letter[2:])))
    return (out.reshape(len(texts), DIMENSIONS) * lettered[:, None]).astype(np.float32)


def vectors(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts(texts)) * idf
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Slices of few enough texts for their count matrix to stay small."""
    for a, b in slices(texts, 2 << 20):
        for k in range(a, b, 512):
            yield k, min(b, k + 512)


def cluster(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Spherical k-means from seeded, far-apart starts; returns at most k unit vectors."""
    rnd = np.random.default_rng(seed)
    centres = [x[rnd.integers(len(x))]]
    while len(centres) < min(k, len(x)):
        near = (x @ np.array(centres).T).max(axis=1)
        if near.min() > 1 - 1e-6:
            break
        centres.append(x[near.argmin()])
    c = np.array(centres)
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        sums = np.array([x[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(len(c))])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return c


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Over docs(text): document frequency by dimension, and documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(DIMENSIONS, np.int64), 0
        for b in batches:
            texts = utf8(b.column(0))
            for i, j in _blocks(texts):
                df += (counts(texts[i:j]) > 0).sum(axis=0)
            n += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMENSIONS + 1, dtype=np.int32)), pa.array(np.append(df, n))], ["i", "n"])

    rows = docs.select("text").mapInArrow(released(run), "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(DIMENSIONS + 1, np.int64)
    for r in rows:
        df[r.i] = r.n
    return df[:-1], int(df[-1])


def fit(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", p: Params = Params()):
    """(languages, centroids, idf) learned from the rows of docs where train holds."""
    rows = docs.filter(train & F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    text = F.col(text_col).cast("string")
    rows = rows.select(F.xxhash64(F.lit(p.seed), F.col(id_col), F.xxhash64(text)).alias("h"), text.alias("text"), F.col(lang_col).cast("string").alias("lang"))
    df, n = document_frequencies(rows)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    langs = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("m")).orderBy(F.desc("m"), "lang").limit(p.languages).collect()
    if not langs:
        return [], np.zeros((0, DIMENSIONS), np.float32), idf
    # a uniform share of each language's rows, about p.sample of them
    share = rows.sparkSession.createDataFrame([(r.lang, min(1.0, p.sample / r.m)) for r in langs], "lang string, share double")
    near = rows.join(F.broadcast(share), "lang").filter((F.pmod("h", F.lit(1_000_003)) / 1_000_003.0) < F.col("share"))
    sample = near.groupBy("lang", "h").agg(F.min("text").alias("text"))

    def centres(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        texts = [t.encode("utf-8", "replace") for t in pdf.sort_values(["h", "text"])["text"]]
        x = np.concatenate([vectors(texts[i:j], idf) for i, j in _blocks(texts)])
        x = x[x.any(axis=1)]
        c = cluster(x, p.centroids, p.rounds, p.seed) if len(x) else np.zeros((0, DIMENSIONS))
        return pd.DataFrame({"lang": key[0], "k": range(len(c)), "v": [v.astype(np.float64).tolist() for v in c]})

    # a few vectors of fixed length for each language
    got = sample.groupBy("lang").applyInPandas(centres, "lang string, k long, v array<double>").orderBy("lang", "k").collect()
    return [r.lang for r in got], np.array([r.v for r in got], np.float32).reshape(len(got), DIMENSIONS), idf


def predict(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """(doc_id, lang_pred, score): score is the largest cosine, from 0 to 1."""
    langs, centroids, idf = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = utf8(b.column(1))
            best, score = np.full(len(texts), -1, np.int64), np.zeros(len(texts))
            for i, j in _blocks(texts) if len(langs) else ():
                x = vectors(texts[i:j], idf)
                cos = x @ centroids.T
                score[i:j] = np.clip(cos.max(axis=1), 0, 1)
                best[i:j] = np.where(x.any(axis=1) & (score[i:j] >= p.reject_below), cos.argmax(axis=1), -1)
            score[best < 0] = 0
            pred = pa.array([langs[k] if k >= 0 else UNKNOWN for k in best], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), pred, pa.array(score)], ["doc_id", "lang_pred", "score"])

    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return ids.mapInArrow(released(run), f"doc_id {ids.schema[0].dataType.simpleString()}, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = held_out(F.col("doc_id"), 4)
    found = predict(docs, fit(docs, ~out))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")
