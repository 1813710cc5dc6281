"""Perplexity of three segments of a document, with a pluggable model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T


def segments(text: Column) -> Column:
    """struct(start, middle, end) of non-blank lines: from 5 to 50 %, to 95 %, and the rest."""

    def cut(ls: Column) -> Column:
        n = F.size(ls)
        s, m, e = F.floor(n / 20).cast("int"), F.floor(n / 2).cast("int"), (F.floor(n / 20) * 19).cast("int")
        part = lambda a, b: F.array_join(F.slice(ls, a + 1, F.greatest(b - a, F.lit(0))), "\n")
        return F.struct(part(s, m).alias("start"), part(m, e).alias("middle"), part(e, n).alias("end"))

    return F.get(F.transform(F.array(T.stripped_lines(text)), cut), F.lit(0))


def fit_bytes(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """log p(next byte | byte), from the counts of all texts: a table of 256 by 256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(65_536, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                x = np.frombuffer(b"\n" + (t or "").encode("utf-8", "replace"), np.uint8).astype(np.int64)
                n += np.bincount(x[:-1] * 256 + x[1:], minlength=65_536)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["i", "n"])

    rows = docs.select(F.col(text_col).cast("string")).mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    n = np.ones(65_536)
    for r in rows:
        n[r.i] += r.n
    n = n.reshape(256, 256)
    return np.log(n / n.sum(axis=1, keepdims=True))


def byte_scorer(table: np.ndarray) -> Callable[[str, int | None], tuple[str, float, int]]:
    """Tokens are bytes; the segment is scored after a line break, whole or its first max_token tokens."""

    def score(segment: str, max_token: int | None) -> tuple[str, float, int]:
        x = np.frombuffer(("\n" + segment).encode("utf-8", "replace")[:max_token], np.uint8)
        mean = table[x[:-1], x[1:]].mean() if len(x) > 1 else 0.0
        return x.tobytes().decode("utf-8", "replace"), float(np.exp(-mean)), len(x)

    return score


def perplexities(docs: DataFrame, scorer: Callable[[str, int | None], tuple[str, float, int]], id_col: str = "doc_id", text_col: str = "text", max_token: int | None = None) -> DataFrame:
    """(doc_id, perplexity_start, perplexity_middle, perplexity_end, perplexity_avg, total_num_token); none for texts without lines.

    Segments are scored whole, or their first max_token tokens.
    """
    part = "struct<text:string,perplexity:double,num_token:int>"
    names = ["perplexity_start", "perplexity_middle", "perplexity_end"]
    rows = docs.select(F.col(id_col).alias("doc_id"), segments(F.col(text_col)).alias("s"), T.stripped_lines(F.col(text_col)).alias("l"))
    rows = rows.filter(F.size("l") > 0).select("doc_id", "s.start", "s.middle", "s.end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("text", pa.string()), ("perplexity", pa.float64()), ("num_token", pa.int32())])
        for b in batches:
            cols = []
            for k in (1, 2, 3):
                got = [scorer(t, max_token) for t in b.column(k).to_pylist()]
                cols.append(pa.array([{"text": t, "perplexity": round(p, 2), "num_token": n} for t, p, n in got], kind))
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["doc_id", *names])

    out = rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, " + ", ".join(f"{n} {part}" for n in names))
    mean = sum((F.col(f"{n}.perplexity") for n in names[1:]), F.col(f"{names[0]}.perplexity")) / 3
    total = sum((F.col(f"{n}.num_token") for n in names[1:]), F.col(f"{names[0]}.num_token"))
    return out.withColumn("perplexity_avg", F.round(mean, 2)).withColumn("total_num_token", total)
