"""MinHash signatures, LSH bands and what is built on them."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions.lexicons import PUNCTUATION
from corpusmill.operators.components import connected_components
from corpusmill.session import stored

#: The prime of the permutations and the largest hash.
PRIME = (1 << 61) - 1
MAX_HASH = (1 << 32) - 1

_DROP = str.maketrans("", "", PUNCTUATION)
_TOKEN = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9\s]")


@dataclass(frozen=True)
class MinHashParams:
    """Two presets, of tokens and of words of the cleaned text ("raw": of the text as it is). Texts are taken whole unless max_len bounds their items."""

    ngram: int
    threshold: float
    seed: int
    unit: str
    max_len: int | None = None
    num_perm: int = 128
    min_ngram: int = 0

    def shingles(self, text: str) -> set[str]:
        if self.unit == "raw":
            items = text.split()
        elif self.unit == "word":
            items = text.lower().translate(_DROP).split()
        else:
            items = _TOKEN.findall(text.lower().translate(_DROP))
        if self.max_len is not None:
            items = items[: self.max_len]
        n = self.ngram
        if len(items) < max(n, self.min_ngram):
            return set()
        return set(items) if n == 1 else set(map(" ".join, zip(*(items[k:] for k in range(n)))))


SIMPLE = MinHashParams(5, 0.7, 42, "token")
MAIN = MinHashParams(13, 0.8, 1, "word")
#: The same on the first items of a text alone.
SIMPLE_LIMITED = replace(SIMPLE, max_len=10_000)
MAIN_LIMITED = replace(MAIN, max_len=1000)


def optimal_param(threshold: float, num_perm: int, fp_weight: float = 0.5, fn_weight: float = 0.5) -> tuple[int, int]:
    """(bands, rows) with the least weighted area of false positives and false negatives, by Simpson's rule."""

    def area(f, a: float, b: float, n: int = 200) -> float:
        x = np.linspace(a, b, 2 * n + 1)
        w = np.ones(2 * n + 1)
        w[1:-1:2], w[2:-1:2] = 4, 2
        return float((w * f(x)).sum() * (b - a) / (6 * n))

    best, found = float("inf"), (1, 1)
    for b in range(1, num_perm + 1):
        for r in range(1, num_perm // b + 1):
            fp = area(lambda s, b=b, r=r: 1 - (1 - s**r) ** b, 0.0, threshold)
            fn = area(lambda s, b=b, r=r: (1 - s**r) ** b, threshold, 1.0)
            error = fp * fp_weight + fn * fn_weight
            if error < best:
                best, found = error, (b, r)
    return found


def permutations(num_perm: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The seeded (a, b) pairs, drawn by turns."""
    rng = np.random.RandomState(seed)
    pairs = [(rng.randint(1, PRIME, dtype=np.uint64), rng.randint(0, PRIME, dtype=np.uint64)) for _ in range(num_perm)]
    a, b = np.array(pairs, np.uint64).T
    return a, b


def _reduced(v: np.ndarray) -> np.ndarray:
    """v mod PRIME, which is a Mersenne prime, in place."""
    high = v >> np.uint64(61)
    v &= np.uint64(PRIME)
    v += high
    return np.subtract(v, np.uint64(PRIME), out=v, where=v >= np.uint64(PRIME))


def signatures_of(sets: list[set[str]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The signature of each set, (sets, permutations), worked out in blocks of bounded size whatever the sets' sizes."""
    out = np.full((len(sets), len(a)), MAX_HASH, np.uint64)
    sha1, owner = hashlib.sha1, np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    raw = b"".join([sha1(g.encode("utf-8", "replace")).digest()[:4] for s in sets for g in s])
    h = np.frombuffer(raw, "<u4").astype(np.uint64)
    for k in range(0, len(h), 4096):
        v = _reduced(h[k : k + 4096, None] * a + b) & np.uint64(MAX_HASH)
        own = owner[k : k + 4096]
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        rows = own[starts]
        out[rows] = np.minimum(out[rows], np.minimum.reduceat(v, starts, axis=0))
    return out


def signature(shingles: set[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return signatures_of([shingles], a, b)[0]


#: Texts are worked on in slices of about this many characters, however large an Arrow batch is.
SLICE = 4 << 20


def sliced(texts: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, list[str]]]:
    """(first, texts) of consecutive rows, null as the empty text; one text is never cut."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = held = 0
    for i, n in enumerate([*sizes, None]):
        if n is None or (held and held + n > limit):
            if i > start:
                yield start, [t or "" for t in texts[start:i].to_pylist()]
            start, held = i, 0
        held += n or 0


def signatures(docs: DataFrame, p: MinHashParams = SIMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, signature): a text without shingles has the largest hash everywhere; a null text is empty."""
    a, b = permutations(p.num_perm, p.seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in sliced(batch.column(1)):
                rows = signatures_of([p.shingles(t) for t in texts], a, b).astype(np.int64)
                cuts = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * p.num_perm)
                ids = batch.column(0).slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(cuts, pa.array(rows.reshape(-1)))], ["doc_id", "signature"])

    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return ids.mapInArrow(run, f"doc_id {ids.schema[0].dataType.simpleString()}, signature array<long>")


def bands(sigs: DataFrame, p: MinHashParams = SIMPLE) -> DataFrame:
    """(doc_id, band, band_hash): the hash in hex."""
    n, r = optimal_param(p.threshold, p.num_perm)
    keys = F.array(*(F.md5(F.array_join(F.slice("signature", k * r + 1, r), ",")) for k in range(n)))
    return sigs.select("doc_id", F.posexplode(keys).alias("band", "band_hash"))


def band_keys(sigs: DataFrame, p: MinHashParams = SIMPLE) -> DataFrame:
    """(doc_id, band, band_hash): the hash is two longs, which are cheaper to make and to shuffle than text."""
    n, r = optimal_param(p.threshold, p.num_perm)
    parts = [F.slice("signature", k * r + 1, r) for k in range(n)]
    keys = F.array(*(F.struct(F.xxhash64(x).alias("x"), F.xxhash64(F.lit(k), x).alias("y")) for k, x in enumerate(parts)))
    return sigs.select("doc_id", F.posexplode(keys).alias("band", "band_hash"))


def stored_bands(docs: DataFrame, p: MinHashParams = SIMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """band_keys of docs, written once: buckets are looked for and then looked into."""
    return stored(band_keys(signatures(docs, p, id_col, text_col), p), "minhash-bands")


def star_edges(banded: DataFrame) -> DataFrame:
    """(src, dst): every document of a bucket with the bucket's smallest. Never all pairs."""
    first = banded.groupBy("band", "band_hash").agg(F.min("doc_id").alias("dst"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    pairs = banded.join(first, ["band", "band_hash"]).filter("doc_id <> dst")
    return pairs.select(F.col("doc_id").alias("src"), "dst").distinct()


def candidates_of(banded: DataFrame, queries: DataFrame) -> DataFrame:
    """(src, dst): for each document of queries(doc_id) all earlier documents that share a band with it.

    The queries are a stated set; the pairs are theirs alone. banded is read twice, so it should be stored.
    """
    q = banded.join(queries.select("doc_id").distinct(), "doc_id", "left_semi")
    q = q.select(F.col("doc_id").alias("src"), "band", "band_hash")
    return q.join(banded, ["band", "band_hash"]).filter("src > doc_id").select("src", F.col("doc_id").alias("dst")).distinct()


def clusters(docs: DataFrame, p: MinHashParams = SIMPLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, component): the smallest id of each near-duplicate cluster, for the members of clusters of several."""
    return connected_components(star_edges(stored_bands(docs, p, id_col, text_col))).select(F.col("id").alias("doc_id"), "component")


def dedup(docs: DataFrame, p: MinHashParams = SIMPLE, id_col: str = "doc_id", text_col: str = "text", short_docs: str = "collapse") -> DataFrame:
    """docs with one document, the one with the smallest id, of each cluster.

    Texts without shingles are one cluster ("collapse"), all kept ("keep") or all dropped ("drop").
    """
    if short_docs not in ("collapse", "keep", "drop"):
        raise ValueError(short_docs)
    sigs = stored(signatures(docs, p, id_col, text_col), "minhash-signatures")
    short = F.get("signature", F.lit(0)) == MAX_HASH
    used = sigs if short_docs == "collapse" else sigs.filter(~short)
    found = connected_components(star_edges(stored(band_keys(used, p), "minhash-bands")))
    gone = found.filter("id <> component").select(F.col("id").alias("_gone"))
    if short_docs == "drop":
        gone = gone.union(sigs.filter(short).select("doc_id"))
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
