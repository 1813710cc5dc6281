"""SimHash near-duplicates, found by deletion-variant signatures.

A fingerprint is cut into ``max_bits // 2 + 1`` segments, so that two
fingerprints within max_bits differ by at most one bit in one segment at
least. Every segment is indexed under each of its one-wildcard variants, an
equality shuffle brings together the fingerprints that share a variant, and
each candidate is verified by its full Hamming distance.

Only distinct fingerprints are indexed, so copies cost a row each in the first
sum and in the last join, whose large keys adaptive execution splits. A variant that
many fingerprints share is dealt out again under finer keys: the bits outside
the segment are cut into ``max_bits + 1`` pieces, one of which must be equal.
Within a bucket a spanning forest is emitted, never all pairs.

Defined cases: a null text is the empty text; a text without words has
fingerprint zero, which is linked like any other; a text with fewer words than
a shingle has one shingle, the whole sequence. Repeated rows are returned as
often as they come. A null doc_id takes part in linking but is never a
component's name unless all of the component's ids are null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import Texts, released, slices, table, utf8
from corpusmill.operators.components import connected_components
from corpusmill.session import stored

BITS = 64
SEED = 42
#: A bucket with more fingerprints is dealt out again under finer keys.
LARGE = 2048
#: Buckets of up to this size are compared at once, by size.
SMALL = 12


def fingerprints_of(texts: Texts | list[bytes], shingle: int = 3) -> np.ndarray:
    """The 64-bit SimHash of each text, as uint64."""
    digest, out = xxhash.xxh64_intdigest, np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        w = text.lower().split()
        if not w:
            continue
        grams = [b" ".join(w)] if len(w) < shingle else map(b" ".join, zip(*(w[k:] for k in range(shingle))))
        h = np.array([digest(g, SEED) for g in grams], dtype="<u8")
        ones = np.zeros(BITS, np.int64)
        for k in range(0, len(h), 1 << 16):
            bits = np.unpackbits(h[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp): fp holds the fingerprint's bits in a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = fingerprints_of(utf8(b.column(1)), shingle)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return ids.mapInArrow(released(run), f"doc_id {ids.schema[0].dataType.simpleString()}, fp long")


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each segment."""
    n = max_bits // 2 + 1
    cuts = [BITS * k // n for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def variants(fps: DataFrame, max_bits: int) -> DataFrame:
    """(key, fp) for each segment and each wildcard bit in it. Keys of different variants never meet."""
    rows = []
    for low, width in _segments(max_bits):
        part = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1) if width < 64 else F.lit(-1))
        for bit in range(width):
            seen = part.bitwiseAND(F.lit(((1 << width) - 1) ^ (1 << bit)))
            rows.append(seen.bitwiseXOR(F.lit((low + bit) << 56 if low + bit < 128 else 0)) if width > 56 else seen.bitwiseOR(F.shiftleft(F.lit(low + bit).cast("long"), width)))
    return fps.select("fp", F.explode(F.array(*rows)).alias("key"))


def _forest(x: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of edges that connect what is within max_bits, directly or through others: a spanning forest."""
    n, root, us, vs = len(x), np.arange(len(x)), [], []
    step = max(1, (1 << 22) // n)
    for a in range(0, n, step):
        near = np.bitwise_count(x[a : a + step, None] ^ x[None, :]) <= max_bits
        i, j = np.nonzero(near)
        i += a
        i, j = i[i < j], j[i < j]
        while len(i):
            apart = root[i] != root[j]
            i, j = i[apart], j[apart]
            if not len(i):
                break
            hi, at = np.unique(np.maximum(root[i], root[j]), return_index=True)
            us.append(i[at])
            vs.append(j[at])
            root[hi] = np.minimum(root[i[at]], root[j[at]])
            while (root != root[root]).any():
                root = root[root]
    none = np.zeros(0, np.int64)
    return np.concatenate(us or [none]), np.concatenate(vs or [none])


def _in_buckets(key: np.ndarray, fp: np.ndarray, max_bits: int, large: int | None) -> tuple[list, list, list]:
    """Edges between fingerprints of a bucket, and the rows of buckets that are too large. Rows come sorted by key."""
    us, vs, rest = [], [], []
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    for size in range(2, SMALL + 1):
        at = starts[sizes == size]
        if len(at):
            group = fp[at[:, None] + np.arange(size)]
            for i in range(size):
                for j in range(i + 1, size):
                    ok = np.bitwise_count(group[:, i] ^ group[:, j]) <= max_bits
                    us.append(group[ok, i])
                    vs.append(group[ok, j])
    for at, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        if large and size > large:
            rest.append(slice(at, at + size))
        else:
            x = fp[at : at + size]
            i, j = _forest(x, max_bits)
            us.append(x[i])
            vs.append(x[j])
    return us, vs, rest


def _finer(key: np.ndarray, fp: np.ndarray, max_bits: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a large bucket under finer keys: what lies outside the segment, cut into max_bits + 1 pieces."""
    low = (key >> np.uint64(width)).astype(np.int64)
    keys, fps = [], []
    for a, w in _segments(max_bits):
        own = (low >= a) & (low < a + w)
        if not own.any():
            continue
        k, f = key[own], fp[own]
        left = [b for b in range(BITS) if not a <= b < a + w]
        for n, piece in enumerate(np.array_split(np.array(left, np.uint64), max_bits + 1)):
            mask = np.bitwise_or.reduce(np.uint64(1) << piece)
            keys.append(_mix(_mix(k * np.uint64(8) + np.uint64(n)) ^ (f & mask)))
            fps.append(f)
    return np.concatenate(keys), np.concatenate(fps)


def _bucketed(rows: DataFrame, max_bits: int, large: int | None, width: int) -> DataFrame:
    """(kind, a, b): kind 0 are edges between fingerprints, kind 1 rows (key, fp) for the next round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []  # rows of the bucket that may go on

        def out(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            us, vs, rest = _in_buckets(key, fp, max_bits, large)
            found = [(0, np.concatenate(us), np.concatenate(vs))] if us else []
            for s in rest:
                found.append((1, *_finer(key[s], fp[s], max_bits, width)))
            for kind, a, b in found:
                if kind == 0 and len(a):  # the same edge comes once for each variant that its ends share
                    pair = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
                    a, b = pair
                if len(a):
                    cols = [np.full(len(a), kind, np.int32), a.view(np.int64), b.view(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["kind", "a", "b"])

        def joined() -> tuple[np.ndarray, np.ndarray]:
            k, f = (np.concatenate(x) for x in zip(*kept))
            kept.clear()
            return k, f

        for b in batches:
            k, f = (b.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(2))
            if not len(k):
                continue
            last = np.searchsorted(k.view(np.int64), k.view(np.int64)[-1])
            if last or (kept and kept[-1][0][-1] != k[0]):  # the bucket that went on is complete
                kept.append((k[:last], f[:last]))
                yield from out(*joined())
            kept.append((k[last:], f[last:]))
        if kept:
            yield from out(*joined())

    dealt = rows.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(released(run), "kind int, a long, b long")


def links(fps: DataFrame, max_bits: int = 2, large: int = LARGE) -> DataFrame:
    """(a, b) between the distinct fingerprints in fps(fp): all within max_bits are connected through these edges."""
    width = max(w for _, w in _segments(max_bits))
    first = stored(_bucketed(variants(fps, max_bits), max_bits, large, width), "simhash-links")
    edges = first.filter("kind = 0").select("a", "b")
    again = first.filter("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("fp"))
    return edges.union(_bucketed(again.distinct(), max_bits, None, width).select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 2, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable through links of at most max_bits bits."""
    sigs = stored(fingerprints(docs, id_col, text_col, shingle), "simhash")
    firsts = stored(sigs.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    return grouped(sigs, firsts, links(firsts.select("fp"), max_bits), "fp")


def grouped(sigs: DataFrame, firsts: DataFrame, edges: DataFrame, key: str) -> DataFrame:
    """sigs(doc_id, key) with component_id, from the smallest id of each key, firsts(key, first), and edges(a, b) between keys."""
    roots = connected_components(edges, "a", "b")
    joined = firsts.join(roots.withColumnRenamed("id", key), key)
    names = joined.groupBy("component").agg(F.min("first").alias("name"))
    named = joined.join(names, "component").select(key, "name")
    # keys without a link are their own component: they are the larger part, so they skip both joins
    alone = firsts.join(roots.select(F.col("id").alias(key)), key, "left_anti").select(key, F.col("first").alias("name"))
    return sigs.join(named.union(alone), key).select("doc_id", key, F.col("name").alias("component_id"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 2) -> DataFrame:
    """docs with one document of each near-duplicate group: the one with the smallest id.

    Of rows that repeat that id one stays. Rows with a null id can't be told
    apart: one of them stays if there is a component of null ids alone.
    """
    return one_of_each(docs, near_duplicates(docs, id_col, text_col, max_bits), id_col)


def one_of_each(docs: DataFrame, marks: DataFrame, id_col: str) -> DataFrame:
    """docs with one document of each component of marks(doc_id, component_id), by the rules of dedup."""
    named = F.col("doc_id").eqNullSafe(F.col("component_id")).cast("int")
    ids = stored(marks.groupBy("doc_id").agg(F.sum(named).alias("n")), "simhash-ids")
    # what goes is far less than what stays, so that is what is joined, at every size
    gone = stored(ids.filter("n = 0 AND doc_id IS NOT NULL").select("doc_id"), "simhash-gone")
    rest = docs.join(gone, docs[id_col] == gone["doc_id"], "left_anti")
    odd = stored(ids.filter("n > 1 OR doc_id IS NULL"), "simhash-odd")
    if not odd.limit(1).count():
        return rest

    def of(some: DataFrame, how: str) -> DataFrame:
        return rest.join(some, rest[id_col].eqNullSafe(some["doc_id"]), how)

    return of(odd, "left_anti").union(of(odd.filter("n > 0"), "left_semi").dropDuplicates([id_col]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
