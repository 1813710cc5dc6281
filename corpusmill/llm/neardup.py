"""Near-duplicates by verified Jaccard similarity of 5-word shingles.

Candidates come from op9's SimHash first: fingerprints within ``NEAR`` bits are
found by their one-wildcard segment variants, and what they connect is a bucket.
``NEAR`` is the widest radius whose segments stay long enough for very many
fingerprints. Similar texts lie up to 11 bits apart, so fingerprints alone would
lose links; for those that lie farther apart come MinHash buckets: ``BANDS``
bands of ``ROWS`` values each, in which a pair of similarity s meets with probability
1 - (1 - s**ROWS)**BANDS, which is 0.999 at 0.8. Every link is verified on
the whole shingle sets. Within a bucket a search from member to member visits
only those not reached yet: it connects all that similar pairs of the bucket
connect, and emits fewer links than the bucket has members.

Texts with equal shingle sets are one entry. Shuffled are 16 bytes a variant and
fingerprint, 16 bytes a band and text, and shingle sets of the texts that share
a bucket alone. Fingerprints and the first ``EARLY`` bands already connect most of
what there is to connect; of the bands only buckets that hold texts of several
groups are looked into, for the rest could add nothing.

A worker holds one bucket's sets at a time, up to ``LARGE`` members and
``LARGE_BYTES``. The members of a larger bucket are each compared with its first
one, which is a join and splits at will. Where all are similar to it, nothing is
left to find. Else the bucket is dealt out again by further MinHash bands of its
members, as often as ``DEPTH`` says; of those buckets only the ones that hold a
member not linked yet are looked into. A bucket that is still large then is one
worker's: its members agree in (DEPTH + 1) * ROWS MinHash values.

Defined cases are those of simhash: a null text is the empty text, all texts
without words are copies of each other, and a text with fewer words than a
shingle has one shingle, the whole sequence.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import released, utf8
from corpusmill.llm.simhash import SEED, _mix, fingerprints_of, grouped, one_of_each
from corpusmill.llm.simhash import links as fingerprint_links
from corpusmill.operators.components import connected_components
from corpusmill.session import stored

WORDS = 5
#: Bits in which the fingerprints of candidates differ at most.
NEAR = 5
BANDS, ROWS = 24, 6
#: Bands that are looked into before the others.
EARLY = 6
#: Bounds of a bucket that one worker compares, and how often a larger one is dealt out again.
LARGE, LARGE_BYTES, DEPTH = 4096, 64 << 20, 3
#: Parts in which the members of a large bucket meet its first one.
SALT = 64
#: Similar are sets whose Jaccard similarity is 4/5 or more; in whole numbers, so that no rounding decides.
SHARE = (4, 5)



def _permutations(level: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, level] if level else SEED)
    return rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


_PERMUTATIONS = [_permutations(level) for level in range(DEPTH + 1)]


def shingles_of(text: bytes) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles, as uint64."""
    w = text.lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    grams = [b" ".join(w)] if len(w) < WORDS else map(b" ".join, zip(*(w[k:] for k in range(WORDS))))
    return np.unique(np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], np.uint64))


def _same(x: np.ndarray) -> int:
    """The name of a shingle set, as a signed long."""
    return xxhash.xxh64_intdigest(x.tobytes(), SEED) - (1 << 63)


def band_keys(x: np.ndarray, level: int = 0, inside: int = 0) -> np.ndarray:
    """A set's bucket in each band of a level, inside a bucket of the level before; none for an empty set."""
    if not len(x):
        return np.zeros(0, np.int64)
    a, b = _PERMUTATIONS[level]
    low = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for k in range(0, len(x), 512):  # bounded memory for long texts
        low = np.minimum(low, ((x[k : k + 512, None] * a + b) >> np.uint64(32)).min(axis=0))
    key = np.arange(BANDS, dtype=np.uint64) ^ np.uint64(inside % (1 << 64))
    for part in low.reshape(BANDS, ROWS).T:
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + part)
    return key.view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, same, n, fp, bands): texts of equal shingle sets have equal `same`; n is the set's size, fp op9's fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, sizes, keys = [], [], []
            texts = utf8(b.column(1))
            fps = fingerprints_of(texts)
            for text in texts:
                x = shingles_of(text)
                names.append(_same(x))
                sizes.append(len(x))
                keys.append(band_keys(x))
            cuts = pa.array(np.cumsum([0, *map(len, keys)]).astype(np.int32))
            flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            cols = [b.column(0), pa.array(names, pa.int64()), pa.array(sizes, pa.int32()), pa.array(fps.view(np.int64)), pa.ListArray.from_arrays(cuts, flat)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "same", "n", "fp", "bands"])

    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return ids.mapInArrow(released(run), f"doc_id {ids.schema[0].dataType.simpleString()}, same long, n int, fp long, bands array<long>")


def by_fingerprint(sigs: DataFrame) -> DataFrame:
    """(key, same, n): the sets of sigs(same, n, fp) whose fingerprints links of at most NEAR bits connect, if there are several."""
    prints = stored(sigs.filter("n > 0").select("same", "n", "fp").distinct(), "near-prints")
    roots = connected_components(fingerprint_links(prints.select("fp").distinct(), NEAR), "a", "b")
    # fingerprints without a link may still be those of several sets
    named = prints.join(roots.withColumnRenamed("id", "fp"), "fp", "left").select(F.coalesce("component", "fp").alias("key"), "same", "n").distinct()
    named = stored(named, "near-named")
    several = named.groupBy("key").agg(F.min("same").alias("a"), F.max("same").alias("b")).filter("a < b").select("key")
    return named.join(several, "key")


def _candidates(docs: DataFrame, firsts: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(same, text): of each set that shares a bucket the text of its first id. The one join that moves all texts, the same way at every size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [_same(shingles_of(t)) == name for t, name in zip(utf8(b.column(1)), b.column(0).to_pylist())]
            yield b.filter(pa.array(own, pa.bool_()))  # not another text of a repeated id

    wanted = firsts.join(members.select("same").distinct(), "same", "left_semi").select(F.col("first").alias("_first"), F.col("same").alias("_same"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(wanted.hint("merge"), F.col("_id").eqNullSafe(F.col("_first")))
    return rows.select(F.col("_same").alias("same"), "text").mapInArrow(released(run), "same long, text string")


def _with_sets(texts: DataFrame, members: DataFrame) -> DataFrame:
    """members(key, same) with shingles, the set's hashes as bytes, from texts(same, text).

    Keys go to the texts, so that a set is shuffled once for each of its buckets and not before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = pa.array([shingles_of(t).tobytes() for t in utf8(b.column(2))], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), found], ["same", "keys", "shingles"])

    keys = members.groupBy("same").agg(F.collect_set("key").alias("keys"))  # at most a key a band
    made = texts.join(keys.hint("merge"), "same").select("same", "keys", "text").mapInArrow(released(run), "same long, keys array<long>, shingles binary")
    return made.select(F.explode("keys").alias("key"), "same", "shingles")


def similar(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Indices of verified links that connect all that similar pairs connect, directly or through others."""
    sizes = np.array([len(x) for x in sets], np.int64)
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sets)), sizes)
    seen = np.zeros(codes.max() + 1, bool)
    own = [codes[a : a + n] for a, n in zip(starts, sizes)]
    left = np.ones(len(sets), bool)  # not reached yet
    links, queue = [], []
    for root in range(len(sets)):
        if not left[root]:
            continue
        left[root] = False
        queue.append(root)
        while queue and left.any():
            keep = left[owner]
            if 2 * keep.sum() < len(owner):  # those reached drop out
                codes, owner = codes[keep], owner[keep]
            x = queue.pop()
            seen[own[x]] = True
            shared = np.bincount(owner[seen[codes]], minlength=len(sets))
            seen[own[x]] = False
            near = left & (shared * sum(SHARE) >= SHARE[0] * (sizes + sizes[x]))
            for y in np.flatnonzero(near).tolist():
                links.append((x, y))
                queue.append(y)
            left &= ~near
        queue.clear()
    return links


def _verified(rows: DataFrame) -> DataFrame:
    """(a, b): names of similar sets of rows(key, same, shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, names, sets = None, [], []

        def out() -> Iterator[pa.RecordBatch]:
            found = similar(sets) if len(sets) > 1 else []
            if found:
                cols = [pa.array([names[link[k]] for link in found], pa.int64()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(cols, ["a", "b"])

        for b in batches:
            for key, name, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                if key != at:
                    yield from out()
                    at, names, sets = key, [], []
                if not names or names[-1] != name:  # rows of a repeated id and text are one set
                    names.append(name)
                    sets.append(np.frombuffer(x.as_py(), np.uint64))
        yield from out()

    dealt = rows.select("key", "same", "shingles").repartition("key").sortWithinPartitions("key", "same")
    return dealt.mapInArrow(released(run), "a long, b long")


def _compared(rows: DataFrame, level: int) -> DataFrame:
    """rows(key, same, first, shingles, first_shingles) with near, whether they are similar, and their finer buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first = None, np.zeros(0, np.uint64)
        for b in batches:
            sizes, near, finer = [], [], []
            for key, name, x, y in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3), b.column(4)):
                if (key, name) != at:
                    at, first = (key, name), np.frombuffer(y.as_py(), np.uint64)
                own = np.frombuffer(x.as_py(), np.uint64)
                shared = len(np.intersect1d(own, first, assume_unique=True))
                sizes.append(len(own))
                near.append(shared * sum(SHARE) >= SHARE[0] * (len(own) + len(first)))
                finer.append(band_keys(own, level, key))
            cuts = pa.array(np.cumsum([0, *map(len, finer)]).astype(np.int32))
            flat = pa.array(np.concatenate(finer) if finer else np.zeros(0, np.int64))
            cols = [b.column(0), b.column(1), pa.array(sizes, pa.int32()), b.column(2), pa.array(near, pa.bool_()), pa.ListArray.from_arrays(cuts, flat)]
            yield pa.RecordBatch.from_arrays(cols, ["key", "same", "n", "first", "near", "finer"])

    return rows.select("key", "same", "first", "shingles", "first_shingles").mapInArrow(released(run), "key long, same long, n int, first long, near boolean, finer array<long>")


def _links(members: DataFrame, sets: Callable[[DataFrame], DataFrame], large: int, level: int = 0) -> DataFrame:
    """(a, b): verified links that connect what similar sets of a bucket of members(key, same, n) connect; sets adds their shingles."""
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("s"))
    big = stored(sizes.filter((F.col("m") > large) | (F.col("s") * 8 > LARGE_BYTES)).select("key"), "near-large")
    if level == DEPTH or not big.limit(1).count():
        return stored(_verified(sets(members)).distinct(), "near-links")
    found = _verified(sets(members.join(big, "key", "left_anti")))
    rest = members.join(big, "key", "left_semi")
    firsts = sets(rest.groupBy("key").agg(F.min("same").alias("same"))).dropDuplicates(["key"])
    firsts = firsts.select("key", F.col("same").alias("first"), F.col("shingles").alias("first_shingles"), F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt"))
    rows = sets(rest).withColumn("salt", F.pmod("same", F.lit(SALT)).cast("int"))
    compared = stored(_compared(rows.join(firsts, ["key", "salt"]), level + 1), "near-compared")
    found = stored(found.union(compared.filter("near AND same <> first").select(F.col("first").alias("a"), F.col("same").alias("b"))).distinct(), "near-links")
    unlinked = compared.filter("NOT near").select("key").distinct()
    again = compared.join(unlinked, "key", "left_semi").select(F.explode("finer").alias("key"), "same", "n", "near").distinct()
    # a finer bucket of members that are all linked to the first one has nothing to add
    left = again.groupBy("key").agg(F.min("near").alias("all"), F.min("same").alias("x"), F.max("same").alias("y")).filter("NOT all AND x < y").select("key")
    again = stored(again.join(left, "key", "left_semi").select("key", "same", "n"), "near-finer")
    return found if not again.limit(1).count() else found.union(_links(again, sets, large, level + 1))


def _open(members: DataFrame, links: DataFrame) -> DataFrame:
    """members(key, same, n) of the buckets whose sets aren't known to be in one group yet."""
    named = members.join(_labels(links), "same", "left").withColumn("group", F.coalesce("label", "same"))
    apart = named.groupBy("key").agg(F.min("group").alias("a"), F.max("group").alias("b")).filter("a < b").select("key")
    return _once(named.join(apart, "key", "left_semi").select("key", "same", "n"))


def _once(members: DataFrame) -> DataFrame:
    """Of buckets with the same members one: copies that meet in many bands are compared once."""
    told = [F.count(F.lit(1)).alias("m"), F.bit_xor("same").alias("x"), F.bit_xor(F.xxhash64("same")).alias("y")]
    kept = members.groupBy("key").agg(*told).groupBy("m", "x", "y").agg(F.min("key").alias("key")).select("key")
    return members.join(kept, "key", "left_semi")


def _labels(links: DataFrame) -> DataFrame:
    """(same, label): the smallest set within two links. Equal labels are in one group; different ones may be."""
    ends = links.union(links.select("b", "a")).select(F.col("a").alias("same"), F.col("b").alias("to"))
    near = ends.groupBy("same").agg(F.min("to").alias("to")).select("same", F.least("same", "to").alias("label"))
    further = ends.join(near.withColumnRenamed("same", "to"), "to").select("same", "label")
    return near.union(further).groupBy("same").agg(F.min("label").alias("label"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", large: int = LARGE) -> DataFrame:
    """(doc_id, same, component_id): component_id is the smallest doc_id reachable through similar texts."""
    sigs = stored(signatures(docs, id_col, text_col), "near-signatures")
    firsts = stored(sigs.groupBy("same").agg(F.min("doc_id").alias("first")), "near-distinct")
    banded = sigs.select("same", "n", F.posexplode("bands").alias("band", "key"))
    ends = banded.groupBy("key").agg(F.min("same").alias("a"), F.max("same").alias("b"))
    shared = stored(ends.filter("a < b").select("key"), "near-buckets")
    members = stored(banded.join(shared, "key").distinct(), "near-members")

    near = stored(by_fingerprint(sigs), "near-fingerprints")
    texts = stored(_candidates(docs, firsts, members.select("same").union(near.select("same")), id_col, text_col), "near-texts")

    def sets(some: DataFrame) -> DataFrame:
        return _with_sets(texts, some)

    links = _links(near, sets, large)
    for name, part in (("near-early", F.col("band") < EARLY), ("near-late", F.col("band") >= EARLY)):
        left = stored(_open(members.filter(part), links), name)
        if left.limit(1).count():
            links = links.union(_links(left, sets, large))
    return grouped(sigs.select("doc_id", "same"), firsts, links, "same")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each group: the one with the smallest id; odd ids as in simhash.dedup."""
    return one_of_each(docs, near_duplicates(docs, id_col, text_col), id_col)
