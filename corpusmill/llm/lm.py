"""Language-model scoring by a weighted backoff automaton.

The model is an n-gram model of words with Dirichlet smoothing: with c the
counts in training texts,

    P(w | ctx) = (c(ctx w) + mu P(w | shorter ctx)) / (c(ctx) + mu)
    P(w)       = (c(w) + 1) / (N + V + 1)

where N are all training tokens and V the distinct ones. As an automaton every
context seen in training is a state. Its arcs are the words seen after it, with
their smoothed probabilities; for any other word its failure arc leads to the
state of the shorter context at the weight mu / (c(ctx) + mu). A text is scored
in one traversal from left to right, which carries the state along.

The counts of the whole corpus never meet in one place. Texts are gathered in
blocks of about ``block_words`` words. Each block names its distinct n-grams by
64-bit hashes and deals them out by hash range; each range sums the counts of
all blocks and answers every block for the n-grams that it named. With its
answers a block builds the part of the automaton that its texts can reach.

Were every block to write to every range at once, the pieces would grow with
the square of the corpus. So no more than about ``fan`` blocks meet at a time: they are
summed up and cut into finer ranges, then ``fan`` of such sums meet, level by
level, until a range has met all blocks; the answers go back the same way. A
block has the same number of pieces on each level, and the levels grow with
the logarithm of the corpus. A hot n-gram is one entry a block, so no range is
larger for it.

Two different n-grams are taken as one if their 64-bit hashes agree.

Defined cases: a null text is the empty text, which is the end token alone. A
null doc_id counts as the empty text when texts are dealt to training and
held-out ones. Repeated rows count and are scored each by itself. An empty
training set leaves N = V = 0, so that every token has probability 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import codes, held_out, released, table, utf8
from corpusmill.session import stored

#: Hashes of the marks at a text's ends; a word never holds a space.
END, BEGIN = xxhash.xxh64_intdigest(b" end"), xxhash.xxh64_intdigest(b" begin")
#: The two lowest bits of a key tell unigrams, bigrams and trigrams apart; 3 is the begin mark.
BEGIN_TAG = 3


@dataclass(frozen=True)
class Params:
    """order: longest n-gram, at most 3; mu: the smoothing mass for order 2 and up."""

    order: int = 2
    mu: tuple[float, ...] = (200.0, 20.0)
    block_words: int = 1_000_000
    keys_a_range: int = 3_000_000
    fan: int = 256


def _pack(x: np.ndarray, planes: bool = False) -> bytes:
    raw = x.view(np.uint8).reshape(len(x), -1).T.tobytes() if planes and len(x) else x.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(data: bytes, kind: str, planes: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    if planes and len(raw):
        raw = np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).reshape(-1)
    return raw.view(kind)


class Block:
    """Texts as numbered words: word 0 is the begin mark and word 1 the end mark."""

    def __init__(self, numbers: np.ndarray, sizes: np.ndarray, held: np.ndarray, hashes: np.ndarray):
        """numbers: the tokens of all texts with both marks; sizes: tokens of each text, with both marks."""
        self.numbers, self.sizes, self.held, self.hashes = numbers, sizes, held, hashes
        self.starts = np.cumsum(sizes) - sizes

    @classmethod
    def of(cls, texts: list[bytes], held: list[bool]) -> Block:
        split = [t.lower().split() for t in texts]
        number, words = codes([w for ws in split for w in ws])
        sizes = np.array([len(ws) + 2 for ws in split], np.int64)
        x = np.ones(int(sizes.sum()), np.int64)
        ends = np.cumsum(sizes)
        x[ends - sizes] = 0
        inner = np.ones(len(x), bool)
        inner[ends - sizes] = inner[ends - 1] = False
        x[inner] = number + 2
        hashes = np.array([BEGIN, END] + [xxhash.xxh64_intdigest(w) for w in words], np.uint64)
        return cls(x, sizes, np.array(held, bool), hashes)

    def count(self, order: int) -> None:
        """Find the n-grams of each order: their keys, training counts, prefixes, suffixes and last words."""
        n, x = len(self.hashes), self.numbers
        trained = np.repeat(~self.held, self.sizes)
        depth = np.arange(len(x)) - np.repeat(self.starts, self.sizes)  # tokens before it in its text
        at = x  # the number of the n-gram that ends at each token
        tag = np.zeros(n, np.uint64)
        tag[0] = BEGIN_TAG
        self.keys = [(self.hashes & ~np.uint64(3)) | tag]
        self.counts = [np.bincount(x[trained], minlength=n)]
        self.prefix, self.suffix, self.last = [None], [None], [None]
        plain = self.hashes
        for m in range(2, order + 1):
            ends = np.flatnonzero(depth >= m - 1)
            pair = at[ends - 1] * n + x[ends]
            found, first, inverse = np.unique(pair, return_index=True, return_inverse=True)
            self.prefix.append(found // n)
            self.last.append(found % n)
            self.suffix.append(at[ends[first]])
            plain = plain[found // n] * np.uint64(0x9E3779B97F4A7C15) + self.hashes[found % n]
            plain = (plain ^ (plain >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            plain ^= plain >> np.uint64(29)
            self.keys.append((plain & ~np.uint64(3)) | np.uint64(m - 1))
            self.counts.append(np.bincount(inverse[trained[ends]], minlength=len(found)))
            at = np.zeros(len(x), np.int64)
            at[ends] = inverse

    def automaton(self, total: list[np.ndarray], n_tokens: int, n_words: int, mu: tuple[float, ...]) -> None:
        """Build states and arcs from the corpus counts of the block's n-grams, in the order of self.keys."""
        order, n = len(total), len(self.hashes)
        with np.errstate(divide="ignore"):
            p = (total[0] + 1.0) / (n_tokens + n_words + 1.0)
            self.base = np.log10(p)
            state = [np.where(total[k] > 0, 1, 0) for k in range(order - 1)]  # numbers of the states, 0 is the root
            top = 1
            for k, s in enumerate(state):
                state[k] = np.where(s > 0, top + np.cumsum(s) - 1, 0)
                top += int(s.sum())
            self.n_states = top
            fail, back = np.zeros(top, np.int64), np.zeros(top)
            self.root_next = state[0].tolist() if order > 1 else [0] * n
            self.begin = self.root_next[0]
            self.root_arc = self.base.tolist()
            arcs, arc_p, arc_to = [], [], []
            for k in range(order - 1):
                own = state[k] > 0
                weight = mu[k] / (total[k] + mu[k])
                back[state[k][own]] = np.log10(weight[own])
                if k:
                    fail[state[k][own]] = state[k - 1][self.suffix[k][own]]
                seen = total[k + 1] > 0
                ctx, suffix = self.prefix[k + 1], self.suffix[k + 1]
                q = (total[k + 1] + mu[k] * p[suffix]) / (total[k][ctx] + mu[k])
                q = np.where(seen, q, weight[ctx] * p[suffix])
                arcs.append(state[k][ctx[seen]] * n + self.last[k + 1][seen])
                arc_p.append(np.log10(q[seen]))
                arc_to.append((state[k + 1] if k + 2 < order else state[k][suffix])[seen])
                p = q
        self.arcs = dict(zip(np.concatenate(arcs).tolist(), range(sum(map(len, arcs))))) if arcs else {}
        self.arc_p = np.concatenate(arc_p).tolist() if arcs else []
        self.arc_to = np.concatenate(arc_to).tolist() if arcs else []
        self.fail, self.back = fail.tolist(), back.tolist()

    def traverse(self) -> np.ndarray:
        """The log10 probability of each text."""
        n, arc, p, to = len(self.hashes), self.arcs.get, self.arc_p, self.arc_to
        fail, back, root_p, root_to = self.fail, self.back, self.root_arc, self.root_next
        out = np.zeros(len(self.sizes))
        for i, (a, size) in enumerate(zip(self.starts.tolist(), self.sizes.tolist())):
            state, total = self.begin, 0.0
            for w in self.numbers[a + 1 : a + size].tolist():
                while state:
                    k = arc(state * n + w)
                    if k is not None:
                        total += p[k]
                        state = to[k]
                        break
                    total += back[state]
                    state = fail[state]
                else:
                    total += root_p[w]
                    state = root_to[w]
            out[i] = total
        return out

    def sums(self, values: np.ndarray) -> np.ndarray:
        """values, one for each token, summed over each text without its begin mark."""
        x = values.copy()
        x[self.starts] = 0
        return np.add.reduceat(x, self.starts) if len(x) else np.zeros(0, values.dtype)


def _blocks(docs: DataFrame, train: Column, id_col: str, text_col: str, p: Params) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), (~train).alias("held"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, words = TaskContext.get().partitionId(), 0, 0
        ids, texts, held = [], [], []
        id_type = pa.int64()

        def close() -> pa.RecordBatch:
            nonlocal seq, words
            b = Block.of(texts, held)
            cols = [pa.array([(part << 32) | seq], pa.int64()), pa.array([ids], pa.list_(id_type)), pa.array([held], pa.list_(pa.bool_()))]
            cols += [pa.array([b.sizes.tolist()], pa.list_(pa.int64()))]
            cols += [pa.array([_pack(b.numbers.astype(np.uint32), True)]), pa.array([b.hashes.tobytes()])]
            trained = int((b.sizes[~b.held] - 1).sum())
            seq, words = seq + 1, 0
            for x in (ids, texts, held):
                x.clear()
            return pa.RecordBatch.from_arrays([*cols, pa.array([trained])], ["block", "ids", "held", "sizes", "numbers", "hashes", "trained"])

        for batch in batches:
            id_type = batch.schema.field(0).type
            for name, t, h in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist()):
                ids.append(name)
                texts.append(t)
                held.append(h)
                words += 1 + len(t) // 6
                if words >= p.block_words:
                    yield close()
        if ids:
            yield close()

    return rows.mapInArrow(released(run), f"block long, ids array<{kind}>, held array<boolean>, sizes array<long>, numbers binary, hashes binary, trained long")


def _restore(batch: pa.RecordBatch, i: int) -> Block:
    col = lambda name: batch.column(batch.schema.get_field_index(name))[i].as_py()
    numbers = _unpack(col("numbers"), "<u4", True).astype(np.int64)
    return Block(numbers, np.array(col("sizes"), np.int64), np.array(col("held"), bool), np.frombuffer(col("hashes"), np.uint64))


def levels(n_blocks: int, partitions: int, p: Params) -> tuple[int, int]:
    """On how many levels blocks meet, and by how many bits of the keys each level cuts finer ranges."""
    ranges = max(partitions, -(-n_blocks * p.block_words // p.keys_a_range))
    n = 1
    while p.fan**n < n_blocks:
        n += 1
    return n, max(1, -(-(ranges - 1).bit_length() // n))


def _pieces(keys: np.ndarray, counts: np.ndarray, low: int, depth: int, bits: int) -> tuple[list[int], list[bytes], list[bytes]]:
    """Sorted keys of the range `low` at depth - 1, cut into those of the next depth: the ranges, keys and counts of each."""
    first = low << bits
    limits = [((first + k) << (64 - bits * depth)) for k in range(1, 1 << bits)]
    cuts = [0, *np.searchsorted(keys, np.array(limits, np.uint64)).tolist(), len(keys)]
    full = [k for k in range(1 << bits) if cuts[k] < cuts[k + 1]]
    delta = [_pack(np.diff(keys[cuts[k] : cuts[k + 1]], prepend=np.uint64(0)), True) for k in full]
    return [first + k for k in full], delta, [_pack(counts[cuts[k] : cuts[k + 1]].astype(np.uint64), True) for k in full]


#: What meets: the pieces of a range, and of a group of blocks, that somebody (by) asks about, or the answers to finer ranges (kind 1).
PIECES = "range long, grp long, kind int, by long, keys binary, counts binary"
ANSWERS = "range long, by long, totals binary, words long"


def _batch(schema: str, cols: list[list]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], [n for n, _ in fields])


def _named(blocks: DataFrame, n_levels: int, bits: int, p: Params) -> DataFrame:
    """The pieces that blocks ask about on the first level. Blocks fall into groups by their hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b, block = _restore(batch, i), batch.column(0)[i].as_py()
                b.count(p.order)
                keys = np.concatenate(b.keys)
                by = np.argsort(keys)
                where, delta, counts = _pieces(keys[by], np.concatenate(b.counts)[by], 0, 1, bits)
                grp = xxhash.xxh64_intdigest(block.to_bytes(8, "little")) % p.fan**n_levels // p.fan
                n = len(where)
                yield _batch(PIECES, [where, [grp] * n, [0] * n, [block] * n, delta, counts])

    return blocks.mapInArrow(released(run), PIECES)


def _met(pieces: DataFrame, level: int, gives: str, top: bool, bits: int, partitions: int, p: Params) -> DataFrame:
    """What comes of the pieces that meet by range and group.

    gives ANSWERS, to all who asked, by the sums on the top level and else by the
    answers to finer ranges that are among the pieces; or gives PIECES: the sums
    as pieces of finer ranges, about which the group asks.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, asked, answers = None, [], []

        def close() -> Iterator[pa.RecordBatch]:
            keys = [np.cumsum(_unpack(k, "<u8", True), dtype=np.uint64) for _, k, _ in asked]
            found, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            if answers:
                total = np.concatenate([_unpack(x, "<u8", True) for x in answers])
            else:
                counts = np.concatenate([_unpack(c, "<u8", True) for _, _, c in asked])
                total = np.bincount(inverse, weights=counts, minlength=len(found)).astype(np.uint64)
                if gives == PIECES:
                    where, delta, sums = _pieces(found, total, at[0], level + 1, bits)
                    n = len(where)
                    yield _batch(PIECES, [where, [at[1] // p.fan] * n, [0] * n, [at[1]] * n, delta, sums])
                    return
            words = int((((found & np.uint64(3)) == 0) & (total > 0)).sum()) if top else 0
            lo = 0
            for nth, ((by, _, _), k) in enumerate(zip(asked, keys)):
                blob = _pack(total[inverse[lo : lo + len(k)]], True)
                lo += len(k)
                yield _batch(ANSWERS, [[at[0]], [by], [blob], [0 if nth else words]])

        for batch in batches:
            for where, grp, kind, by, k, c in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if (where, grp) != at and asked:
                    yield from close()
                    asked.clear()
                    answers.clear()
                at = where, grp
                if kind:
                    answers.append(k)
                else:
                    asked.append((by, k, c))
        if asked:
            yield from close()

    # ranges are alike in size, so dealing them out in turn is even
    dealt = pieces.repartitionById(partitions, F.pmod(F.col("range") + F.col("grp") * (1 << bits), F.lit(partitions)).cast("int")).sortWithinPartitions("range", "grp", "kind", "by")
    return dealt.mapInArrow(released(run), gives)


def exchanged(blocks: DataFrame, n_levels: int, bits: int, partitions: int, p: Params) -> tuple[DataFrame, int]:
    """(range, by, totals, words) that answer each block, by, and the number of distinct training words."""
    pieces = [_named(blocks, n_levels, bits, p)]
    for level in range(1, n_levels):
        pieces[-1] = stored(pieces[-1], "lm-pieces")  # for the way back
        pieces.append(_met(pieces[-1], level, PIECES, False, bits, partitions, p))
    answers = stored(_met(pieces.pop(), n_levels, ANSWERS, True, bits, partitions, p), "lm-answers")
    words = answers.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    for level in range(n_levels - 1, 0, -1):
        finer = answers.select(F.shiftright("range", bits).alias("range"), F.col("by").alias("grp"), F.lit(1).alias("kind"), F.col("range").alias("by"), F.col("totals").alias("keys"), F.lit(None).cast("binary").alias("counts"))
        answers = stored(_met(pieces.pop().union(finer), level, ANSWERS, False, bits, partitions, p), "lm-answers")
    return answers, words


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of docs.

    The model learns from the rows where train holds. base_score is the unigram
    score, score the model's; both are log10 probabilities of the whole text.
    """
    spark = docs.sparkSession
    blocks = stored(_blocks(docs, train, id_col, text_col, p), "lm-blocks")
    n_blocks, tokens = blocks.agg(F.count(F.lit(1)), F.coalesce(F.sum("trained"), F.lit(0))).first()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_levels, bits = levels(n_blocks, partitions, p)
    partitions = 1 << bits if n_levels == 1 else max(partitions, -(-n_blocks * p.block_words // p.keys_a_range))
    answers, words = exchanged(blocks, n_levels, bits, partitions, p)
    own = answers.groupBy(F.col("by").alias("block")).agg(F.array_sort(F.collect_list(F.struct("range", "totals"))).alias("answers"))
    kind = blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            answer = batch.column(batch.schema.get_field_index("answers"))
            ids = batch.column(batch.schema.get_field_index("ids"))
            for i in range(batch.num_rows):
                b = _restore(batch, i)
                b.count(p.order)
                keys = np.concatenate(b.keys)
                total = np.empty(len(keys), np.float64)
                total[np.argsort(keys)] = np.concatenate([_unpack(x["totals"], "<u8", True) for x in answer[i].as_py()])
                b.automaton(np.split(total, np.cumsum([len(k) for k in b.keys])[:-1]), tokens, words, p.mu)
                known = b.sums((total[: len(b.hashes)] > 0)[b.numbers].astype(np.int64))
                n = len(b.sizes)
                cols = [ids[i].values, pa.array(b.held), pa.array(b.sizes - 1), pa.array(known), pa.array(np.full(n, tokens, np.int64))]
                cols += [pa.array(b.sums(b.base[b.numbers])), pa.array(b.traverse())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    result = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return blocks.join(own, "block").select("block", "ids", "held", "sizes", "numbers", "hashes", "answers").mapInArrow(released(run), result)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, ~held_out(F.col("doc_id"), 7))
