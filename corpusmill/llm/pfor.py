"""Token ids in patched frame-of-reference blocks.

Texts are encoded whole, each document's ids are followed by an end id, and
all ids are stored in ascending document order. The store is a folder with two
Parquet tables, which Spark writes and commits:

``segments``  one row for some hundred thousand ids: shard, seq, offset (ids
              before it in its shard), doc_ids, n_tokens (per document) and
              ``data``, the blocks. A document is never cut between segments.
``shards``    shard and start, the ids in all shards before it.

``data`` is: magic ``PFR1``; ids and blocks, each uint32; the block index, the
start byte of each block as uint32; the blocks. A block holds BLOCK ids (the
last is padded): its minimum as uint32; the bit width; the number of
exceptions; the low bits of ids minus minimum, packed little-endian; the
exceptions' positions, a byte each; the exceptions' high bits as uint32. The
width is a percentile of the block's bit lengths, of several the one that
makes the block shortest. All integers are little-endian.

Defined cases: a null text is the empty text and has the end id alone. A null
doc_id comes first. Rows that repeat a doc_id are ordered by the hash of their
ids and then their ids; equal rows are stored as often as they come. A very
long text is encoded whole, by one worker. An empty table makes an empty store.
Other columns of docs, whatever their names, are not read.
"""

from __future__ import annotations

import json
import os
import string
import struct
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusmill.llm.common import CACHES, released, slices, table, utf8
from corpusmill.session import small_batches, table_path

BLOCK = 128
MAGIC = b"PFR1"
PERCENTILES = (50, 75, 90, 95, 98, 100)
#: A segment is closed at the first document end after so many ids.
SEGMENT = 1 << 18
#: Bytes of words and ids that a worker remembers, and those of a dictionary's entry; beyond that it starts anew.
CACHE_BYTES, ENTRY_BYTES = 96 << 20, 200
#: Keys sampled for each range of the order.
SAMPLES = 50
#: Texts are encoded in slices of about this many bytes.
TEXT_BYTES = 4 << 20
#: Letters that stay letters in normal form; the one whose lower case ends in a mark, U+0130, is excluded where this is used.
LETTERS = "^[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0388-\u03ce\u0400-\u0481\u4e00-\u9fff]+$"
#: Fixed value: the pattern by which the tokenizer cuts texts.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Words that are encoded as one text.
LINE = 256

_encoders: dict[str, Callable] = {}
CACHES.append(_encoders)


def _bits(x: np.ndarray, width: int) -> np.ndarray:
    """(rows, BLOCK) numbers below 2**width as (rows, BLOCK * width / 8) packed bytes."""
    size = 2 if width <= 16 else 4
    raw = np.ascontiguousarray(x.astype(f"<u{size}")).view(np.uint8).reshape(-1, size)
    bits = np.unpackbits(raw, axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.reshape(len(x), BLOCK * width), axis=1, bitorder="little")


def _unbits(packed: np.ndarray, width: int) -> np.ndarray:
    size = 2 if width <= 16 else 4
    full = np.zeros((len(packed) * BLOCK, 8 * size), np.uint8)
    full[:, :width] = np.unpackbits(packed, axis=1, bitorder="little").reshape(-1, width)
    return np.packbits(full, axis=1, bitorder="little").view(f"<u{size}").reshape(-1, BLOCK).astype(np.uint32)


def pack(ids: np.ndarray) -> bytes:
    """The ids (uint32) as a segment's data."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    if not n:
        return MAGIC + struct.pack("<II", 0, 0)
    x = np.concatenate([ids, np.full(blocks * BLOCK - n, ids[-1], np.uint32)]).reshape(blocks, BLOCK).astype(np.uint32)
    low = x.min(axis=1)
    d = x - low[:, None]
    length = np.frexp(d.astype(np.float64))[1].astype(np.uint8)
    ranked = np.sort(length, axis=1)
    best, width = None, np.zeros(blocks, np.int64)
    for p in PERCENTILES:
        w = ranked[:, max(0, -(-p * BLOCK // 100) - 1)].astype(np.int64)
        cost = w * BLOCK // 8 + 5 * (length > w[:, None]).sum(axis=1)
        width = w if best is None else np.where(cost < best, w, width)
        best = cost if best is None else np.minimum(best, cost)
    over = length > width[:, None]
    n_over = over.sum(axis=1)
    sizes = 6 + width * BLOCK // 8 + 5 * n_over
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[starts[:, None] + np.arange(4)] = low.astype("<u4")[:, None].view(np.uint8)
    out[starts + 4] = width
    out[starts + 5] = n_over
    for w in np.unique(width):
        if w:
            at = np.flatnonzero(width == w)
            mask = np.uint32((1 << int(w)) - 1)
            out[starts[at, None] + 6 + np.arange(w * BLOCK // 8)] = _bits(d[at] & mask, int(w))
    row, pos = np.nonzero(over)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
    base = starts + 6 + width * BLOCK // 8
    out[base[row] + nth] = pos
    high = (d[row, pos].astype(np.uint64) >> width[row].astype(np.uint64)).astype("<u4")
    if len(row):
        out[(base + n_over)[row, None] + 4 * nth[:, None] + np.arange(4)] = high[:, None].view(np.uint8)
    return b"".join([MAGIC, struct.pack("<II", n, blocks), starts.astype("<u4").tobytes(), out.tobytes()])


def unpack(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks first to last of a segment, through its block index; all by default."""
    if data[:4] != MAGIC:
        raise ValueError("not a segment")
    n, blocks = struct.unpack_from("<II", data, 4)
    last = blocks if last is None else min(last, blocks)
    if last <= first:
        return np.zeros(0, np.uint32)
    starts = np.frombuffer(data, "<u4", blocks, 12).astype(np.int64)[first:last]
    raw = np.frombuffer(data, np.uint8, offset=12 + 4 * blocks)
    low = raw[starts[:, None] + np.arange(4)].view("<u4")[:, 0]
    width, n_over = raw[starts + 4].astype(np.int64), raw[starts + 5].astype(np.int64)
    d = np.zeros((last - first, BLOCK), np.uint32)
    for w in np.unique(width):
        if w:
            at = np.flatnonzero(width == w)
            d[at] = _unbits(raw[starts[at, None] + 6 + np.arange(w * BLOCK // 8)], int(w))
    if n_over.any():
        row = np.repeat(np.arange(last - first), n_over)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
        base = starts + 6 + width * BLOCK // 8
        pos = raw[base[row] + nth]
        high = np.ascontiguousarray(raw[(base + n_over)[row, None] + 4 * nth[:, None] + np.arange(4)]).view("<u4")[:, 0]
        d[row, pos] |= (high.astype(np.uint64) << width[row].astype(np.uint64)).astype(np.uint32)
    return (d + low[:, None]).reshape(-1)[: n - first * BLOCK]


class Words:
    """Words and their ids, up to a bound in bytes: beyond it those that came once since they were learned are forgotten, or all."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.used = 0
        self._sizes, self._ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
        self._came = np.zeros(0, np.int32)

    def add(self, words: list[bytes], sizes: np.ndarray, ids: np.ndarray) -> None:
        """New words, each with its ids."""
        n = len(self.number)
        self.number.update(zip(words, range(n, n + len(words))))
        self._sizes.append(sizes)
        self._ids.append(ids)
        self.used += sum(map(len, words)) + ENTRY_BYTES * len(words) + ids.nbytes

    def came(self, numbers: np.ndarray) -> None:
        self._came = np.concatenate([self._came, np.zeros(len(self.number) - len(self._came), np.int32)])
        self._came[numbers] += 1

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By word number: where its ids start and how many there are; and all ids."""
        for x in (self._sizes, self._ids):
            x[:] = [np.concatenate(x)]
        return np.cumsum(self._sizes[0]) - self._sizes[0], self._sizes[0], self._ids[0]

    def shrink(self) -> None:
        if self.used <= self.limit:
            return
        starts, sizes, ids = self.tables()
        at = np.flatnonzero(self._came[: len(sizes)] > 1)
        words = list(self.number)
        kept = [words[k] for k in at.tolist()]
        self.clear()
        self.add(kept, sizes[at], _gathered(ids, starts[at], sizes[at]))
        self.came(np.zeros(0, np.int64))
        if self.used > self.limit // 2:
            self.clear()


def _gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ids one after another."""
    ends = np.cumsum(sizes)
    return ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


def _cuts_words(path: str) -> bool:
    """Whether the tokenizer is one whose ids of a text are those of its white-space separated words."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("normalizer") or {}).get("normalizers") or []
    cut = ((spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    lowered = [x.get("type") for x in steps] == ["NFC", "Replace", "Lowercase"]
    words = cut.get("type") == "Split" and cut.get("pattern") == {"Regex": WORD_PATTERN} and cut.get("behavior") == "Removed" and cut.get("invert")
    return bool(lowered and words and spec["model"].get("end_of_word_suffix") == "</w>" and all(t["content"].startswith("<|") for t in spec["added_tokens"]))


def encoder(path: str) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """A function from texts (an Arrow array of strings) to all their ids, one text after the other, and the ids that each has.

    Words are cut and numbered by Arrow; each distinct word is encoded once and
    remembered, up to CACHE_BYTES. A tokenizer file without the properties that
    this needs encodes whole texts.
    """
    if path in _encoders:
        return _encoders[path]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)

    def each(items: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in items], add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter((i for x in got for i in x), np.uint32, int(sizes.sum())), sizes

    if not _cuts_words(path):
        _encoders[path] = lambda texts: each([t or b"" for t in texts.cast(pa.binary()).to_pylist()])
        return _encoders[path]
    known = Words()
    closes = np.zeros(tokenizer.get_vocab_size(), bool)  # ids that end a word
    closes[[i for token, i in tokenizer.get_vocab().items() if token.endswith("</w>")]] = True

    def of_letters(words: pa.Array) -> pa.Array:
        return pc.and_(pc.match_substring_regex(words, LETTERS), pc.invert(pc.match_substring(words, "\u0130")))

    def learn_lines(words: list[bytes]) -> None:
        """Words of letters, each at least one word to the tokenizer: a line of them is encoded at once and cut where a word ends."""
        parts = [words[k : k + LINE] for k in range(0, len(words), LINE)]
        got = tokenizer.encode_batch_fast([b" ".join(p).decode("utf-8", "replace") for p in parts], add_special_tokens=False)
        for part, e in zip(parts, got):
            ids = np.array(e.ids, np.uint32)
            ends = np.flatnonzero(closes[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                known.add(part, np.diff(ends, prepend=0), ids)
            else:  # one of them is cut into several
                ids, sizes = each(part)
                known.add(part, sizes, ids)

    def numbers(items: pa.Array, letters: np.ndarray) -> np.ndarray:
        """The numbers of distinct items, learning those that aren't known; letters: whether an item is of letters alone."""
        items = items.cast(pa.binary()).to_pylist()
        number = known.number.get
        out = np.fromiter((number(w, -1) for w in items), np.int64, len(items))
        new = np.flatnonzero(out < 0)
        by = np.concatenate([new[letters[new]], new[~letters[new]]])  # as they are added
        first, n = len(known.number), int(letters[new].sum())
        added = [items[k] for k in by.tolist()]
        learn_lines(added[:n])
        for k in range(n, len(added), 4096):
            ids, sizes = each(added[k : k + 4096])
            known.add(added[k : k + 4096], sizes, ids)
        out[by] = first + np.arange(len(by))
        known.came(out)
        return out

    def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        known.shrink()
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        cuts = split.offsets.to_numpy() - split.offsets[0].as_py()
        coded = pc.filter(flat := split.flatten(), filled := pc.not_equal(flat, "")).dictionary_encode()  # white space at the ends leaves empty words
        cuts = np.concatenate([[0], np.cumsum(filled.to_numpy(zero_copy_only=False))])[cuts]
        words = coded.dictionary
        # letters and the marks after them are always cut apart, so words with and without marks at their end share their ids
        lower = pc.ascii_lower(words)
        core = pc.ascii_rtrim(lower, string.punctuation)
        plain = of_letters(core)
        special = pc.match_substring(words, "<|")  # may be a special token: as it is
        core = pc.if_else(plain, core, pc.if_else(special, words, lower))
        cores = core.dictionary_encode()
        at = numbers(cores.dictionary, of_letters(cores.dictionary).to_numpy(zero_copy_only=False))[cores.indices.to_numpy()]
        # what follows the core of a plain word: a few marks, so each length is cut off by itself
        marks = np.full(len(words), numbers(pa.array([""]), np.zeros(1, bool))[0])
        left = np.where(plain.to_numpy(zero_copy_only=False), pc.binary_length(lower).to_numpy() - pc.binary_length(core).to_numpy(), 0)
        for n in np.unique(left[left > 0]).tolist():
            those = np.flatnonzero(left == n)
            tails = pc.utf8_slice_codeunits(pc.take(lower, pa.array(those)), start=-n).dictionary_encode()
            marks[those] = numbers(tails.dictionary, np.zeros(len(tails.dictionary), bool))[tails.indices.to_numpy()]
        starts, sizes, ids = known.tables()
        pieces = np.stack([at, marks], axis=1).reshape(-1)
        own = _gathered(ids, starts[pieces], sizes[pieces])  # the ids of each distinct word
        own_sizes = sizes[pieces].reshape(-1, 2).sum(axis=1)
        own_starts = np.cumsum(own_sizes) - own_sizes
        k = coded.indices.to_numpy()
        out = _gathered(own, own_starts[k], own_sizes[k])
        total = np.concatenate([[0], np.cumsum(own_sizes[k])])[cuts]
        return out, np.diff(total)

    _encoders[path] = encode
    return encode


def _wide(tokenizer: str, end_id: int) -> np.dtype:
    """The integers that ids are shuffled as: two bytes each where all fit."""
    with open(tokenizer, encoding="utf-8") as f:
        spec = json.load(f)
    most = max([end_id, len(spec["model"].get("vocab") or ()), *(t["id"] for t in spec.get("added_tokens") or ())])
    return np.dtype("<u2" if most < 1 << 16 else "<u4")


def _place(name, tie: int, spread: int) -> tuple:
    """A row's place in the order of the store; null ids come first."""
    return (name is not None, 0 if name is None else name, tie, spread)


def _bounds(keys: DataFrame, parts: int) -> list[tuple]:
    """The first places of all ranges but the first, from about SAMPLES keys a range."""
    share = min(1.0, SAMPLES * parts / max(1, keys.count()))
    found = sorted(_place(*r) for r in (keys if share == 1 else keys.sample(share, seed=3)).collect())
    return [found[len(found) * k // parts] for k in range(1, parts)] if found else []


def _encoded_rows(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str, parts: int) -> DataFrame:
    """(part, doc_id, tie, ids): each text's ids with the end id, as bytes, and the range that the row belongs to."""
    kind = _wide(tokenizer, end_id)
    text = F.col(text_col).cast("string")
    # spread tells equal rows apart, so that even those are cut into ranges
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("tie"), F.xxhash64(F.monotonically_increasing_id()).alias("spread"), text.alias("text"))
    bounds = _bounds(rows.select("doc_id", "tie", "spread"), parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for b in batches:
            where = pa.array([bisect_right(bounds, _place(*r)) for r in zip(*(b.column(k).to_pylist() for k in range(3)))], pa.int32())
            for i, j in slices(utf8(b.column(3)), TEXT_BYTES):
                ids, sizes = encode(b.column(3).slice(i, j - i))
                ends = np.cumsum(sizes + 1)
                out = np.full(int(ends[-1]), end_id, kind)
                inner = np.ones(len(out), bool)
                inner[ends - 1] = False
                out[inner] = ids
                offsets = np.concatenate([[0], ends]) * kind.itemsize
                cells = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(out)])
                cols = [x.slice(i, j - i) for x in (where, b.column(0), b.column(1))]
                yield pa.RecordBatch.from_arrays([*cols, cells.cast(pa.binary())], ["part", "doc_id", "tie", "ids"])

    return rows.mapInArrow(released(run, keeps=True), f"part int, doc_id {rows.schema[0].dataType.simpleString()}, tie long, ids binary")


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode the texts and write the store at path, which must be a folder that all executors share.

    Texts are encoded where they lie; ids, which are far smaller, are sorted.
    """
    width = _wide(tokenizer, end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, seq, offset, held = TaskContext.get().partitionId(), 0, 0, 0
        names: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        parts: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal seq, offset, held
            x, n, who = np.concatenate(parts), np.concatenate(sizes), pa.concat_arrays(names)
            lists = [pa.ListArray.from_arrays(pa.array([0, len(n)], pa.int32()), v) for v in (who, pa.array(n))]
            cols = [pa.array([shard], pa.int32()), pa.array([seq], pa.int32()), pa.array([offset], pa.int64()), *lists, pa.array([pack(x)], pa.binary())]
            seq, offset, held = seq + 1, offset + len(x), 0
            for held_now in (names, sizes, parts):
                held_now.clear()
            return pa.RecordBatch.from_arrays(cols, ["shard", "seq", "offset", "doc_ids", "n_tokens", "data"])

        for b in batches:
            col = b.column(1).cast(pa.large_binary())
            cuts = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, 8 * col.offset) // width.itemsize
            ids = np.frombuffer(col.buffers()[2], width, int(cuts[-1])) if cuts[-1] else np.zeros(0, width)
            at = 0
            while at < len(col):
                end = min(len(col), int(np.searchsorted(cuts, cuts[at] + SEGMENT - held)))
                end = max(end, at + 1)
                names.append(b.column(0).slice(at, end - at))
                sizes.append(np.diff(cuts[at : end + 1]))
                parts.append(ids[cuts[at] : cuts[end]].astype(np.uint32))
                held += int(cuts[end] - cuts[at])
                at = end
                if held >= SEGMENT:
                    yield close()
        if parts:
            yield close()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = _encoded_rows(docs, tokenizer, end_id, id_col, text_col, parts)
    kind = rows.schema["doc_id"].dataType.simpleString()
    placed = rows.repartitionById(parts, "part").sortWithinPartitions("doc_id", "tie", "ids")
    segments = placed.select("doc_id", "ids").mapInArrow(released(run), f"shard int, seq int, offset long, doc_ids array<{kind}>, n_tokens array<long>, data binary")
    with small_batches(docs.sparkSession):
        segments.write.option("compression", "none").parquet(f"{path}/segments")
    spark = docs.sparkSession
    totals = spark.read.parquet(f"{path}/segments").select("shard", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    # a row for each shard, of which there are as many as partitions
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = totals.groupBy("shard").agg(F.sum("n").alias("n")).select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    shards.write.parquet(f"{path}/shards")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the stored blocks."""
    return _documents(spark, path, ids=False)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) per document, from the stored blocks."""
    return _documents(spark, path, ids=True)


def _documents(spark: SparkSession, path: str, ids: bool) -> DataFrame:
    segments = spark.read.parquet(f"{path}/segments").select("shard", "offset", "doc_ids", "n_tokens", "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x = unpack(b.column(4)[i].as_py()).astype("<u4")
                sizes = b.column(3)[i].values.to_numpy()
                ends = np.cumsum(sizes)
                raw = memoryview(x.tobytes())
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                starts = b.column(1)[i].as_py() + ends - sizes
                cols = [b.column(2)[i].values, pa.array(np.full(len(sizes), b.column(0)[i].as_py(), np.int32)), pa.array(starts), pa.array(sizes), pa.array(crc, pa.int64())]
                names = ["doc_id", "shard", "at", "n_tokens", "ids_crc32"]
                if ids:
                    cuts = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                    cols.append(pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int64))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    more = ", ids array<long>" if ids else ""
    docs = segments.mapInArrow(released(run), f"doc_id {kind}, shard int, at long, n_tokens long, ids_crc32 long{more}")
    shards = spark.read.parquet(f"{path}/shards")
    start = (F.col("at") + F.col("start")).alias("start")
    return docs.join(shards, "shard").select("doc_id", start, "n_tokens", "ids_crc32", *["ids"] * ids)


def encoded(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write docs to a store in the shared folder and read it back."""
    path = table_path(docs.sparkSession, "token-ids")
    write(docs, path, tokenizer, end_id, id_col, text_col)
    return read(docs.sparkSession, path)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"), tokenizer_path())
