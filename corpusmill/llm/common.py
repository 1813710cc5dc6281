"""What the operators of this subpackage share.

Words are maximal runs of bytes other than the six ASCII white-space bytes
0x20 and 0x09-0x0D. That is what ``bytes.split()`` cuts at, and
``bytes.lower()`` lower-cases A-Z alone, so texts are handled as UTF-8 bytes.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.session import spread

SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"

#: Texts are worked on in slices of about this many bytes, however large an Arrow batch is.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


class Texts:
    """A column of texts as UTF-8, null as the empty text. Bytes objects are made for the rows asked for alone."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        self.column = column.cast(pa.large_binary())

    def __len__(self) -> int:
        return len(self.column)

    def __getitem__(self, at: slice) -> list[bytes]:
        return [x or b"" for x in self.column[at].to_pylist()]

    def __iter__(self) -> Iterator[bytes]:
        for i in range(0, len(self), 256):
            yield from self[i : i + 256]

    def sizes(self) -> list[int]:
        return pc.fill_null(pc.binary_length(self.column), 0).to_pylist()


def utf8(column: pa.Array | pa.ChunkedArray) -> Texts:
    return Texts(column)


def slices(texts: Texts | list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive [from, to) of about limit bytes each; one text is never cut."""
    start = size = 0
    for i, n in enumerate(texts.sizes() if isinstance(texts, Texts) else map(len, texts)):
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


#: What a worker remembers between tasks of one kind.
CACHES: list[dict] = []


def released(run: Callable, keeps: bool = False) -> Callable:
    """run, a function over batches, that gives memory back to the system at its end: workers are kept for later tasks.

    Unless run keeps them, it also forgets what tasks of another kind remembered.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cache in CACHES if not keeps else ():
            cache.clear()
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # not with every C library
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def codes(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Each word's number and the distinct words, numbered as they come."""
    seen: dict[bytes, int] = {}
    number = seen.setdefault
    got = np.fromiter((number(w, len(seen)) for w in words), np.int64, len(words))
    return got, list(seen)


def held_out(doc_id: Column, modulus: int, rest: int = 2) -> Column:
    """Whether crc32(doc_id as text) mod modulus is rest; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == rest
