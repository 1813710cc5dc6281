"""Document features: character and word statistics of whole texts."""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as T
from corpusmill.functions.lexicons import FLAGGED, STOPWORDS, special_characters
from corpusmill.operators.minhash import sliced

#: The bound that doc_features_char_limited has; texts are taken whole by default.
MAX_CHARS = 100_000


def _entropy(counts: np.ndarray) -> float:
    n = counts.sum()
    return float(np.log2(n) - (counts * np.log2(counts)).sum() / n) if n else 0.0


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The codes that occur, in order, and how often each does."""
    if codes.max() >= 1 << 16:
        return np.unique(codes, return_counts=True)
    n = np.bincount(codes)
    known = np.flatnonzero(n)
    return known, n[known]


def _gram_counts(codes: np.ndarray, n: int) -> np.ndarray:
    """How often each run of n codes occurs, by exact numbers for them."""
    if len(codes) < n:
        return np.zeros(0, np.int64)
    known = _counted(codes)[0]
    place = np.zeros(int(known[-1]) + 1, np.uint64)
    place[known] = np.arange(len(known))
    number, base, span = place[codes], len(known), 1
    while span < n:
        step = min(n - span, max(1, int(63 / max(1.0, np.log2(base)) - 1))) if span == 1 else min(span, n - span)
        if span == 1:  # as many codes as a number holds
            packed = number[: len(number) - step].copy()
            for k in range(1, step + 1):
                packed *= np.uint64(base)
                packed += number[k : len(number) - step + k]
            number, span = packed, 1 + step
        else:
            number = np.unique(number, return_inverse=True)[1].astype(np.uint64)
            number = number[:-step] * np.uint64(int(number.max()) + 1) + number[step:]
            span += step
    number = np.sort(number)
    edges = np.flatnonzero(np.r_[True, number[1:] != number[:-1], True])
    return np.diff(edges)


@lru_cache(maxsize=2)
def _lowered(special: frozenset[str]) -> tuple[np.ndarray, np.ndarray]:
    """By code point: that of its lower case, and whether this is special. Lower case of several characters counts as one of its own."""
    low = np.fromiter((ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(sys.maxunicode + 1)), np.uint32, sys.maxunicode + 1)
    marked = np.zeros(sys.maxunicode + 1, bool)
    marked[[ord(c) for c in special]] = True
    return low, marked


def _char_features(text: str, low: np.ndarray, special: np.ndarray) -> tuple[float, float, float]:
    if not text:
        return 0.0, 0.0, 0.0
    x = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    counts = _gram_counts(x, 10)
    u = len(counts)
    k = min(int(np.sqrt(u)), u - int((counts > 1).sum()))
    repetition = float(np.sort(counts)[::-1][:k].sum() / counts.sum()) if u else 0.0
    x = low[x]
    return repetition, float(special[x].sum() / len(x)), _entropy(_counted(x)[1])


def char_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_chars: int | None = None, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, document_length, character_repetition_ratio, special_character_ratio, char_entropy, carried...), ratios to 3 places.

    The length counts all characters; so does the rest, or the first max_chars. A null text is empty.
    Columns of docs that are carried go along, so that they need not be joined again.
    """
    special = special_characters()
    names = ["doc_id", "document_length", "character_repetition_ratio", "special_character_ratio", "char_entropy"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, marked = _lowered(special)
        for b in batches:
            for first, texts in sliced(b.column(1)):
                rows = [_char_features(t if max_chars is None else t[:max_chars], low, marked) for t in texts]
                cols = [pa.array([r[k] for r in rows], pa.float64()) for k in range(3)]
                own = [b.column(k).slice(first, len(texts)) for k in (0, *range(2, b.num_columns))]
                yield pa.RecordBatch.from_arrays([own[0], pa.array([len(t) for t in texts], pa.int64()), *cols, *own[1:]], [*names, *carried])

    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carried)
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in ids.schema if f.name != "text"]
    out = ids.mapInArrow(run, ", ".join([kinds[0], "document_length long", *(n + " double" for n in names[2:]), *kinds[1:]]))
    return out.select("doc_id", "document_length", *(F.round(c, 3).alias(c) for c in names[2:]), *carried)


def _word_features(words: list[str], stopwords: frozenset[str], flagged: frozenset[str], n: int) -> tuple[int, float, float, float, float]:
    if not words:
        return 0, 0.0, 0.0, 0.0, 0.0
    size = len(words)
    grams = Counter(zip(*(words[k:] for k in range(n))))
    total = sum(grams.values())
    again = sum(c for c in grams.values() if c > 1) / total if total else 0.0
    inside = [min(1.0, sum(w in listed for w in words) / size) for listed in (stopwords, flagged)]
    return size, again, *inside, abs(_entropy(np.array(list(Counter(words).values()))))


def word_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stopwords: tuple[str, ...] = STOPWORDS["en"], flagged: tuple[str, ...] = FLAGGED["en"], n: int = 5) -> DataFrame:
    """(doc_id, number_of_words, word_repetition_ratio, stopword_ratio, flagged_word_ratio, word_entropy); a null text is empty."""
    names = ["word_repetition_ratio", "stopword_ratio", "flagged_word_ratio", "word_entropy"]
    stop, bad = frozenset(stopwords), frozenset(flagged)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_word_features(w.as_py() or [], stop, bad, n) for w in b.column(1)]
            cols = [pa.array([r[k] for r in rows], pa.int64() if k == 0 else pa.float64()) for k in range(5)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["doc_id", "number_of_words", *names])

    rows = docs.select(F.col(id_col).alias("doc_id"), T.words_of_document(F.col(text_col)).alias("w"))
    out = rows.mapInArrow(run, f"doc_id {rows.schema[0].dataType.simpleString()}, number_of_words long, {', '.join(c + ' double' for c in names)}")
    return out.select("doc_id", "number_of_words", *(F.round(c, 3).alias(c) for c in names))
