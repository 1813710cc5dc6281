"""Line-first quality cleaning.

Every line of a text is judged by itself: by punctuation and symbols, as
navigation, as boilerplate, as shouting, as repetition. Lines that fail are
removed, and a document that loses too many of its words with them is
rejected. Beside that a document is rejected outright if it has too few words
or is made up of repeated passages (the base rules).

Defined cases: a null or empty text has no words, fails the base rules and is
not kept. Of lines that tie, being equal, the first stays. An empty table gives no
rows; other columns are not read, or kept as they are by cleaned(). A line without words is never a failure, it is simply not counted. Repeated
rows are judged each by itself; a null id is carried along. The work is done
slice by slice, so memory depends on the longest text, which is judged whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm.common import Texts, codes, released, slices, table, utf8

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
CONTINUATION = bytes(range(0x80, 0xC0))
#: Marks that a sentence has, in several scripts.
MARKS = re.compile(r"[.,;:!?…。，、；：！？।؟،؛]")
#: What a sentence ends with, before closing quotes and brackets.
ENDS = re.compile(r"[.!?…:;。！？：；।؟؛][\"'”’»)\]]*$")
SEPARATORS = re.compile(r"\s[|»›·•→/]\s|\s>\s")
#: Entries of menus.
NAVIGATION = frozenset(
    "home about contact menu search login logout register help faq blog news next previous prev back more top share print"
    " subscribe sitemap shop cart account archive categories tags index"
    " startseite impressum kontakt datenschutz anmelden suche hilfe warenkorb accueil recherche connexion aide panier contactez"
    " inicio contacto buscar acceso ayuda carrito".split()
)
#: Phrases of lines that are not the author's text.
BOILERPLATE = re.compile(
    r"all rights reserved|cookie policy|privacy policy|terms of (?:use|service)|lorem ipsum|enable javascript|subscribe to our"
    r"|click here|read more|sign up (?:for|to)|powered by|copyright \(c\)|©|skip to content"
    r"|alle rechte vorbehalten|datenschutzerklärung|tous droits réservés|politique de confidentialité|todos los derechos reservados|política de privacidad",
    re.I,
)


#: Letters of scripts that are written without spaces, of which a word may be a whole sentence.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff]")


@dataclass(frozen=True)
class Rules:
    """Bounds of the base rules and of the line rules."""

    min_words: int = 10
    window: int = 5
    max_repeat_percent: int = 20
    max_symbols_per_word: float = 0.3
    short_line: int = 3
    unspaced_letters: int = 10
    boilerplate_words: int = 25
    shout_words: int = 3
    repeat_words: int = 10
    min_distinct: float = 0.3
    min_kept_words: float = 0.5


def line_fails(line: str, rules: Rules = Rules()) -> str | None:
    """The name of the first rule that the line fails, or None. The line must have a word."""
    words = line.split()
    n = len(words)
    cuts = len(SEPARATORS.findall(line))
    if cuts >= 2 and cuts * 4 >= n:
        return "navigation"
    if sum(map(line.count, "#*$%&|<>")) > rules.max_symbols_per_word * n:
        return "symbols"
    if n >= rules.shout_words and line.isupper():
        return "shouting"
    ends = ENDS.search(line.rstrip())
    if not ends:
        if n <= rules.short_line and len(UNSPACED.findall(line)) < rules.unspaced_letters or all(w.lower().strip("/|>»›·•→") in NAVIGATION or len(w) == 1 for w in words):
            return "navigation"
        if not MARKS.search(line) and len(UNSPACED.findall(line)) < rules.unspaced_letters:
            return "punctuation"
    if n <= rules.boilerplate_words and BOILERPLATE.search(line):
        return "boilerplate"
    if n >= rules.repeat_words and len(set(words)) < rules.min_distinct * n:
        return "repetition"
    return None


def repeat_words(word_codes: np.ndarray, doc: np.ndarray, n_docs: int, window: int) -> np.ndarray:
    """For each document: its words in windows that it holds twice or more.

    word_codes numbers the words of all documents, one after another; doc says whose each is.
    """
    n = len(word_codes) - window + 1
    if n <= 0:
        return np.zeros(n_docs, np.int64)
    # number the windows exactly: pairs of numbers are renumbered until they span a window
    span, number = 1, word_codes.astype(np.int64)
    while span < window:
        step = min(span, window - span)
        left, right = number[:-step], number[step:]
        number = np.unique(left * (int(number.max()) + 1) + right, return_inverse=True)[1]
        span += step
    whole = doc[:n] == doc[window - 1 :]
    at = np.flatnonzero(whole)
    key = number[at] * n_docs + doc[at]
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    again = at[count[inverse] > 1]
    edge = np.zeros(len(word_codes) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + window, -1)
    covered = np.cumsum(edge[:-1]) > 0
    return np.bincount(doc[covered], minlength=n_docs)


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


def clean(text: bytes, rules: Rules = Rules()) -> tuple[str, int]:
    """The text without the lines that fail or repeat an earlier line, and the number of its words."""
    kept, seen, n_words = [], set(), 0
    for line in text.decode("utf-8", "replace").split("\n"):
        n = len(line.encode().split())
        if n:
            if line in seen or line_fails(line, rules):
                continue
            seen.add(line)
            n_words += n
        kept.append(line)
    return "\n".join(kept), n_words


def measure(texts: Texts | list[bytes], rules: Rules = Rules(), with_text: bool = False) -> dict[str, np.ndarray | list]:
    """All columns of the verdict for a list of texts."""
    n = len(texts)
    out = {k: np.zeros(n, np.int64) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_clean_words")}
    cleaned: list[str | None] = [None] * n
    for a, b in slices(texts):
        own = texts[a:b]
        split = [t.split() for t in own]
        sizes = np.array([len(w) for w in split], np.int64)
        number, _ = codes([w for ws in split for w in ws])
        out["n_words"][a:b] = sizes
        out["n_repeat_words"][a:b] = repeat_words(number, np.repeat(np.arange(b - a), sizes), b - a, rules.window)
        for i, t in enumerate(own, a):
            out["word_chars"][i] = len(t.translate(None, SPACES + CONTINUATION))
            out["n_symbols"][i] = len(t) - len(t.translate(None, SYMBOLS))
            out["n_dup_lines"][i] = _dup_lines(t)
            text, out["n_clean_words"][i] = clean(t, rules)
            if with_text:
                cleaned[i] = text
    words = out["n_words"]
    out["base_failed"] = (words < rules.min_words) | (100 * out["n_repeat_words"] > rules.max_repeat_percent * words)
    out["kept"] = ~out["base_failed"] & (out["n_clean_words"] >= rules.min_kept_words * words)
    out["text"] = cleaned
    return out


COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_clean_words long"


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules()) -> DataFrame:
    """One row per document: the measures, base_failed, kept and the number of words that cleaning leaves."""
    names = [c.split()[0] for c in COUNTS.split(", ")] + ["base_failed", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = measure(utf8(b.column(1)), rules)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(m[k]) for k in names)], ["doc_id", *names])

    ids = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = ids.schema[0].dataType.simpleString()
    return ids.mapInArrow(released(run), f"doc_id {kind}, {COUNTS}, base_failed boolean, kept boolean")


def cleaned(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", rules: Rules = Rules()) -> DataFrame:
    """The documents that are kept, with their cleaned texts, in the columns of docs.

    chars_col, where docs has it, is set to the code points of the cleaned text.
    """
    columns = docs.columns
    at = columns.index(text_col)
    chars = columns.index(chars_col) if chars_col in columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i, j in slices(utf8(whole.column(at))):
                b = whole.slice(i, j - i)
                m = measure(utf8(b.column(at)), rules, with_text=True)
                arrays = list(b.columns)
                arrays[at] = pa.array(m["text"], pa.string()).cast(b.schema.field(at).type)
                if chars is not None:
                    n = [None if t is None else len(t) for t in m["text"]]
                    arrays[chars] = pa.array(n, pa.int64()).cast(b.schema.field(chars).type)
                yield pa.RecordBatch.from_arrays(arrays, schema=b.schema).filter(pa.array(m["kept"]))

    return docs.mapInArrow(released(run), docs.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"))
