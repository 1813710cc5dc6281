"""Text functions from Column to Column. Null stays null."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusmill.functions.lexicons import PUNCTUATION, PUNCTUATION_MAP, SPACE_CLASS, WIDE_SPACES


def clean(text: Column) -> Column:
    """Lower case, no ASCII punctuation, single spaces, none at the ends."""
    bare = F.translate(F.lower(text), PUNCTUATION, "")
    return F.trim(F.regexp_replace(bare, f"{SPACE_CLASS}+", " "))


def words(text: Column) -> Column:
    """Split at any white space; no empty words."""
    return F.filter(F.split(text, f"{SPACE_CLASS}+"), lambda w: w != "")


def tokens(text: Column, max_len: int | None = None) -> Column:
    """Of the cleaned text: runs of ASCII letters and digits, and every other character that isn't blank by itself; all, or the first max_len."""
    found = F.filter(F.regexp_extract_all(clean(text), F.lit("([A-Za-z0-9]+|[^A-Za-z0-9])"), F.lit(1)), lambda t: F.trim(t) != "")
    return found if max_len is None else F.slice(found, 1, max_len)


def ngrams(items: Column, n: int, least: int | None = None) -> Column:
    """All runs of n items, as arrays; none where there are fewer than n or `least`."""
    size = F.size(items)
    runs = F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: F.slice(items, i, F.lit(n)))
    return F.when(size >= max(n, least or n), runs).otherwise(F.array().cast("array<array<string>>"))


def characters(text: Column) -> Column:
    """The cleaned text's characters, spaces too: the items of shingles in scripts without spaces."""
    return F.filter(F.split(clean(text), ""), lambda c: c != "")


def adaptive_shingles(items: Column, width: int, joiner: str = " ") -> Column:
    """Runs of `width` items, or of all where there are fewer, joined."""
    w = F.least(F.size(items), F.lit(width))
    runs = F.transform(F.sequence(F.lit(1), F.size(items) - w + 1), lambda i: F.array_join(F.slice(items, i, w), joiner))
    return F.when(F.size(items) > 0, runs).otherwise(F.array().cast("array<string>"))


def split_on_space(text: Column, new_line: bool = False, tab: bool = False) -> Column:
    marks = " " + "\n" * new_line + "\t" * tab
    return F.filter(F.split(text, f"[{marks}]+"), lambda w: w != "")


def strip(text: Column, characters: str) -> Column:
    """Without the members of characters at both ends."""
    cls = "[" + "".join("\\" + c if not c.isalnum() and not c.isspace() and ord(c) < 128 else c for c in characters) + "]+"
    return F.regexp_replace(text, f"^{cls}|{cls}$", "")


def non_printing_removed(text: Column) -> Column:
    """Control characters go, line breaks and tabs with them."""
    return F.regexp_replace(text, "[\\x00-\\x1f\\x7f-\\x9f]", "")


def uniform_space(text: Column) -> Column:
    return F.translate(text, WIDE_SPACES, " " * len(WIDE_SPACES))


def digits_zeroed(text: Column) -> Column:
    return F.regexp_replace(text, "\\p{Nd}", "0")


def plain_punctuation(text: Column) -> Column:
    one = {a: b for a, b in PUNCTUATION_MAP.items() if len(b) == 1}
    out = F.translate(text, "".join(one), "".join(one.values()))
    for a, b in PUNCTUATION_MAP.items():
        if len(b) > 1:
            out = F.replace(out, F.lit(a), F.lit(b))
    return out


def normalized(text: Column, non_printing: bool = True, stripped: bool = True, lower: bool = True, space: bool = True, digits: bool = True, punctuation: bool = True) -> Column:
    """The normalisations in their fixed order."""
    out = non_printing_removed(text) if non_printing else text
    if stripped:
        out = F.regexp_replace(out, f"^{SPACE_CLASS}+|{SPACE_CLASS}+$", "")
    for wanted, step in ((lower, F.lower), (space, uniform_space), (digits, digits_zeroed), (punctuation, plain_punctuation)):
        out = step(out) if wanted else out
    return out


def words_of_document(text: Column, lower: bool = True, strip_characters: str = PUNCTUATION) -> Column:
    """Words cut at spaces, line breaks and tabs, without the given characters at their ends."""
    found = split_on_space(F.lower(text) if lower else text, True, True)
    return F.filter(F.transform(found, lambda w: strip(w, strip_characters)), lambda w: w != "")


def nested_words(text: Column) -> Column:
    """Lines of tab-separated fields of words; blank ones are left out."""
    fields = lambda line: F.filter(F.transform(F.split(line, "\t"), lambda f: F.filter(F.split(f, " "), lambda w: w != "")), lambda f: F.size(f) > 0)
    return F.filter(F.transform(F.split(text, "\n"), fields), lambda line: F.size(line) > 0)


def joined_words(nested: Column) -> Column:
    return F.array_join(F.transform(nested, lambda line: F.array_join(F.transform(line, lambda f: F.array_join(f, " ")), "\t")), "\n")


def _each_word(text: Column, keep) -> Column:
    kept = F.transform(nested_words(text), lambda line: F.filter(F.transform(line, lambda f: F.filter(f, keep)), lambda f: F.size(f) > 0))
    return joined_words(F.filter(kept, lambda line: F.size(line) > 0))


def without_incorrect(text: Column, substrings: tuple[str, ...], strip_characters: str = PUNCTUATION) -> Column:
    """Without words that hold one of the substrings once stripped."""

    def right(w: Column) -> Column:
        bare, found = strip(w, strip_characters), F.lit(False)
        for s in substrings:
            found = found | F.contains(bare, F.lit(s))
        return ~found

    return _each_word(text, right)


def without_long(text: Column, most: int, strip_characters: str = PUNCTUATION) -> Column:
    """Without words longer than `most`, unless they are not once stripped."""

    def short(w: Column) -> Column:
        bare = F.length(strip(w, strip_characters))
        return (F.length(w) <= most) | ((bare > 0) & (bare <= most))

    return _each_word(text, short)


def modified(text: Column, substrings: tuple[str, ...] = ("http", "www", ".com", "href", "//"), longest: int = 25) -> Column:
    """Plain white space, without incorrect and long words."""
    return without_long(without_incorrect(uniform_space(text), substrings), longest)


def sha1_hash32(text: Column) -> Column:
    """The first four SHA-1 bytes as a little-endian number."""
    h = F.sha1(text.cast("binary"))
    turned = F.concat(*(F.substring(h, k, 2) for k in (7, 5, 3, 1)))
    return F.conv(turned, 16, 10).cast("long")


def without_prefix(label: Column, prefix: str = "__label__") -> Column:
    """A classifier's label without the prefix that its format has."""
    return F.regexp_replace(label, "^" + re.escape(prefix), "")


def pieces(text: Column, tokenize: Callable[[list[str]], list[list[str]]]) -> Column:
    """The tokens of an external tokenizer, such as a sentence-piece model: tokenize takes many texts at once, as Arrow batches bring them."""

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(tokenize(s.fillna("").tolist()), dtype=object)

    return run(text)


def stripped_lines(text: Column) -> Column:
    """Non-blank lines without white space at their ends."""
    ends = f"^{SPACE_CLASS}+|{SPACE_CLASS}+$"
    return F.filter(F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, ends, "")), lambda x: x != "")


def snippets(text: Column, chars: int = 100) -> Column:
    """Three samples, from a twentieth, a half and nineteen twentieths on."""
    n = F.length(text)
    at = [F.floor(n / 20), F.floor(n / 2), F.floor(n * 19 / 20)]
    return F.struct(*(F.substring(text, (p + 1).cast("int"), F.lit(chars)).alias(name) for p, name in zip(at, ("start", "middle", "end"))))
