"""Unicode normal form and the repair of texts that were decoded wrongly."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_BROKEN = re.compile(r"[ÂÃâÅÄð][\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ¡-¿]")
_RUN = re.compile(r"[\x80-\xff€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]+")
_TERMINAL = re.compile(r"\x1b\[[0-9;]*[A-Za-z]")
_CONTROL = re.compile("[\x00-\x08\x0b\x0e-\x1f\x7f﻿￹-￻]")
_LINES = re.compile("\r\n|\r| | |\x85")
#: Quotes and ligatures, and what they become.
_PLAIN = str.maketrans({"‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"', "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"})


def _read_again(m: re.Match) -> str:
    """A run of UTF-8 bytes that were read as single-byte characters; what doesn't decode is left as it is."""
    for name in ("cp1252", "latin-1"):
        try:
            return m[0].encode(name).decode("utf-8")
        except UnicodeError:
            continue
    return m[0]


def _decoded(text: str) -> str:
    for _ in range(3):
        again = _RUN.sub(_read_again, text) if _BROKEN.search(text) else text
        if again == text:
            break
        text = again
    return text


def _wide(c: str) -> str:
    return unicodedata.normalize("NFKC", c) if "！" <= c <= "～" else c


def fix_text(text: str) -> str:
    """Entities, mojibake, quotes, ligatures, full-width letters, line breaks and control characters; then NFC."""
    if "<" not in text:
        text = html.unescape(text)
    text = _decoded(_TERMINAL.sub("", text)).translate(_PLAIN)
    text = "".join(map(_wide, text)) if re.search("[！-～]", text) else text
    text = _CONTROL.sub("", _LINES.sub("\n", text))
    return unicodedata.normalize("NFC", text)


@F.pandas_udf(StringType())
def _fixed(s: pd.Series) -> pd.Series:
    return s.map(fix_text, na_action="ignore")


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore")


#: What fix_text may change: a text without it goes past Python.
_SUSPECT = "[^\\x09\\x0a\\x20-\\x25\\x27-\\x7e]|&[#A-Za-z]"


def fixed(text: Column) -> Column:
    return F.when(F.regexp_like(text, F.lit(_SUSPECT)), _fixed(F.when(F.regexp_like(text, F.lit(_SUSPECT)), text))).otherwise(text)


def nfc(text: Column) -> Column:
    """ASCII is in normal form; only other texts go to Python."""
    other = F.octet_length(text) != F.length(text)
    return F.when(other, _nfc(F.when(other, text))).otherwise(text)
