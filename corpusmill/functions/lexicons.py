"""Word and character lists, languages, and a loader for lists of the user's own."""

from __future__ import annotations

import json
import string
import sys
from functools import lru_cache

import regex
from pyspark.sql import SparkSession

PUNCTUATION = string.punctuation

#: White space as str.split() knows it, as a character class.
SPACE_CLASS = "[\t-\r\x1c- \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

#: Characters that become a plain space.
WIDE_SPACES = "\u2009\u200a\u202f\u2005\u3000\u2002\u2008\u2003￼\u0084"

#: Punctuation of other scripts and what it becomes.
PUNCTUATION_MAP = {
    "，": ",", "。": ".", "、": ",", "„": '"', "”": '"', "“": '"', "«": '"', "»": '"', "１": '"', "」": '"', "「": '"', "《": '"', "》": '"',
    "´": "'", "∶": ":", "：": ":", "？": "?", "！": "!", "（": "(", "）": ")", "；": ";", "–": "-", "—": " - ", "．": ". ", "～": "~", "’": "'",
    "…": "...", "━": "-", "〈": "<", "〉": ">", "【": "[", "】": "]", "％": "%", "►": "-",
}

#: Characters that count as special beside ASCII punctuation, digits, white space and emoji.
OTHER_SPECIAL = (
    "\u0092\u2009\u0093\u0097\u200a\u009d\u0099\u202f\u0096\u2005\u0095\u0091\u009c\u3000\u2002 \u2008\u0098\u0081\u2003\u0082￼\u0083\u0084’“”–ー一▬…✦�\u00ad£\u200b•€«»°·═×士＾˘⇓↓↑←→（）§″′´¿−±∈\ufeff"
    "¢ø‚„½¼¾¹²³―⁃，ˌ¸‹›ʺˈʻ¦‐⠀‰\u0085\u0085‑≤≥‖◆●■►▼▲▴∆▻¡★☆✱ːº。¯˜¥ɪ≈†上ン：∼⁄・♡✓⊕․．⋅"
    "÷１‟；،、¨ाাी्े◦˚゜ʼ≖ʼ¤ッツシ℃√！【】‿∞➤～πه۩☛₨➩☻๑٪♥ıॽ《‘©﴿٬？▷Г♫∟™ª₪®「—❖」﴾》"
)


@lru_cache(maxsize=1)
def special_characters() -> frozenset[str]:
    """The listed characters and those with Unicode's property of an emoji."""
    known = "".join(chr(c) for c in range(0x80, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    return frozenset([*PUNCTUATION, *string.digits, *string.whitespace, *OTHER_SPECIAL, *regex.findall(r"\p{Emoji}", known)])


#: The commonest words of the languages that the default line scorer knows.
STOPWORDS: dict[str, tuple[str, ...]] = {
    "de": tuple("der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split()),
    "en": tuple("the of and to in a is that it was for on are as with his they at be this from have or by one had not but what all were".split()),
    "es": tuple("de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre".split()),
    "fr": tuple("de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son aux".split()),
}
FLAGGED: dict[str, tuple[str, ...]] = {"en": tuple("stupid moron pathetic trash loser disgusting worthless clown idiot".split())}

#: The languages that are known by code, with their names.
LANGUAGE_NAMES = {
    "af": "Afrikaans", "ar": "Arabic", "arz": "Egyptian Arabic", "as": "Assamese", "bn": "Bengali", "ca": "Catalan", "en": "English", "es": "Spanish",
    "eu": "Basque", "fr": "French", "gu": "Gujarati", "hi": "Hindi", "id": "Indonesian", "kn": "Kannada", "ml": "Malayalam", "mr": "Marathi",
    "pt": "Portuguese", "sw": "Swahili", "ta": "Tamil", "te": "Telugu", "ur": "Urdu", "vi": "Vietnamese", "yo": "Yoruba", "zh": "Chinese",
}
#: Those of them for which lists of stop words and of flagged words are in use.
WITH_STOPWORDS = tuple("af ar bn ca en es eu fr hi id mr pt sw ur vi yo zh".split())
WITH_FLAGGED = tuple("ar ca en es eu fr hi id kn ml mr pt ta te vi zh".split())


def word_lists(spark: SparkSession, path: str) -> dict[str, tuple[str, ...]]:
    """Word lists by language from a JSON file {language: [words]}, or a folder of text files language.txt with a word a line.

    Lists are bounded by what a person writes; they are read to the driver and become literals.
    """
    rows = spark.read.text(path, wholetext=True).selectExpr("_metadata.file_name AS name", "value").collect()
    out: dict[str, tuple[str, ...]] = {}
    for r in rows:
        if r.name.endswith(".json"):
            out |= {lang: tuple(words) for lang, words in json.loads(r.value).items()}
        else:
            out[r.name.rpartition(".")[0]] = tuple(w for w in map(str.strip, r.value.splitlines()) if w)
    return out


def words_for(lang: str, lists: dict[str, tuple[str, ...]] = STOPWORDS) -> tuple[str, ...] | None:
    """The list of a language, or None if there is none."""
    return lists.get(lang)
