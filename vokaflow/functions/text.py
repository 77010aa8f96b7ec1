"""Text normalization as Column expressions.

Java's ``\\w``, ``\\b``, ``\\d`` and ``\\s`` differ from the wanted classes (combining marks, superscripts,
control separators), so the classes are spelled out here and used everywhere.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

WORD = r"[\p{L}\p{N}_]"
DIGIT = r"\p{Nd}"
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
SOLID = r"[^\s\x1c-\x1f\x85\p{Z}]"
#: Java looks behind by code units unless the pattern itself holds a character above U+FFFF, so LEFT has one, a letter like others.
LEFT, RIGHT = rf"(?<![{WORD}𐐀])", rf"(?!{WORD})"

#: Two private characters that stand around a match while it is replaced.
FENCES = ""
#: Abbreviations and what they are read as.
ABBREVIATIONS = {
    "Dr.": "doktor", "Prof.": "profesör", "Doç.": "doçent", "Sn.": "sayın", "No.": "numara", "vs.": "vesaire", "vb.": "ve benzeri", "vd.": "ve diğerleri",
    "bkz.": "bakınız", "Bkz.": "bakınız", "TL": "Türk lirası", "USD": "dolar", "EUR": "avro", "kHz": "kilohertz", "MHz": "megahertz", "GHz": "gigahertz",
    "km": "kilometre", "cm": "santimetre", "mm": "milimetre", "kg": "kilogram", "Hz": "hertz", "MB": "megabayt", "GB": "gigabayt", "TB": "terabayt",
    "ml": "mililitre", "lt": "litre", "m": "metre", "g": "gram",
}
#: Typographic quotes and dashes, and their plain forms; brackets become spaces.
PLAIN_FROM, PLAIN_TO = "“”‘’«»„—–()[]", "\"\"''\"\"\",,    "


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, function: Callable[[Column], Column]) -> Column:
    """function(value) with value evaluated once, however often function uses it."""
    return F.get(F.transform(F.array(value), function), 0)


def strip(c: Column | str) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(_col(c), rf"^{SPACE}+|{SPACE}+$", "")


def is_blank(c: Column | str) -> Column:
    return F.coalesce(~_col(c).rlike(SOLID), F.lit(True))


def strip_html(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "<[^>]+>", " ")


def strip_urls(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), rf"https?://{SOLID}+|www\.{SOLID}+", " ")


def strip_emails(c: Column | str) -> Column:
    """The pattern backtracks on long unbroken words, so only texts with an @ meet it."""
    pattern = rf"{SOLID}+@{SOLID}+\.[a-zA-Z]{{2,}}"
    return bound(_col(c), lambda t: F.when(F.contains(t, F.lit("@")), F.regexp_replace(t, pattern, " ")).otherwise(t))


def strip_mentions(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), f"@{WORD}+", " ")


def strip_hashtags(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), f"#{WORD}+", " ")


def strip_markup(c: Column | str) -> Column:
    """Tags, URLs, e-mail addresses, mentions and hashtags, in this order, each to a space."""
    return reduce(lambda x, f: f(x), (strip_html, strip_urls, strip_emails, strip_mentions, strip_hashtags), _col(c))


@F.pandas_udf(StringType())
def _composed(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None or unicodedata.is_normalized("NFC", t) else unicodedata.normalize("NFC", t))


#: Marked so that a filter on a text made from it is not pushed below it, which would make the text twice.
_composed_once = _composed.asNondeterministic()


def nfc(c: Column | str) -> Column:
    """Canonical composition; Spark has no such function, so this one is an Arrow UDF."""
    return _composed_once(_col(c))


def plain_punctuation(c: Column | str) -> Column:
    """Plain quotes, commas for dashes, no brackets, single spaces; for composed text."""
    return F.trim(F.regexp_replace(F.translate(_col(c), PLAIN_FROM, PLAIN_TO), f"{SPACE}+", " "))


def normalize_punctuation(c: Column | str) -> Column:
    return plain_punctuation(nfc(c))


def replace_matches(text: Column, pattern: str, function: Callable[[Column], Column]) -> Column:
    """Each match of the pattern replaced by function(match): matches are fenced by two private
    characters, split off, and every other piece is mapped."""
    fenced = F.regexp_replace(text, pattern, f"{FENCES[0]}$0{FENCES[1]}")
    pieces = F.transform(F.split(fenced, f"[{FENCES}]"), lambda x, i: F.when(i % 2 == 1, function(x)).otherwise(x))
    return F.array_join(pieces, "")


def _escaped(word: str) -> str:
    return word.replace(".", r"\.")


def normalize_abbreviations(c: Column | str) -> Column:
    """Longest first; one that ends in a period needs a boundary on its left only.

    All are found in one pass and looked up. That equals replacing them one after the other, as no reading holds an
    abbreviation as a word and all begin and end in letters, unless a period abbreviation is glued to a letter or
    number behind it; such rare texts, and those with the fences, go through them one by one.
    """
    order = sorted(ABBREVIATIONS, key=len, reverse=True)
    dotted, plain = ([a for a in order if a[-1].isalpha() == k] for k in (False, True))
    any_of = lambda words: "(?:" + "|".join(map(_escaped, words)) + ")"
    pattern = f"{LEFT}(?:{any_of(dotted)}|{any_of(plain)}{RIGHT})"
    glued = f"{any_of(dotted)}{WORD}|[{FENCES}]"
    names = F.create_map(*(F.lit(x) for kv in ABBREVIATIONS.items() for x in kv))
    at_once = lambda t: replace_matches(t, pattern, lambda m: names[m])
    each = lambda t: reduce(lambda x, a: F.regexp_replace(x, LEFT + _escaped(a) + (RIGHT if a[-1].isalpha() else ""), ABBREVIATIONS[a]), order, t)
    return bound(_col(c), lambda t: F.when(t.rlike(pattern), F.when(t.rlike(glued), each(t)).otherwise(at_once(t))).otherwise(t))


def word_count(c: Column | str) -> Column:
    return F.size(F.array_remove(F.split(_col(c), f"{SPACE}+"), ""))


def casefold(c: Column | str) -> Column:
    """Case folding as lower case plus the sharp s and the final sigma; ligatures keep their form."""
    return F.translate(F.replace(F.lower(_col(c)), F.lit("ß"), F.lit("ss")), "ς", "σ")


@F.pandas_udf(StringType())
def _folded(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t if t is None else t.casefold())


def casefold_exact(c: Column | str) -> Column:
    """Full Unicode case folding (an Arrow UDF)."""
    return _folded(_col(c))


def first_filled(*names: str) -> Column:
    """The first of the columns that is neither null nor empty, else empty."""
    return F.coalesce(*(F.nullif(F.col(n), F.lit("")) for n in names), F.lit(""))


def file_stem(c: Column | str) -> Column:
    """A path's last part without its last suffix; a leading dot starts no suffix."""
    name = F.regexp_extract(F.regexp_replace(_col(c), "/+$", ""), r"([^/]*)$", 1)
    return F.regexp_replace(name, r"(?<=[^.])\.[^.]+$", "")
