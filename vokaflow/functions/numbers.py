"""Numbers as Turkish words, on digit strings of any length, without a UDF.

Digits are cut into groups of twelve from the right; within a group the thousands have names of
their own, and each further group is counted in trillions.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import DIGIT, FENCES, LEFT, RIGHT, SPACE, bound, replace_matches

#: The words of numbers.
ONES = ("", "bir", "iki", "üç", "dört", "beş", "altı", "yedi", "sekiz", "dokuz")
TENS = ("", "on", "yirmi", "otuz", "kırk", "elli", "altmış", "yetmiş", "seksen", "doksan")
ZERO, MINUS, HUNDRED, THOUSAND, MILLION, BILLION, TRILLION, COMMA, PERCENT = "sıfır", "eksi", "yüz", "bin", "milyon", "milyar", "trilyon", "virgül", "yüzde"
#: The ordinal suffix after each last vowel.
ORDINAL = {"a": "ıncı", "ı": "ıncı", "e": "inci", "i": "inci", "o": "uncu", "u": "uncu", "ö": "üncü", "ü": "üncü"}



def _list(words: Sequence[str]) -> Column:
    """The words as one folded literal: an array of literals would swell every plan."""
    return F.split(F.lit("|".join(words)), r"\|")


def _below_thousand(n: Column) -> Column:
    """Words for 1 to 999."""
    hundreds = _list(["", HUNDRED, *(f"{w} {HUNDRED}" for w in ONES[2:])])
    place = lambda words, k: F.nullif(F.get(words, k.cast("int")), F.lit(""))
    return F.concat_ws(" ", place(hundreds, F.floor(n / 100)), place(_list(TENS), F.floor(n / 10) % 10), place(_list(ONES), n % 10))


_OTHER_DIGITS = "".join(c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd")
_AS_WESTERN = "".join(str(unicodedata.decimal(c)) for c in _OTHER_DIGITS)


def digits_to_words(digits: Column) -> Column:
    """Words for a non-empty string of digits of any script."""
    western = bound(digits, lambda d: F.when(d.rlike("[^0-9]"), F.translate(d, _OTHER_DIGITS, _AS_WESTERN)).otherwise(d))
    return bound(F.regexp_replace(western, "^0+", ""), _bare_to_words)


def _bare_to_words(bare: Column) -> Column:
    groups = F.ceil(F.length(bare) / 12).cast("int")
    padded = F.lpad(bare, groups * 12, F.lit("0"))

    def group(i: Column) -> Column:
        three = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.substring(padded, i * 12 + k * 3 + 1, F.lit(3)).cast("int"))
        return bound(three, lambda t: named(t, i))

    def named(three: Column, i: Column) -> Column:
        of = lambda k: _below_thousand(three[k])
        large = [F.when(three[k] > 0, F.concat(of(k), F.lit(" " + name))) for k, name in enumerate((BILLION, MILLION))]
        thousands = F.when(three[2] == 1, F.lit(THOUSAND)).when(three[2] > 1, F.concat(of(2), F.lit(" " + THOUSAND)))
        return F.concat_ws(" ", *large, thousands, F.when(three[3] > 0, of(3)), F.when(i < groups - 1, F.lit(TRILLION)))

    words = F.array_join(F.array_remove(F.transform(F.sequence(F.lit(0), groups - 1), group), ""), " ")
    return F.when(bare == "", F.lit(ZERO)).otherwise(words)


def number_words(n: Column | str) -> Column:
    """Words for a whole number, "eksi" before a negative one."""
    text = (F.col(n) if isinstance(n, str) else n).cast("string")
    return bound(text, lambda t: F.concat(F.when(t.startswith("-"), MINUS + " ").otherwise(""), digits_to_words(F.regexp_replace(t, "^-", ""))))


def ordinal_suffix(words: Column) -> Column:
    vowel = F.regexp_extract(words, "(?s).*([aıeioöuü])", 1)
    return bound(vowel, lambda x: reduce(lambda out, v: F.when(x == v, ORDINAL[v]).otherwise(out), ORDINAL, F.lit(ORDINAL["e"])))


def ordinal_words(n: Column | str) -> Column:
    return bound(number_words(n), lambda w: F.concat(w, ordinal_suffix(w)))


def _only_digits(c: Column) -> Column:
    return F.regexp_replace(c, rf"[^{DIGIT}]", "")


def _decimal(match: Column) -> Column:
    return F.concat(digits_to_words(_only_digits(F.split(match, ",")[0])), F.lit(f" {COMMA} "), digits_to_words(F.split(match, ",")[1]))


def _ordinal(match: Column) -> Column:
    return bound(digits_to_words(_only_digits(match)), lambda w: F.concat(w, ordinal_suffix(w)))


#: Special forms before general ones; a pass leaves no digits where it matched.
PASSES: tuple[tuple[str, Callable[[Column], Column]], ...] = (
    (rf"%{SPACE}*{DIGIT}+", lambda m: F.concat(F.lit(PERCENT + " "), digits_to_words(_only_digits(m)))),
    (rf"{LEFT}{DIGIT}{{1,3}}(?:\.{DIGIT}{{3}})+,{DIGIT}+{RIGHT}", _decimal),
    (rf"{LEFT}{DIGIT}{{1,3}}(?:\.{DIGIT}{{3}})+{RIGHT}", lambda m: digits_to_words(_only_digits(m))),
    (rf"{LEFT}{DIGIT}+,{DIGIT}+{RIGHT}", _decimal),
    (rf"{LEFT}{DIGIT}+\.(?=[ \t])", _ordinal),
    (rf"{LEFT}{DIGIT}+{RIGHT}", digits_to_words),
)


def normalize_numbers(c: Column | str) -> Column:
    """Numbers in running text as words. The two private fence characters leave the text first."""
    clean = F.translate(F.col(c) if isinstance(c, str) else c, FENCES, "")
    return bound(clean, lambda t: F.when(t.rlike(DIGIT), reduce(lambda x, p: replace_matches(x, *p), PASSES, t)).otherwise(t))
