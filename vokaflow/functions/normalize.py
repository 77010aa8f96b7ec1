"""The whole normalization of a text."""

from __future__ import annotations

from pyspark.sql import Column

from .numbers import normalize_numbers
from .text import nfc, normalize_abbreviations, plain_punctuation, strip_markup


def normalize_dates(c: Column) -> Column:
    """Dates are left as they are; their digits are read by the number rules."""
    return c


def normalize_composed(c: Column | str) -> Column:
    """normalize_text for text whose markup is gone and which is in composed form; no UDF."""
    return normalize_numbers(normalize_dates(normalize_abbreviations(plain_punctuation(c))))


def normalize_text(c: Column | str) -> Column:
    """Markup, composition, punctuation, abbreviations, dates, numbers, in this order."""
    return normalize_composed(nfc(strip_markup(c)))
