"""Arithmetic on signal metrics: decibels, score curves, rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_db(v: Column) -> Column:
    """20 log10, -100 from zero down."""
    return F.when(v <= 0, -100.0).otherwise(20.0 * F.log10(v))


def clamp(v: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), v))


def score_range(v: Column, low: float, high: float, weight: float) -> Column:
    """weight within [low, high], falling in proportion on either side."""
    below = weight * clamp(v / max(low, 1e-6))
    above = weight * clamp(1.0 - (v - high) / max(high, 1e-6))
    return F.when((v >= low) & (v <= high), weight).when(v < low, below).otherwise(above)


def score_ceiling(v: Column, most: float, weight: float) -> Column:
    falling = weight * clamp(1.0 - (v - most) / most) if most > 0 else F.lit(0.0)
    return F.when(v <= most, weight).otherwise(falling)


def rate(amount: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, amount / seconds).otherwise(0.0)
