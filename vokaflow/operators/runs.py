"""Runs of a flag along an order: gaps and islands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def run_lengths(rows: DataFrame, key: str, order: Sequence[str], flag: str) -> DataFrame:
    """(key, n): the length of each unbroken run of rows with the flag set."""
    every = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    flagged = rows.select(key, *order, flag).withColumn("_at", every).filter(flag)
    island = F.col("_at") - F.row_number().over(Window.partitionBy(key).orderBy("_at"))
    return flagged.withColumn("_island", island).groupBy(key, "_island").agg(F.count(F.lit(1)).alias("n")).drop("_island")
