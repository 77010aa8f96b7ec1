"""Mixing sources to target weights by balanced sampling (the cube method).

A source's target over its size is how often each of its documents is taken on average: the whole
part for certain, the fraction as an inclusion probability. The flight phase moves the
probabilities of three documents at a time along the null space of the constraints (documents
taken, words taken) until one of them is 0 or 1, so both totals hold exactly all the way. It
runs in chunks of a source; each leaves two open probabilities at most, which meet in the next,
smaller round. One chunk per source is left in the end and lands its last two documents.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, text_or_empty, union_all, written

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
CHUNK, LEFT = 256, 2
_EPS = 1e-9


def source_targets(sized: DataFrame, *, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, n, source_size, rank, target) for rows of (source, size), as a written table.

    Sources by code point, null last, take the weights in turn. Together they share ``share`` of
    all sizes; a target stops at ``most`` times its source's size and the excess goes to the
    others by weight until none is above. An empty source has target 0.
    """
    spark = sized.sparkSession
    totals = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    # Range partitions are in order, so a row's place is known from the sizes of the ones before.
    sorted_ = written(totals.orderBy(F.col("source").asc_nulls_last()).withColumn("_at", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("_at", 33)
    sizes = sorted(sorted_.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())  # a row per partition
    before, rows = 0, []
    for p, n in sizes:
        rows.append((p, before))
        before += n
    starts = spark.createDataFrame(rows, "_p long, _before long")
    ranked = sorted_.join(F.broadcast(starts), part == F.col("_p")).withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = written(ranked.select("source", "n", "source_size", "rank", weight.alias("weight"), (F.col("source_size") * most).alias("cap")), "ranked")
    level: float | None = None  # what a weight of 1 gets
    while True:
        full = F.lit(False) if level is None else F.col("cap") < F.col("weight") * level
        size, capped, free = ranked.agg(F.sum("source_size"), F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        new = (share * (size or 0) - (capped or 0.0)) / free if free else level or 0.0
        if level is not None and new <= level:
            break
        level = new
    return ranked.withColumn("target", F.least("cap", F.col("weight") * level)).drop("weight", "cap")


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator, landing: bool) -> np.ndarray:
    """The probabilities after the flight phase, and after the landing if asked for."""
    out, p, size = p.copy(), p.tolist(), size.tolist()
    draws = iter(rng.random(len(p) + 4).tolist())
    window: list[int] = []
    following = 0

    def move(at: list[int], u: list[float]) -> None:
        up = min((1 - p[i]) / d if d > 0 else p[i] / -d for i, d in zip(at, u, strict=True) if d)
        down = min(p[i] / d if d > 0 else (1 - p[i]) / -d for i, d in zip(at, u, strict=True) if d)
        step = up if next(draws) * (up + down) < down else -down
        for i, d in zip(at, u, strict=True):
            p[i] += step * d

    def settle() -> None:
        for i in window[:]:
            if p[i] < _EPS or p[i] > 1 - _EPS:
                p[i] = float(p[i] > 0.5)
                window.remove(i)

    while True:
        while len(window) < 3 and following < len(p):
            window.append(following)
            following += 1
            settle()
        if len(window) < 3:
            break
        a, b, c = (size[i] for i in window)
        move(window, [b - c, c - a, a - b] if not a == b == c else [1.0, -1.0, 0.0])
        settle()
    while landing and window:  # the document count is given up first, then the words
        if len(window) == 2:
            a, b = (size[i] for i in window)
            move(window, [b, -a] if a or b else [1.0, -1.0])
        else:
            p[window[0]] = float(next(draws) < p[window[0]])
        settle()
    out[:] = p
    return out


def _balanced(seed: int, level: int, landing: bool):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["size", "h", "rid"], ascending=[False, True, True], kind="stable")
        rng = np.random.Generator(np.random.Philox([seed, level, *(int(k) for k in key)]))
        rows["p"] = flight(rows["p"].to_numpy(), rows["size"].to_numpy(np.float64), rng, landing)
        return rows

    return run


def mix_sources(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 17, size: Column | None = None) -> DataFrame:
    """One row per document: the id, source and text_hash, size, source_size, target (its source's), copies, taken.

    size counts words (null text: 0). copies is a whole number whose mean is target / source_size;
    taken = copies * size. The same rows give the same copies however they are partitioned. Null
    sources are one source, the last. Repeated rows are documents of their own. Texts of any length are counted whole;
    other columns, whatever their names, are not read; no rows give no rows.
    """
    text = text_or_empty(text_column)
    counted = size if size is not None else F.regexp_count(text, F.lit(WORD)).cast("long")
    sized = docs.select(F.col(id_column).alias("id"), F.col(source_column).alias("source"), F.unhex(F.md5(text.cast("binary"))).alias("th"), counted.alias("size"))
    # Repeated rows are told apart by their number, so they spread over chunks in the same way in every run.
    numbered = sized.groupBy("id", "source", "th", "size").agg(F.count(F.lit(1)).alias("m")).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    sized = written(numbered.drop("m").withColumn("rid", F.monotonically_increasing_id()), "sized")
    targets = source_targets(sized, weights=weights, share=share, most=most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = sized.withColumnRenamed("source", "_s").join(targets, F.col("_s").eqNullSafe(F.col("source"))).drop("_s")
    sure = F.floor(rate + _EPS)
    state = joined.withColumn("sure", sure).withColumn("p", F.greatest(rate - sure, F.lit(0.0)))
    state = written(state.withColumn("p", F.when(F.col("p") < _EPS, 0.0).otherwise(F.col("p"))).withColumn("h", F.xxhash64("id", "th", "nth")), "state")
    open_ = state.filter("p > 0").select("rank", "rid", "h", "size", "p", F.ceil(F.col("n") / CHUNK).alias("m"), F.pmod("h", F.ceil(F.col("n") / CHUNK)).alias("chunk"))
    largest = targets.agg(F.max(F.ceil(F.col("n") / CHUNK))).first()[0] or 1
    done, level = [], 0
    while True:
        moved = open_.groupBy("rank", "chunk").applyInPandas(_balanced(seed, level, largest <= 1), "rank long, rid long, h long, size long, p double, m long, chunk long")
        moved = written(moved, "flight")
        done.append(moved.filter("p = 0 or p = 1").select("rid", F.col("p").cast("long").alias("extra")))
        if largest <= 1:
            break
        group = CHUNK // LEFT
        open_ = moved.filter("p > 0 and p < 1").withColumns({"m": F.ceil(F.col("m") / group), "chunk": F.floor(F.col("chunk") / group)})
        largest, level = -(-largest // group), level + 1
    chosen = state.join(union_all(done), "rid", "left").withColumn("copies", F.col("sure").cast("long") + F.coalesce("extra", F.lit(0)))
    return chosen.select(F.col("id").alias(id_column), F.col("source").alias(source_column), F.lower(F.hex("th")).alias("text_hash"), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
