"""What the training-data operators share: word patterns, row keys, written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these ASCII blanks (Java regular expressions).
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column) -> Column:
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order; empty for a null or blank text."""
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names for checkpoints. Only a local session that names none gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _local_folder()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="vokaflow-")


def whole_row(df: DataFrame) -> Column:
    """All columns of df as one struct, so that an operator's own columns can't meet names of the input."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns))


#: The folders that written() has made since the last scratch() began.
_paths: list[str] = []
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Texts that go to a Python worker at once: a few megabytes, so neither side holds much off the heap.
TEXTS_PER_BATCH = 500


def written(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """The rows of df from a Parquet table in the shared folder: lineage ends there, so a lost
    executor costs a re-read and nothing upstream runs twice. batch: rows per Arrow batch meanwhile."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/vokaflow/{name}-{uuid.uuid4().hex}"
    _paths.append(path)
    before = spark.conf.get(_BATCH)
    if batch:
        spark.conf.set(_BATCH, batch)
    try:
        df.write.parquet(path)
    finally:
        if batch:
            spark.conf.set(_BATCH, before)
    # The schema is given: an empty table is read like any other.
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def dropped(*tables: DataFrame) -> None:
    """Deletes the folders of written() tables that a later step has replaced."""
    for df in tables:
        for file in df.inputFiles()[:1]:
            _delete(df.sparkSession, file.rsplit("/", 1)[0])


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], None]]:
    """Deletes at its end what written() wrote within, but for the tables given to the function that it yields."""
    outer, kept = list(_paths), set()
    _paths.clear()
    try:
        yield lambda df: kept.update(file.rsplit("/", 1)[0].rsplit("/", 1)[-1] for file in df.inputFiles()[:1])
    finally:
        for path in _paths:
            if path.rsplit("/", 1)[-1] in kept:
                outer.append(path)
            else:
                _delete(spark, path)
        _paths[:] = outer


#: A key with more than one HEAVY-th of all rows is joined by broadcast; there are fewer than HEAVY of them.
HEAVY = 1000


def spread_join(left: DataFrame, right: DataFrame, key: str, total: int) -> DataFrame:
    """left joined to the rows of right that are wanted, such that no key's rows gather in one task.

    right has one row per key: at least every key of left with more than total / HEAVY rows, with
    its number of rows n, and whether it is wanted. Of total rows fewer than HEAVY keys can have so many, so
    these are broadcast, whatever the input's size; their rows stay out of the shuffle.
    """
    heavy = right.filter(F.col("n") * HEAVY > total)
    light = right.filter((F.col("n") * HEAVY <= total) & F.col("wanted")).drop("n", "wanted")
    hot = left.join(F.broadcast(heavy.filter("wanted").drop("n", "wanted")), key)
    return hot.unionByName(left.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
