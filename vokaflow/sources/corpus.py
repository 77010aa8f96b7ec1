"""A corpus folder of WAV and TXT pairs as raw manifest rows."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from vokaflow.functions.text import file_stem

from .audio import duration

#: The folder names of each split, the first that exists counts.
SPLIT_FOLDERS = {"train": ("Train", "train"), "val": ("Dev", "dev", "Val", "val"), "test": ("Test", "test")}
SPEAKER = "unknown"


class _Files:
    """A folder listing by Hadoop's file system, so any store that Spark reads will do."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def is_folder(self, path: str) -> bool:
        p = self._path(path)
        fs = p.getFileSystem(self.conf)
        return fs.exists(p) and fs.getFileStatus(p).isDirectory()

    def folders(self, path: str) -> list[str]:
        p = self._path(path)
        return [s.getPath().toString() for s in p.getFileSystem(self.conf).listStatus(p) if s.isDirectory()]


def find_root(spark: SparkSession, folder: str) -> str | None:
    """The folder, or its first child by name, that holds a split folder."""
    files = _Files(spark)
    if not files.is_folder(folder):
        return None
    holds = lambda f: any(files.is_folder(f"{f}/{n}") for n in ("Train", "Dev", "Test", "train", "dev", "test"))
    return next((f for f in [folder, *sorted(files.folders(folder))] if holds(f)), None)


def split_folders(spark: SparkSession, root: str) -> dict[str, str]:
    files = _Files(spark)
    found = {s: next((f"{root}/{n}" for n in names if files.is_folder(f"{root}/{n}")), None) for s, names in SPLIT_FOLDERS.items()}
    return {s: f for s, f in found.items() if f}


@F.pandas_udf(DoubleType())
def _seconds(content: pd.Series) -> pd.Series:
    return content.map(duration).astype("float64")


def read_corpus(spark: SparkSession, folder: str, speaker: str = SPEAKER) -> DataFrame:
    """(split, stem, audio_filepath, text, duration, speaker_id): a row per WAV; text is null without a TXT.

    Only wav contents reach the duration probe, and only text files are read as text.
    """
    root = find_root(spark, folder)
    if root is None:
        raise ValueError(f"no split folders in {folder}")
    clean = lambda c: F.regexp_replace(c, "^file:/*", "/")

    def one(split: str, path: str) -> DataFrame:
        wav = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(path)
        wav = wav.select(clean("path").alias("audio_filepath"), file_stem("path").alias("stem"), _seconds("content").alias("duration"))
        txt = spark.read.format("text").option("pathGlobFilter", "*.txt").option("wholetext", True).load(path)
        txt = txt.select(file_stem("_metadata.file_path").alias("stem"), F.col("value").alias("text"))
        return wav.join(txt, "stem", "left").select(F.lit(split).alias("split"), "stem", "audio_filepath", "text", "duration", F.lit(speaker).alias("speaker_id"))

    return reduce(DataFrame.unionByName, [one(s, f) for s, f in split_folders(spark, root).items()])
