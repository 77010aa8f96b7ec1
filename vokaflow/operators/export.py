"""Training layout: unique stems, metadata lines, speaker ids, caps, validation."""

from __future__ import annotations

import json
import os
import shutil
import sys

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vokaflow.functions.text import file_stem, strip

from .manifest import SPLITS, split_order

SIDE_CAP, SAMPLE_RATE, LANGUAGE, MOST_SYMBOLS = 10, 22050, "tr", 256
INFERENCE = {"noise_scale": 0.667, "length_scale": 1.0, "noise_w": 0.8}


def cap_splits(rows: DataFrame, limit: int | None, side_cap: int = SIDE_CAP) -> DataFrame:
    """The first ``limit`` train rows and ``side_cap`` val and test rows by line; all without a limit.
    Each split is a top-k of its own, so no window gathers a split."""
    if limit is None:
        return rows
    parts = [rows.filter(F.col("split") == s).orderBy("line_no").limit(limit if s == "train" else side_cap) for s in SPLITS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def unique_stems(rows: DataFrame) -> DataFrame:
    """Adds stem: a file stem belongs to the first path that has it, in split and line order; every row of
    another path gets _2, _3, ... A stem that is itself another's made-up name goes through an
    ordered pass over just the stems concerned.
    """
    order = [split_order(), F.col("line_no")]
    base = rows.drop("stem").withColumn("_base", file_stem("audio_filepath"))
    owner = F.min(F.struct(split_order().alias("o"), "line_no", "audio_filepath"))
    owners = base.groupBy("_base").agg(owner.alias("_owner"), F.count_distinct("audio_filepath").alias("_paths"))
    joined = base.join(owners.select("_base", F.col("_owner.audio_filepath").alias("_own"), "_paths"), "_base")
    other = F.col("audio_filepath") != F.col("_own")
    # Only rows that need a suffix meet in a window.
    named = joined.filter(~other | F.col("audio_filepath").isNull()).withColumn("stem", F.col("_base"))
    suffix = F.row_number().over(Window.partitionBy("_base").orderBy(*order)) + 1
    made = joined.filter(other).withColumn("stem", F.concat("_base", F.lit("_"), suffix.cast("string")))
    out = named.unionByName(made)
    # A made-up name keeps its root, so only rows of one root can meet.
    root = lambda name: F.regexp_replace(name, r"(_[0-9]+)+$", "")
    columns = [*(c for c in base.columns if c != "_base"), "stem"]
    met = colliding_stems(out).select(root("stem").alias("_root")).distinct()
    apart = out.withColumn("_root", root("_base")).join(met, "_root", "left_anti").select(*columns)
    schema = StructType([*base.drop("_base").schema.fields, StructField("stem", StringType())])
    together = base.withColumn("_root", root("_base")).join(met, "_root", "left_semi").withColumn("_order", split_order())
    return apart.unionByName(together.groupBy("_root").applyInArrow(_stems_in_order(columns), schema))


def _stems_in_order(columns: list[str]):
    """The rows of one root with their stems, each the first free name in split and line order."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("_order", "ascending"), ("line_no", "ascending")])
        seen, following, stems = {}, {}, []
        for path, base in zip(rows.column("audio_filepath").to_pylist(), rows.column("_base").to_pylist(), strict=True):
            stem = base
            if seen.get(base, path) != path:
                i = following.get(base, 2)
                while (stem := f"{base}_{i}") in seen:
                    i += 1
                following[base] = i + 1
            seen[stem] = path
            stems.append(stem)
        return rows.append_column("stem", pa.array(stems, pa.string())).select(columns)

    return run


def colliding_stems(stemmed: DataFrame) -> DataFrame:
    """Stems that two different paths ended up with: a literal name equal to a made-up one."""
    return stemmed.groupBy("stem").agg(F.count_distinct("audio_filepath").alias("paths")).filter("paths > 1").select("stem")


def speaker_ids(rows: DataFrame) -> DataFrame:
    """(speaker, id): ids from 0 by name."""
    names = rows.select(F.coalesce("speaker_id", F.lit("default")).alias("speaker")).distinct()
    return names.withColumn("id", (F.row_number().over(Window.orderBy("speaker")) - 1).cast("long"))


def metadata_lines(stemmed: DataFrame, multi_speaker: bool) -> DataFrame:
    """(split, line_no, line): fields joined by pipes, nothing quoted."""
    text = F.coalesce(F.nullif(F.col("normalized_text"), F.lit("")), "text", F.lit(""))
    speaker = [F.coalesce("speaker_id", F.lit("default"))] if multi_speaker else []
    return stemmed.select("split", "line_no", F.concat_ws("|", "stem", *speaker, text).alias("line"))


def split_stems(stemmed: DataFrame) -> DataFrame:
    """(stem, split): a stem in several splits belongs to the last."""
    return stemmed.groupBy("stem").agg(F.max_by("split", split_order()).alias("split"))


def layout_config(speakers: list[str], sample_rate: int = SAMPLE_RATE, language: str = LANGUAGE) -> str:
    ids = {s: i for i, s in enumerate(sorted(speakers))}
    config = {
        "audio": {"sample_rate": sample_rate}, "espeak": {"language": language, "voice": language}, "inference": INFERENCE, "phoneme_type": "espeak",
        "num_speakers": len(ids), "num_symbols": MOST_SYMBOLS, "phoneme_id_map": {}, "speaker_id_map": ids if len(ids) > 1 else {},
    }
    return json.dumps(config, indent=2, ensure_ascii=False) + "\n"


def metadata_error(wav_exists: Column, *, line: str = "line_no", value: str = "value") -> Column:
    """The first check that a metadata line fails, or null; blank lines pass."""
    parts = F.split(strip(value), r"\|")
    stem, text = strip(F.get(parts, F.lit(0))), strip(F.element_at(parts, -1))
    where = F.concat(F.lit("metadata.csv line "), F.col(line).cast("string"), F.lit(": "))
    error = F.when(strip(value) == "", None).when(F.size(parts) < 2, "too few columns").when(stem == "", "empty stem")
    error = error.when(text == "", F.concat(F.lit("empty text for stem '"), stem, F.lit("'"))).when(~wav_exists, F.concat(F.lit("wavs/"), stem, F.lit(".wav not found")))
    return F.when(error.isNotNull(), F.concat(where, error))


def validate_metadata(lines: DataFrame, wav_stems: DataFrame) -> DataFrame:
    """(line_no, error) of bad (line_no, value) lines against a listing of wav stems."""
    keyed = lines.withColumn("_stem", strip(F.get(F.split(strip("value"), r"\|"), F.lit(0))))
    there = wav_stems.select(F.col("stem").alias("_stem"), F.lit(True).alias("_there")).distinct()
    joined = keyed.join(there, "_stem", "left")
    return joined.select("line_no", metadata_error(F.coalesce("_there", F.lit(False))).alias("error")).filter("error is not null")


def link_files(folder: str):
    """For foreachPartition over (audio_filepath, stem): each file linked, else copied, as folder/stem.wav; what is there stays.

    The folder is one that all executors mount. A file that can be neither linked nor copied is named on standard error.
    """

    def run(rows) -> None:
        os.makedirs(folder, exist_ok=True)
        for r in rows:
            target = f"{folder}/{r['stem']}.wav"
            if not r["audio_filepath"] or os.path.lexists(target):
                continue
            try:
                os.symlink(os.path.abspath(r["audio_filepath"]), target)
            except FileExistsError:  # another attempt of this task was first
                continue
            except OSError:
                try:
                    shutil.copy2(r["audio_filepath"], target)
                except OSError as e:
                    print(f"cannot link or copy {target}: {e}", file=sys.stderr)

    return run
