"""Line-numbered text sources: JSONL manifests, pipe metadata, CSV tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vokaflow.functions.text import is_blank

MANIFEST_SCHEMA = "audio_filepath string, text string, normalized_text string, phonemes string, duration double, speaker_id string"
LOOSE_SCHEMA = "text string, sentence string, normalized_text string, audio_filepath string, audio string, path string, wav string, duration double, speaker_id string, phonemes string"
BUCKET_SCHEMA = "line_no string, audio_filepath string, bucket string, matched_terms string, bucket_reasons string, longest_internal_gap_sec string, internal_gap_count string, internal_silence_ratio string, low_energy_ratio string"
MODES = ("report", "drop", "fail", "count")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value) with 1-based physical line numbers, blank lines included.

    Lines are counted per block of a file and a line's number is its place in the block
    plus the lines of the blocks before: one light extra pass, no sort of lines, no single task.
    Several files are numbered one after the other by path.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    blocks = lines.groupBy("file_path", "block").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    before = F.sum("n").over(Window.orderBy("file_path", "block")) - F.col("n")  # a row per block
    starts = blocks.select(F.col("file_path").alias("_f"), F.col("block").alias("_b"), (before - F.col("first") + 1).alias("shift"))
    joined = lines.join(starts, (F.col("file_path") == F.col("_f")) & (F.col("block") == F.col("_b")))
    return joined.select((F.col("id") + F.col("shift")).alias("line_no"), "value")


def parse_manifest(lines: DataFrame, schema: str = LOOSE_SCHEMA, mode: str = "report") -> DataFrame:
    """(line_no, value, the schema's columns, _corrupt) of (line_no, value) lines; blank lines go.

    mode says what becomes of lines that are no JSON object: report and count keep them with
    _corrupt set, drop removes them, fail raises naming the line.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode: {mode}")
    rows = lines.filter(~is_blank("value"))
    parsed = F.from_json("value", f"{schema}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = rows.withColumn("_r", parsed).select("line_no", "value", "_r.*")
    if mode == "drop":
        return rows.filter("_corrupt is null")
    if mode == "fail":
        message = F.concat(F.lit("not a JSON record on line "), F.col("line_no").cast("string"))
        return rows.withColumn("line_no", F.when(F.col("_corrupt").isNull(), F.col("line_no")).otherwise(F.raise_error(message).cast("long")))
    return rows


def read_manifest(spark: SparkSession, path: str, schema: str = LOOSE_SCHEMA, mode: str = "report", limit: int | None = None) -> DataFrame:
    """A JSONL manifest with line numbers; limit keeps the first records that parse, 0 none."""
    rows = parse_manifest(numbered_lines(spark, path), schema, mode)
    return rows if limit is None else rows.filter("_corrupt is null").orderBy("line_no").limit(limit)


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """A bucket table: any subset of its columns, all text; absent ones are null."""
    rows = spark.read.csv(path, header=True, escape='"', multiLine=True)
    wanted = [c.split()[0] for c in BUCKET_SCHEMA.split(", ")]
    return rows.select(*(F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in wanted))


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """An audit table with reasons as an array; columns are found by name, absent ones are null."""
    schema = (
        "manifest_line int, audio_filepath string, text string, text_length int, word_count int, audio_duration_sec double, sample_rate int, channels int, rms_level_db double, "
        "peak_level_db double, clipping_ratio double, leading_silence_sec double, trailing_silence_sec double, internal_silence_ratio double, longest_internal_gap_sec double, "
        "chars_per_sec double, words_per_sec double, quality_score int, status string, reasons string"
    )
    rows = spark.read.csv(path, header=True, escape='"', multiLine=True)
    typed = (c.split() for c in schema.split(", "))
    rows = rows.select(*((F.col(c) if c in rows.columns else F.lit(None)).cast(kind).alias(c) for c, kind in typed))
    return rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("reasons", F.array_remove(F.split(F.coalesce("reasons", F.lit("")), ";"), ""))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, stem, speaker, text) of pipe-separated metadata; no quoting."""
    parts = F.split("value", r"\|")
    rows = numbered_lines(spark, path).filter(~is_blank("value"))
    return rows.select("line_no", F.get(parts, F.lit(0)).alias("stem"), F.when(F.size(parts) > 2, F.get(parts, F.lit(1))).alias("speaker"), F.element_at(parts, -1).alias("text"))


def read_hub_records(rows: DataFrame) -> DataFrame:
    """Raw manifest rows of a table of (audio_path, duration) and any of the known text and speaker columns."""
    filled = lambda names: F.coalesce(*(F.nullif(F.col(n), F.lit("")) for n in names if n in rows.columns), F.lit(None).cast("string"))
    speaker = F.coalesce(F.trim(filled(("speaker_id", "speaker", "client_id"))), F.lit("unknown"))
    text = filled(("transcription", "text", "sentence", "transcript"))
    return rows.select(F.col("audio_path").alias("audio_filepath"), text.alias("text"), F.col("duration").cast("double").alias("duration"), speaker.alias("speaker_id")).filter("audio_filepath <> ''")


def config_summary(config: str = "value") -> Column:
    """What a model configuration given as JSON text holds: size and first entries of its id map, symbols, rate, voice; null if it is none."""
    schema = "num_symbols int, audio struct<sample_rate:int>, espeak struct<voice:string>, phoneme_id_map map<string,array<int>>"
    parsed = F.from_json(config, schema)
    names = F.sort_array(F.map_keys(parsed["phoneme_id_map"]))
    return F.when(parsed["num_symbols"].isNotNull(), F.struct(
        F.coalesce(F.size(names), F.lit(0)).alias("n_map"), F.slice(names, 1, 6).alias("first"), parsed["num_symbols"].alias("num_symbols"),
        parsed["audio"]["sample_rate"].alias("sample_rate"), parsed["espeak"]["voice"].alias("voice"),
    ))


def resolved(path: Column | str) -> Column:
    """A path with ``.``, ``..`` and doubled slashes taken out; links are not followed."""
    path = F.col(path) if isinstance(path, str) else path
    up = lambda done: F.when((F.size(done) > 0) & (F.element_at(F.concat(F.array(F.lit("..")), done), -1) != ".."), F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
    step = lambda done, part: F.when(part.isin("", "."), done).when(part != "..", F.concat(done, F.array(part))).otherwise(F.coalesce(up(done), F.when(path.startswith("/"), done).otherwise(F.concat(done, F.array(part)))))
    parts = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    return F.concat(F.when(path.startswith("/"), "/").otherwise(""), F.array_join(parts, "/"))
