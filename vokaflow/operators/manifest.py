"""Manifests: preparation, validation, statistics, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vokaflow.functions.normalize import normalize_text
from vokaflow.functions.phonemes import phonemize
from vokaflow.functions.text import bound, is_blank, strip

MIN_DURATION, MAX_DURATION = 0.5, 20.0
REQUIRED = ("audio_filepath", "duration", "normalized_text", "phonemes", "speaker_id", "text")
SPLITS = ("train", "val", "test")


def drop_reason(min_duration: float = MIN_DURATION, max_duration: float = MAX_DURATION) -> Column:
    """Why a raw (text, duration) row is dropped before the costly steps, or null."""
    return F.when(F.col("text").isNull(), "no_text").when(is_blank("text"), "empty_text").when(~F.coalesce(F.col("duration").between(min_duration, max_duration), F.lit(False)), "duration")


def prepare_manifest(raw: DataFrame, *, min_duration: float = MIN_DURATION, max_duration: float = MAX_DURATION, keep: tuple[str, ...] = ()) -> DataFrame:
    """Manifest rows of raw (audio_filepath, text, duration, speaker_id): cheap filters first, then
    normalization and phonemes; rows left without either go."""
    rows = raw.filter(drop_reason(min_duration, max_duration).isNull()).withColumn("text", strip("text"))
    # A filter on the two texts would be pushed below them and make them again; an explode of at most one pair is not.
    none = F.array().cast("array<struct<normalized_text:string,phonemes:string>>")
    pair = lambda n, p: F.when(~is_blank(n) & ~is_blank(p), F.array(F.struct(n.alias("normalized_text"), p.alias("phonemes")))).otherwise(none)
    made = bound(normalize_text("text"), lambda n: bound(phonemize(n), lambda p: pair(n, p)))
    rows = rows.withColumn("_made", F.explode(made)).withColumns({"normalized_text": F.col("_made.normalized_text"), "phonemes": F.col("_made.phonemes")})
    return rows.select(*keep, "audio_filepath", "text", "normalized_text", "phonemes", F.bround("duration", 4).alias("duration"), "speaker_id")


def filtered_count(raw: DataFrame, *, min_duration: float = MIN_DURATION, max_duration: float = MAX_DURATION) -> DataFrame:
    dropped = drop_reason(min_duration, max_duration).isNotNull()
    return raw.agg(F.count(F.lit(1)).alias("total"), F.count_if(dropped).alias("filtered"), F.count_if(~dropped).alias("kept"))


def row_error(*, line: str = "line_no", min_duration: float = MIN_DURATION, max_duration: float = MAX_DURATION, audio_exists: Column | None = None, corrupt: Column | None = None) -> Column:
    """The first check that a manifest row fails, as a message, or null."""
    where = F.concat(F.lit("line "), F.col(line).cast("string"), F.lit(": "))
    absent = F.filter(F.array(*(F.when(F.col(c).isNull(), F.lit(f"'{c}'")) for c in REQUIRED)), lambda x: x.isNotNull())
    outside = F.concat(F.lit("duration "), F.format_string("%.3f", F.col("duration")), F.lit(f"s outside [{min_duration}, {max_duration}]"))
    checks = [] if corrupt is None else [(corrupt, F.lit("JSON error"))]
    checks += [(F.size(absent) > 0, F.concat(F.lit("missing fields: ["), F.array_join(absent, ", "), F.lit("]")))]
    checks += [] if audio_exists is None else [(~audio_exists, F.concat(F.lit("audio not found: "), F.col("audio_filepath")))]
    checks += [(~F.col("duration").between(min_duration, max_duration), outside), (is_blank("text"), F.lit("empty text")), (is_blank("phonemes"), F.lit("empty phonemes"))]
    out = F.when(checks[0][0], checks[0][1])
    for test, message in checks[1:]:
        out = out.when(test, message)
    return F.when(out.isNotNull(), F.concat(where, out))


def validate(rows: DataFrame, **options) -> DataFrame:
    """(line_no, error) of the bad rows."""
    return rows.select("line_no", row_error(**options).alias("error")).filter("error is not null")


def validation_summary(rows: DataFrame, **options) -> DataFrame:
    error = row_error(**options)
    return rows.agg(F.count_if(error.isNull()).alias("valid"), F.count_if(error.isNotNull()).alias("errors"))


def manifest_stats(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.bround(F.coalesce(F.sum("duration"), F.lit(0.0)) / 3600, 3).alias("total_hours"), F.count(F.lit(1)).alias("total_count"),
        F.count_distinct("speaker_id").alias("speaker_count"), F.array_join(F.sort_array(F.collect_set("speaker_id")), ",").alias("speakers"),
    )


def symbol_inventory(phonemes: DataFrame) -> DataFrame:
    """Distinct phoneme symbols of rows of (phonemes) in code-point order."""
    symbol = F.explode(F.array_remove(F.split("phonemes", r"[\s\x1c-\x1f\x85\p{Z}]+"), ""))
    return phonemes.select(symbol.alias("symbol")).distinct().orderBy("symbol")


def split_order(split: Column | str = "split") -> Column:
    split = F.col(split) if isinstance(split, str) else split
    return F.array_position(F.array(*map(F.lit, SPLITS)), split)


def ratio_split(rows: DataFrame, key: str, *, val: float = 0.025, test: float = 0.025, seed: int = 42) -> DataFrame:
    """Adds split by a seeded hash order of the key, val and test at least one row each, train the rest.

    Only the places of the few rows at the end of the order matter, so rows are ranked by counts
    of hash ranges, not by one sort: a cell holds about a thousand rows.
    """
    n = rows.count()
    n_val, n_test = max(1, int(n * val)), max(1, int(n * test))
    cells = max(1, n // 1000)
    hashed = rows.withColumn("_h", F.xxhash64(F.lit(seed), F.col(key))).withColumn("_cell", F.floor((F.shiftrightunsigned("_h", 11) / float(1 << 53)) * cells).cast("long"))
    counts = hashed.groupBy("_cell").agg(F.count(F.lit(1)).alias("_m"))
    before = counts.select("_cell", (F.sum("_m").over(Window.orderBy("_cell")) - F.col("_m")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_cell").orderBy("_h", key)) + F.col("_before")
    placed = hashed.join(before, "_cell").withColumn("_place", place)
    split = F.when(F.col("_place") > n - n_test, "test").when(F.col("_place") > n - n_test - n_val, "val").otherwise("train")
    return placed.withColumn("split", split).drop("_h", "_cell", "_before", "_place")
