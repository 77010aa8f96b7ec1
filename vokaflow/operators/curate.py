"""Curation by buckets: exclusion with term retention, and controlled oversampling.

Two rules for matching a manifest row to bucket rows live side by side on purpose: exclusion
takes a row whose audio path OR line number is listed; the oversampling build looks at the audio path and
at the line number only where there is no path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vokaflow.functions.match import has_any_term, matched

BAD_BUCKET, MIN_RETENTION = "bad_or_reject_like", 0.80
#: Reasons that exclude in every mode, and the relaxed limits with their reasons.
HARD_REASONS = ("audio_unreadable_or_missing", "duration_too_short", "duration_too_long", "chars_per_sec_too_high", "chars_per_sec_too_low", "rms_too_low", "peak_near_clip")
RELAXED = (
    ("longest_internal_gap_too_high", "longest_internal_gap_sec", 0.80), ("internal_gap_count_too_high", "internal_gap_count", 6.0),
    ("internal_silence_too_high", "internal_silence_ratio", 0.60), ("low_energy_ratio_too_high", "low_energy_ratio", 0.60),
)
EXCLUSION_MODES, BUILD_MODES = ("aggressive", "relaxed", "hard"), {"conservative": 1, "weighted": 2, "target_only": 0}
SPARSE = 5


def lenient_number(c: str) -> Column:
    return F.expr(f"try_cast(trim({c}) as double)")


def reason_set(c: str = "bucket_reasons") -> Column:
    return F.array_distinct(F.array_remove(F.split(F.coalesce(c, F.lit("")), r"\|"), ""))


def line_key(c: str = "line_no") -> Column:
    """A line number given as text, cut to whole; null if it is none."""
    return F.expr(f"try_cast(try_cast(trim({c}) as double) as long)")


def path_key(c: str = "audio_filepath") -> Column:
    return F.nullif(F.trim(F.col(c)), F.lit(""))


def excluded(mode: str = "aggressive", bucket: str = BAD_BUCKET) -> Column:
    """Whether a bucket row is selected for exclusion."""
    if mode not in EXCLUSION_MODES:
        raise ValueError(f"unknown exclusion mode: {mode}")
    listed = F.coalesce(F.col("bucket") == bucket, F.lit(False))
    if mode == "aggressive":
        return listed
    out = F.arrays_overlap(reason_set(), F.array(*map(F.lit, HARD_REASONS)))
    if mode == "relaxed":
        for reason, column, least in RELAXED:
            out = out | (F.array_contains(reason_set(), reason) & F.coalesce(lenient_number(column) >= least, F.lit(False)))
    return listed & out


def exclusion_keys(buckets: DataFrame, mode: str = "aggressive", bucket: str = BAD_BUCKET) -> tuple[DataFrame, DataFrame]:
    """Distinct audio paths and line numbers of the selected bucket rows."""
    chosen = buckets.filter(excluded(mode, bucket))
    paths = chosen.select(path_key().alias("audio_filepath")).filter("audio_filepath is not null").distinct()
    return paths, chosen.select(line_key().alias("line_no")).filter("line_no is not null").distinct()


def exclude_either(manifest: DataFrame, paths: DataFrame, lines: DataFrame) -> DataFrame:
    """Manifest rows that neither list names."""
    return manifest.join(paths, "audio_filepath", "left_anti").join(lines, "line_no", "left_anti")


def flag_fallback(manifest: DataFrame, paths: DataFrame, lines: DataFrame, name: str) -> DataFrame:
    """Adds whether the row's path is listed, or its line if it has no path."""
    p = paths.select(F.col("audio_filepath").alias("_path"), F.lit(True).alias("_by_path"))
    n = lines.select(F.col("line_no").alias("_line"), F.lit(True).alias("_by_line"))
    out = manifest.join(p, F.col("audio_filepath") == F.col("_path"), "left").join(n, F.col("line_no") == F.col("_line"), "left")
    has = F.coalesce(F.col("audio_filepath"), F.lit("")) != ""
    flag = F.when(has, F.coalesce("_by_path", F.lit(False))).otherwise(F.coalesce("_by_line", F.lit(False)))
    return out.withColumn(name, flag).drop("_path", "_by_path", "_line", "_by_line")


def bucket_stats(buckets: DataFrame, mode: str = "aggressive", bucket: str = BAD_BUCKET) -> DataFrame:
    chosen = excluded(mode, bucket)
    return buckets.agg(
        F.count(F.lit(1)).alias("bucket_rows_total"), F.count_if(F.col("bucket") == bucket).alias("bucket_rows_matching_bucket"), F.count_if(chosen).alias("bucket_rows_selected_for_exclusion"),
        F.count_if(chosen & path_key().isNotNull()).alias("bucket_rows_with_audio_key"), F.count_if(chosen & line_key().isNotNull()).alias("bucket_rows_with_line_key"),
    )


def bucket_reason_counts(buckets: DataFrame, mode: str = "aggressive", bucket: str = BAD_BUCKET, n: int = 20) -> DataFrame:
    reasons = buckets.filter(excluded(mode, bucket)).select(F.explode(reason_set()).alias("reason"))
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason").limit(n)


def bucket_counts(buckets: DataFrame) -> DataFrame:
    return buckets.select(F.trim("bucket").alias("bucket")).filter("bucket <> ''").groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).orderBy("bucket")


def unmatched_keys(manifest: DataFrame, paths: DataFrame, lines: DataFrame) -> DataFrame:
    """How many listed paths and lines name a manifest row, and how many do not: one row each."""

    def one(keys: DataFrame, column: str) -> DataFrame:
        there = manifest.select(column).distinct().withColumn("_there", F.lit(True))
        hit = F.col("_there").isNotNull()
        return keys.join(there, column, "left").agg(F.lit(column).alias("key"), F.count_if(hit).alias("matched"), F.count_if(~hit).alias("unmatched"))

    return one(paths, "audio_filepath").unionByName(one(lines, "line_no"))


def term_hits(rows: DataFrame, terms: Sequence[str], name: str) -> DataFrame:
    """(term, name) rows with each term, terms without rows too: one pass, no explosion of texts."""
    found = rows.select(F.explode(F.array(matched("text", terms))).alias("found"))  # below the explode, so texts are folded once
    counts = F.array(*(F.struct(F.lit(t).alias("term"), F.count_if(F.array_contains("found", t)).alias(name)) for t in terms))
    return found.agg(counts.alias("c")).select(F.explode("c").alias("c")).select("c.*")


def term_retention(before: DataFrame, after: DataFrame, terms: Sequence[str], least: float = MIN_RETENTION) -> DataFrame:
    both = term_hits(before, terms, "before").join(term_hits(after, terms, "after"), "term")
    kept = F.when(F.col("before") <= 0, 1.0).otherwise(F.col("after") / F.col("before"))
    return both.withColumn("retention", kept).withColumn("status", F.when(F.col("retention") < least, "WARNING").otherwise("OK"))


def target_candidates(manifest: DataFrame, buckets: DataFrame, terms: Sequence[str], *, exclude: Sequence[str] = (BAD_BUCKET,), eligible: Sequence[str] = ("good",)) -> DataFrame:
    """The manifest with excluded, candidate (listed as a target and with a term)."""
    named = buckets.withColumn("bucket", F.trim(F.coalesce("bucket", F.lit(""))))
    keys = lambda names: (
        named.filter(F.col("bucket").isin(*names)).select(path_key().alias("audio_filepath")).filter("audio_filepath is not null").distinct(),
        named.filter(F.col("bucket").isin(*names)).select(line_key().alias("line_no")).filter("line_no is not null").distinct(),
    )
    out = flag_fallback(flag_fallback(manifest, *keys(exclude), "excluded"), *keys(eligible), "candidate")
    hit = has_any_term("text", terms)
    return out.withColumn("candidate", ~F.col("excluded") & F.col("candidate") & hit)


def repeats(mode: str, most: int | None = None) -> int:
    if mode not in BUILD_MODES:
        raise ValueError(f"unknown build mode: {mode}")
    return BUILD_MODES[mode] if most is None else max(0, min(BUILD_MODES[mode], most))


def oversample(flagged: DataFrame, mode: str, *, most_repeats: int | None = None, most_rows: int | None = None) -> DataFrame:
    """(phase, line_no, copy, ...): kept rows, then each candidate's copies, in output order and cut at most_rows.

    target_only has no kept rows and each candidate once.
    """
    n = 1 if mode == "target_only" else repeats(mode, most_repeats)
    kept = flagged.filter(F.lit(mode != "target_only") & ~F.col("excluded")).withColumns({"phase": F.lit(0), "copy": F.lit(1)})
    more = flagged.filter("candidate").withColumns({"phase": F.lit(1), "copy": F.explode(F.sequence(F.lit(1), F.lit(n)) if n else F.array().cast("array<int>"))})
    out = kept.unionByName(more).drop("excluded", "candidate")
    return out if most_rows is None else out.orderBy("phase", "line_no", "copy").limit(most_rows)


def term_exposure(before: DataFrame, built: DataFrame, terms: Sequence[str]) -> DataFrame:
    both = term_hits(before, terms, "before").join(term_hits(built, terms, "after"), "term")
    return both.withColumn("exposure", F.when(F.col("before") <= 0, 0.0).otherwise(F.col("after") / F.col("before")))


def build_warnings(exposure: DataFrame, n_input: int, n_output: int, *, cap: int | None = None, base_rows: int = 0) -> DataFrame:
    """One row per warning: cap reached, absent or sparse terms, an output half as large again."""
    spark = exposure.sparkSession
    text = F.when(F.col("before") == 0, F.concat(F.lit("target term absent from base manifest: "), "term"))
    text = text.when(F.col("after") <= SPARSE, F.concat(F.lit("target term remains sparse after build: "), "term", F.lit(" ("), F.col("after").cast("string"), F.lit(")")))
    out = exposure.select(text.alias("warning")).filter("warning is not null")
    fixed = []
    if cap is not None and n_output >= cap:
        fixed.append(f"max_output_rows reached while {'writing base' if base_rows > cap else 'appending target'} rows: {cap}")
    if n_output > n_input * 1.5:
        fixed.append(f"output manifest is substantially larger than base manifest: {n_output} vs {n_input}")
    return out.unionByName(spark.createDataFrame([(w,) for w in fixed], "warning string")) if fixed else out

