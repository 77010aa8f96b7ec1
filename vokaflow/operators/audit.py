"""Audit of utterances: reasons, quality score, status, filters and summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vokaflow.functions.signal import clamp, rate, score_ceiling, score_range
from vokaflow.functions.text import bound, strip, word_count

STATUSES = ("keep", "suspicious", "reject")
#: Reasons that reject a row by themselves.
SEVERE = (
    "audio_unreadable", "duration_too_short", "duration_too_long", "text_too_short", "text_too_long", "chars_per_sec_too_low", "chars_per_sec_too_high", "clipping_too_high", "internal_silence_too_high",
)
METRICS = ("audio_duration_sec", "rms_level_db", "peak_level_db", "clipping_ratio", "leading_silence_sec", "trailing_silence_sec", "internal_silence_ratio", "longest_internal_gap_sec")
COLUMNS = (
    "manifest_line", "audio_filepath", "text", "text_length", "word_count", "audio_duration_sec", "sample_rate", "channels", "rms_level_db", "peak_level_db", "clipping_ratio",
    "leading_silence_sec", "trailing_silence_sec", "internal_silence_ratio", "longest_internal_gap_sec", "chars_per_sec", "words_per_sec", "quality_score", "status", "reasons",
)


@dataclass(frozen=True)
class AuditThresholds:
    min_duration_sec: float = 0.8
    max_duration_sec: float = 15.0
    min_text_chars: int = 3
    max_text_chars: int = 250
    min_chars_per_sec: float = 6.0
    max_chars_per_sec: float = 22.0
    max_leading_silence_sec: float = 0.5
    max_trailing_silence_sec: float = 0.7
    max_internal_silence_ratio: float = 0.40
    max_longest_internal_gap_sec: float = 0.45
    max_clipping_ratio: float = 0.01
    silence_threshold_db: float = -40.0
    silence_frame_ms: float = 20.0
    silence_hop_ms: float = 10.0
    min_rms_db: float = -30.0
    max_peak_db: float = -0.5


def audit_reasons(t: AuditThresholds = AuditThresholds()) -> Column:
    """Which limits a row breaks, in a fixed order; from the metric columns, text_length, chars_per_sec."""
    c = F.col
    tests = (
        ("duration_too_short", c("audio_duration_sec") < t.min_duration_sec), ("duration_too_long", c("audio_duration_sec") > t.max_duration_sec),
        ("text_too_short", c("text_length") < t.min_text_chars), ("text_too_long", c("text_length") > t.max_text_chars),
        ("chars_per_sec_too_low", c("chars_per_sec") < t.min_chars_per_sec), ("chars_per_sec_too_high", c("chars_per_sec") > t.max_chars_per_sec),
        ("leading_silence_too_high", c("leading_silence_sec") > t.max_leading_silence_sec), ("trailing_silence_too_high", c("trailing_silence_sec") > t.max_trailing_silence_sec),
        ("internal_silence_too_high", c("internal_silence_ratio") > t.max_internal_silence_ratio), ("longest_internal_gap_too_high", c("longest_internal_gap_sec") > t.max_longest_internal_gap_sec),
        ("clipping_too_high", c("clipping_ratio") > t.max_clipping_ratio), ("rms_too_low", c("rms_level_db") < t.min_rms_db), ("peak_too_high", c("peak_level_db") > t.max_peak_db),
    )
    return F.filter(F.array(*(F.when(test, F.lit(name)) for name, test in tests)), lambda r: r.isNotNull())


def quality_score(t: AuditThresholds = AuditThresholds()) -> Column:
    """0 to 100, from duration, speed, silence, level and clipping; ties round to even."""
    c = F.col
    limits = {"leading_silence_sec": t.max_leading_silence_sec, "trailing_silence_sec": t.max_trailing_silence_sec, "internal_silence_ratio": t.max_internal_silence_ratio, "longest_internal_gap_sec": t.max_longest_internal_gap_sec}
    worst = F.greatest(*(c(k) / max(v, 1e-6) for k, v in limits.items()))
    total = (
        score_range(c("audio_duration_sec"), 1.0, 12.0, 20.0) + score_range(c("chars_per_sec"), 8.0, 18.0, 20.0) + 20.0 * clamp(1.0 - F.greatest(F.lit(0.0), worst - 1.0))
        + (score_range(c("rms_level_db"), -26.0, -14.0, 12.0) + score_range(-c("peak_level_db"), 0.7, 12.0, 8.0)) + score_ceiling(c("clipping_ratio"), t.max_clipping_ratio, 20.0)
    )
    hasty = F.when(c("words_per_sec") > 4.5, 5.0).otherwise(0.0)
    slow = F.when((c("words_per_sec") < 1.0) & (c("audio_duration_sec") > 0), 5.0).otherwise(0.0)
    return F.bround(clamp(total - hasty - slow, 0.0, 100.0), 0).cast("int")


def audit_status(reasons: Column, score: Column) -> Column:
    severe = F.arrays_overlap(reasons, F.array(*map(F.lit, SEVERE)))
    return F.when(severe | (score < 50), "reject").when((score >= 75) & (F.size(reasons) == 0), "keep").otherwise("suspicious")


def with_text_stats(rows: DataFrame) -> DataFrame:
    """Adds text_length, word_count, chars_per_sec, words_per_sec of the stripped text; a null text is empty.

    The text is stripped and counted below an explode of one struct, which no filter on what follows can cross: it is done once.
    """
    stats = bound(F.coalesce(strip("text"), F.lit("")), lambda t: F.struct(t.alias("text"), F.length(t).alias("text_length"), word_count(t).alias("word_count")))
    columns = [c for c in rows.columns if c not in ("text_length", "word_count")]
    rows = rows.select(*(F.col(c) for c in columns if c != "text"), F.explode(F.array(stats)).alias("_stats"))
    rows = rows.select(*(F.col("_stats.text") if c == "text" else F.col(c) for c in columns), "_stats.text_length", "_stats.word_count")
    return rows.withColumns({"chars_per_sec": rate(F.col("text_length"), F.col("audio_duration_sec")), "words_per_sec": rate(F.col("word_count"), F.col("audio_duration_sec"))})


def audit(rows: DataFrame, thresholds: AuditThresholds = AuditThresholds()) -> DataFrame:
    """Adds text stats, quality_score, status and reasons to rows of (text, metrics).

    Rows with null metrics are unreadable: zeros, -100 dB, one reason, score 0, reject. Metrics
    are rounded after scoring.
    """
    readable = F.col("audio_duration_sec").isNotNull()
    blank = {m: F.coalesce(m, F.lit(-100.0 if m.endswith("_db") else 0.0)) for m in METRICS}
    rows = with_text_stats(rows.withColumn("_readable", readable).withColumns(blank))
    rows = rows.withColumn("reasons", F.when(F.col("_readable"), audit_reasons(thresholds)).otherwise(F.array(F.lit("audio_unreadable"))))
    rows = rows.withColumn("quality_score", F.when(F.col("_readable"), quality_score(thresholds)).otherwise(0))
    rows = rows.withColumn("status", audit_status(F.col("reasons"), F.col("quality_score"))).drop("_readable")
    digits = dict.fromkeys(METRICS, 4) | {"rms_level_db": 2, "peak_level_db": 2, "clipping_ratio": 6, "chars_per_sec": 4, "words_per_sec": 4}
    return rows.withColumns({k: F.bround(k, n) for k, n in digits.items()})


def mode_filter(mode: str) -> Column:
    """strict, balanced, rejects or suspicious, on status and reasons."""
    status = F.col("status")
    excluded = F.arrays_overlap("reasons", F.array(*map(F.lit, SEVERE)))
    modes = {"strict": status == "keep", "balanced": (status == "keep") | ((status == "suspicious") & ~excluded), "rejects": status == "reject", "suspicious": status == "suspicious"}
    if mode not in modes:
        raise ValueError(f"unknown filter mode: {mode}")
    return modes[mode]


def audit_summary(audited: DataFrame) -> DataFrame:
    count = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    mean = [F.coalesce(F.avg(c), F.lit(0.0)).alias(f"mean_{c}") for c in ("quality_score", "audio_duration_sec", "chars_per_sec")]
    return audited.agg(F.count(F.lit(1)).alias("total"), *count, *mean)


def reason_histogram(audited: DataFrame) -> DataFrame:
    return audited.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def top_reasons(audited: DataFrame, n: int = 10) -> DataFrame:
    return reason_histogram(audited).orderBy(F.desc("n"), "reason").limit(n)


def filter_totals(audited: DataFrame, mode: str) -> DataFrame:
    kept = F.count_if(mode_filter(mode))
    return audited.agg(F.lit(mode).alias("mode"), kept.alias("kept"), F.count(F.lit(1)).alias("total"), (F.count(F.lit(1)) - kept).alias("dropped"))


def filter_lines(manifest: DataFrame, audited: DataFrame, mode: str) -> DataFrame:
    """Manifest lines whose number the audit selects."""
    return manifest.join(audited.filter(mode_filter(mode)).select(F.col("manifest_line").alias("line_no")), "line_no", "left_semi")


def numeric_stats(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(column, mean, min, max) over the non-null, finite values; nulls where there are none."""
    parts = []
    for c in columns:
        v = F.col(c).cast("double")
        parts += [F.struct(F.lit(c).alias("metric"), F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"))]
    return rows.agg(F.array(*parts).alias("s")).select(F.explode("s").alias("s")).select("s.*")
