"""Sinks: ordered text files, CSV reports, JSON statistics and markdown summaries.

Spark's committer makes each folder appear whole. Small reports are rendered on the driver from
aggregates of fixed size.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vokaflow.operators import audit, curate, manifest


def write_lines(rows: DataFrame, column: str, order: list[str], path: str) -> None:
    """Lines of text in order over the part files of a folder, sorted by range without a single task."""
    rows.orderBy(*order).select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_jsonl(rows: DataFrame, order: list[str], path: str) -> None:
    """One object a line; fields without a value are written as null."""
    columns = [c for c in rows.columns if c != "line_no"]
    line = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    write_lines(rows.withColumn("_line", line), "_line", order, path)


def joined(reasons: Column | str) -> Column:
    return F.array_join(reasons, ";")


def write_audit(rows: DataFrame, path: str, status: str | None = None) -> None:
    """The audit table as CSV with a header, all rows or those of one status."""
    rows = rows if status is None else rows.filter(F.col("status") == status)
    out = rows.withColumn("reasons", joined("reasons")).orderBy("manifest_line")
    out.select(*(c for c in audit.COLUMNS if c in out.columns)).write.mode("overwrite").option("escape", '"').option("header", True).option("emptyValue", "").csv(path)


def write_csv(rows: DataFrame, order: list[str], path: str) -> None:
    """CSV with a header; nulls are blank."""
    rows.orderBy(*order).write.mode("overwrite").option("escape", '"').option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)


def stats_json(prepared: DataFrame, n_filtered: int, min_duration: float = manifest.MIN_DURATION, max_duration: float = manifest.MAX_DURATION) -> str:
    s = manifest.manifest_stats(prepared).first()
    splits = {r["split"]: r["n"] for r in prepared.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    stats = {
        "total_hours": s["total_hours"], "total_count": s["total_count"], "filtered_count": n_filtered, "speaker_count": s["speaker_count"], "speakers": s["speakers"].split(",") if s["speakers"] else [],
        "duration_filter": {"min_s": min_duration, "max_s": max_duration}, "splits": splits,
    }
    return json.dumps(stats, ensure_ascii=False, indent=2)


def audit_markdown(audited: DataFrame, name: str, thresholds: audit.AuditThresholds = audit.AuditThresholds()) -> str:
    s, top = audit.audit_summary(audited).first(), audit.top_reasons(audited).collect()
    lines = ["# Audit summary", "", f"- Manifest: `{name}`", f"- Total rows audited: {s['total']}", *(f"- {k.capitalize()}: {s[k]}" for k in audit.STATUSES)]
    lines += [f"- Mean quality score: {s['mean_quality_score']:.1f}", f"- Mean duration: {s['mean_audio_duration_sec']:.2f} s", f"- Mean chars/sec: {s['mean_chars_per_sec']:.2f}"]
    lines += ["", "## Thresholds", "", *(f"- `{k}` = `{v}`" for k, v in asdict(thresholds).items()), "", "## Top reasons", ""]
    return "\n".join(lines + ([f"- `{r['reason']}`: {r['n']}" for r in top] or ["- No audit flags recorded."])) + "\n"


def term_markdown(name: str, summary: dict, terms: DataFrame, chars: DataFrame, stats: DataFrame) -> str:
    lines = ["# Target-term audit", "", f"- manifest: `{name}`", *(f"- {k}: {v}" for k, v in summary.items())]
    for title, counts in (("Term counts", terms), ("Character counts", chars)):
        lines += ["", f"## {title}", "", *(f"- {r['term']}: {r['n']}" for r in counts.orderBy(F.desc("n"), "term").collect())]
    lines += ["", "## Extracted-row stats", ""]
    for r in stats.collect():
        lines.append(f"- {r['metric']}: no readable values" if r["mean"] is None else f"- {r['metric']}: mean={r['mean']:.4f}, min={r['min']:.4f}, max={r['max']:.4f}")
    return "\n".join(lines) + "\n"


def exclusion_markdown(counts: dict, buckets: DataFrame, mode: str, retention: DataFrame | None, least: float) -> str:
    stats, reasons = curate.bucket_stats(buckets, mode).first().asDict(), curate.bucket_reason_counts(buckets, mode).collect()
    lines = ["# Clean manifest summary", "", f"- exclusion_mode: `{mode}`", *(f"- {k}: {v}" for k, v in counts.items()), "", "## Bucket match stats", "", *(f"- {k}: {v}" for k, v in stats.items())]
    lines += ["", "## Top exclusion reasons actually removed", "", *([f"- {r['reason']}: {r['n']}" for r in reasons] or ["- none"])]
    if retention is not None:
        rows = retention.collect()
        lines += ["", "## Protected term retention", "", "| term | before | after | retention_pct | status |", "|---|---:|---:|---:|---|"]
        lines += [f"| {r['term']} | {r['before']} | {r['after']} | {r['retention'] * 100:.2f} | {r['status']} |" for r in rows]
        low = [f"- protected term retention below threshold: {r['term']} ({r['retention'] * 100:.2f}% < {least * 100:.2f}%)" for r in rows if r["status"] == "WARNING"]
        lines += ["", "## Warnings", "", *(low or ["- none"])]
    return "\n".join(lines) + "\n"


def oversample_markdown(counts: dict, buckets: DataFrame, eligible: tuple[str, ...], exposure: DataFrame, warnings: list[str]) -> str:
    own = curate.bucket_counts(buckets).collect()
    lines = ["# Fine-tune manifest summary", "", *(f"- {k}: {v}" for k, v in counts.items()), "", "## Bucket counts", "", *(f"- {r['bucket']}: {r['n']}" for r in own)]
    lines += ["", "## Eligible target bucket counts", "", *([f"- {r['bucket']}: {r['n']}" for r in own if r["bucket"] in eligible] or ["- none"])]
    lines += ["", "## Target term counts", "", "| term | before | after | exposure_multiplier_estimate |", "|---|---:|---:|---:|"]
    lines += [f"| {r['term']} | {r['before']} | {r['after']} | {r['exposure']:.2f} |" for r in exposure.collect()]
    return "\n".join([*lines, "", "## Warnings", "", *([f"- {w}" for w in warnings] or ["- none"])]) + "\n"

