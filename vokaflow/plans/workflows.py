"""The workflows: prepare a corpus, audit and clean a manifest, audit terms, build manifests, export a layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vokaflow import sinks
from vokaflow.functions import match
from vokaflow.functions.text import file_stem, first_filled, is_blank
from vokaflow.operators import audit, curate, export, manifest
from vokaflow.sources import audio, corpus
from vokaflow.sources.manifest import LOOSE_SCHEMA, MANIFEST_SCHEMA, numbered_lines, read_audit, read_buckets, read_manifest, resolved


#: The longest list of paths that is broadcast.
MOST_LISTED = 100_000


def _save(spark: SparkSession, path: str, text: str) -> None:
    """A small text file in any store that Spark writes."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _folder(path: str) -> str:
    return path.rsplit("/", 1)[0] if "/" in path else "."


def _audio_column(path: str, names: Sequence[str] = ("audio_filepath", "audio", "path", "wav"), resolve: bool = True) -> Column:
    value = first_filled(*names)
    value = F.when(value == "", "").when(value.startswith("/"), value).otherwise(F.concat(F.lit(_folder(path) + "/"), value))
    return resolved(value) if resolve else value


def prepare(spark: SparkSession, folder: str, out: str, *, speaker: str = corpus.SPEAKER, min_duration: float = manifest.MIN_DURATION, max_duration: float = manifest.MAX_DURATION) -> DataFrame:
    """Raw corpus to a manifest folder per split, symbols.txt and stats.json. Read once, written once, then read back."""
    raw = corpus.read_corpus(spark, folder, speaker)
    n = raw.count()
    rows = manifest.prepare_manifest(raw, min_duration=min_duration, max_duration=max_duration, keep=("split", "stem"))
    rows.write.mode("overwrite").partitionBy("split").parquet(f"{out}/manifest")
    rows = spark.read.schema(rows.schema).parquet(f"{out}/manifest")
    for split in manifest.SPLITS:
        sinks.write_jsonl(rows.filter(F.col("split") == split).select(*(c.split()[0] for c in MANIFEST_SCHEMA.split(", "))), ["audio_filepath"], f"{out}/{split}.jsonl")
    symbols = [r["symbol"] for r in manifest.symbol_inventory(rows).collect()]  # some dozens
    _save(spark, f"{out}/symbols.txt", "\n".join(symbols) + "\n")
    _save(spark, f"{out}/stats.json", sinks.stats_json(rows, n - rows.count(), min_duration, max_duration))
    return rows


def validate_file(spark: SparkSession, path: str, *, check_audio: bool = True, min_duration: float = manifest.MIN_DURATION, max_duration: float = manifest.MAX_DURATION) -> tuple[int, list[str]]:
    rows = read_manifest(spark, path, MANIFEST_SCHEMA, "report")
    exists = None
    if check_audio:
        # One listing of each folder that the manifest names, not one request per row.
        named = rows.select("audio_filepath").filter("audio_filepath is not null").distinct()
        folders = [r[0] for r in named.select(F.regexp_extract("audio_filepath", "^(.*)/[^/]*$", 1).alias("f")).distinct().collect()]
        fs = corpus._Files(spark)
        there = [f for f in folders if f and fs.is_folder(f)]
        listed = spark.read.format("binaryFile").load(there).select(F.regexp_replace("path", "^file:/*", "/").alias("_path")) if there else spark.createDataFrame([], "_path string")
        rows = rows.join(listed.withColumn("_there", F.lit(True)), F.col("audio_filepath") == F.col("_path"), "left")
        exists = F.coalesce("_there", F.lit(False))
    error = manifest.row_error(min_duration=min_duration, max_duration=max_duration, audio_exists=exists, corrupt=F.col("_corrupt").isNotNull())
    judged = rows.select("line_no", error.alias("error"))
    valid = judged.filter("error is null").count()
    return valid, [r["error"] for r in judged.filter("error is not null").orderBy("line_no").collect()]


def audit_file(spark: SparkSession, path: str, thresholds: audit.AuditThresholds = audit.AuditThresholds()) -> DataFrame:
    """The audit of a JSONL manifest; bad JSON fails. Each audio file is read once."""
    rows = read_manifest(spark, path, LOOSE_SCHEMA, "fail").select(F.col("line_no").cast("int").alias("manifest_line"), "text", _audio_column(path, ("audio_filepath",), resolve=False).alias("audio_filepath"))
    return audit.audit(_measured(spark, rows, "audit", thresholds), thresholds)


def _measured(spark: SparkSession, rows: DataFrame, kind: str, thresholds: audit.AuditThresholds = audit.AuditThresholds()) -> DataFrame:
    folders = [r[0] for r in rows.select(F.regexp_extract("audio_filepath", "^(.*)/[^/]*$", 1)).distinct().collect()]
    fs = corpus._Files(spark)
    there = [f for f in folders if f and fs.is_folder(f)]
    # Files are measured where they are read: only paths and metrics are shuffled, never sound. A list of paths
    # of a bounded length is broadcast to spare the other files; beyond it the folders are measured as a whole.
    files = audio.read_audio(spark, there) if there else spark.createDataFrame([], "path string, content binary")
    wanted = rows.select(F.col("audio_filepath").alias("path")).distinct()
    if wanted.count() <= MOST_LISTED:
        files = files.join(F.broadcast(wanted), "path", "left_semi")
    metrics = audio.with_metrics(files, kind, thresholds).withColumnRenamed("path", "_path")
    return rows.join(metrics, F.col("audio_filepath") == F.col("_path"), "left").drop("_path")


def audit_manifest(spark: SparkSession, path: str, out: str, thresholds: audit.AuditThresholds = audit.AuditThresholds()) -> DataFrame:
    """The audit table and its summary, without filtered manifests."""
    audit_file(spark, path, thresholds).write.mode("overwrite").parquet(f"{out}/audit.parquet")
    audited = spark.read.parquet(f"{out}/audit.parquet")
    sinks.write_audit(audited, f"{out}/audit.csv")
    _save(spark, f"{out}/summary.md", sinks.audit_markdown(audited, path, thresholds))
    return audited


def filter_file(spark: SparkSession, path: str, audit_path: str, mode: str, out: str) -> dict:
    """The lines of a manifest that an audit table selects, copied as they are; kept, total and dropped."""
    audited = read_audit(spark, audit_path)
    lines = numbered_lines(spark, path).filter(~is_blank("value"))
    kept = audit.filter_lines(lines, audited, mode)
    sinks.write_lines(kept, "value", ["line_no"], out)
    n, total = kept.count(), lines.count()
    return {"mode": mode, "kept": n, "total": total, "dropped": total - n}


def validate_layout(spark: SparkSession, folder: str) -> tuple[int, list[str]]:
    """(valid rows, errors) of an exported layout. Where files are missing, only that is reported, with no valid rows."""
    fs = corpus._Files(spark)
    there = lambda name: fs._path(f"{folder}/{name}").getFileSystem(fs.conf).exists(fs._path(f"{folder}/{name}"))
    errors = [f"missing: {name}" for name in ("metadata.csv", "config.json") if not there(name)]
    errors += [] if fs.is_folder(f"{folder}/wavs") else ["missing: wavs/ directory"]
    if errors:
        return 0, errors
    lines = numbered_lines(spark, f"{folder}/metadata.csv").filter(~is_blank("value"))
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(f"{folder}/wavs").select(file_stem("path").alias("stem"))
    bad = export.validate_metadata(lines, listed)
    found = bad.orderBy("line_no").collect()  # to be printed
    return lines.count() - len(found), [r["error"] for r in found]


def clean(spark: SparkSession, path: str, out: str, thresholds: audit.AuditThresholds = audit.AuditThresholds()) -> dict[str, dict]:
    """Audit table, summary, subset tables and the four filtered manifests, all from one audit."""
    audit_file(spark, path, thresholds).write.mode("overwrite").parquet(f"{out}/audit.parquet")
    audited = spark.read.parquet(f"{out}/audit.parquet")
    sinks.write_audit(audited, f"{out}/audit.csv")
    sinks.write_audit(audited, f"{out}/rejected_samples.csv", "reject")
    sinks.write_audit(audited, f"{out}/suspicious_samples.csv", "suspicious")
    _save(spark, f"{out}/summary.md", sinks.audit_markdown(audited, path, thresholds))
    lines = read_manifest(spark, path, LOOSE_SCHEMA, "report").select("line_no", "value")
    results = {}
    for mode, name in (("strict", "train_clean_strict"), ("balanced", "train_clean_balanced"), ("rejects", "train_rejected"), ("suspicious", "train_suspicious")):
        sinks.write_lines(audit.filter_lines(lines, audited, mode), "value", ["line_no"], f"{out}/{name}.jsonl")
        results[mode] = audit.filter_totals(audited, mode).first().asDict()
    return results


def audit_terms(spark: SparkSession, path: str, terms: Sequence[str], out: str, *, jsonl: bool = False) -> DataFrame:
    """Rows with a target term and their audio metrics, as CSV, with a markdown summary. Audio is read for matching rows only."""
    lines = read_manifest(spark, path, LOOSE_SCHEMA, "count")
    rows = lines.select("line_no", first_filled("text", "sentence", "normalized_text").alias("text"), _audio_column(path).alias("audio_filepath"), F.col("_corrupt").isNotNull().alias("bad"))
    rows = rows.withColumns({"terms": match.matched("text", terms), "chars": match.matched("text", match.TARGET_CHARACTERS)})
    some = lambda c: F.count_if(~F.col("bad") & (F.size(c) > 0))
    summary = rows.agg(F.count(F.lit(1)).alias("total rows"), some("terms").alias("rows with any target term"), some("chars").alias("rows with any target char"), some("terms").alias("extracted rows written"))
    hit = rows.filter(~F.col("bad") & (F.size("terms") > 0)).withColumns({"matched_terms": F.array_join("terms", "|"), "matched_chars": F.array_join("chars", "|")}).drop("terms", "chars", "bad")
    hit = _measured(spark, hit, "term").withColumn("chars_per_sec", F.when(F.col("duration") > 0, F.length("text") / F.col("duration")))
    numbers = ["duration", "chars_per_sec", "rms", "peak", "leading_silence_sec", "trailing_silence_sec", "internal_silence_ratio", "longest_internal_gap_sec", "internal_gap_count", "low_energy_ratio"]
    hit = hit.withColumns({c: F.bround(F.when(~F.isnan(F.col(c).cast("double")), F.col(c)), 4) for c in numbers if c != "internal_gap_count"})
    columns = ["line_no", "text", "audio_filepath", "matched_terms", "matched_chars", *numbers[:4], "sample_rate", "channels", *numbers[4:]]
    hit.select(*columns).write.mode("overwrite").parquet(f"{out}/terms.parquet")
    hit = spark.read.parquet(f"{out}/terms.parquet")
    sinks.write_csv(hit, ["line_no"], f"{out}/terms.csv")
    if jsonl:
        sinks.write_jsonl(hit.withColumn("line", F.col("line_no")), ["line_no"], f"{out}/terms.jsonl")
    good = rows.filter("not bad")
    counts = [curate.term_hits(good, t, "n") for t in (list(terms), match.TARGET_CHARACTERS)]
    _save(spark, f"{out}/summary.md", sinks.term_markdown(path, summary.first().asDict(), *counts, audit.numeric_stats(hit, numbers)))
    return hit


def _loose(spark: SparkSession, path: str) -> DataFrame:
    return read_manifest(spark, path, LOOSE_SCHEMA, "fail").select("line_no", "value", first_filled("text", "sentence", "normalized_text").alias("text"), _audio_column(path).alias("audio_filepath"))


def build_excluded(spark: SparkSession, path: str, buckets_path: str, out: str, *, mode: str = "aggressive", bucket: str = curate.BAD_BUCKET, protect: Sequence[str] = (), least: float = curate.MIN_RETENTION) -> dict:
    """The manifest without excluded rows, and a summary with the retention of protected terms."""
    rows, buckets = _loose(spark, path), read_buckets(spark, buckets_path)
    paths, lines = curate.exclusion_keys(buckets, mode, bucket)
    kept = curate.exclude_either(rows, paths, lines)
    n, m = rows.count(), kept.count()
    sinks.write_lines(kept, "value", ["line_no"], f"{out}/manifest.jsonl")
    keys = {r["key"]: r for r in curate.unmatched_keys(rows, paths, lines).collect()}
    counts = {"input_row_count": n, "excluded_row_count": n - m, "output_row_count": m}
    counts |= {f"{a}_excluded_{b}_count": keys[k][a] for a in ("matched", "unmatched") for b, k in (("audio_path", "audio_filepath"), ("line_number", "line_no"))}
    retention = curate.term_retention(rows, kept, protect, least) if protect else None
    _save(spark, f"{out}/summary.md", sinks.exclusion_markdown(counts, buckets, mode, retention, least))
    return counts | ({"retention": {r["term"]: r["retention"] for r in retention.collect()}} if protect else {})


def build_oversampled(spark: SparkSession, path: str, buckets_path: str, out: str, *, mode: str = "conservative", terms: Sequence[str] = (), exclude: Sequence[str] = (curate.BAD_BUCKET,), quality: str = "good", most_repeats: int | None = None, most_rows: int | None = None, counts_after_cap: bool = False) -> dict:
    """The manifest with target rows appended, and a summary. Term counts cover base rows that a cap drops unless counts_after_cap."""
    rows, buckets = _loose(spark, path), read_buckets(spark, buckets_path)
    eligible = ("good", "suspicious") if quality == "good_or_suspicious" else ("good",)
    flagged = curate.target_candidates(rows, buckets, terms, exclude=exclude, eligible=eligible)
    built = curate.oversample(flagged, mode, most_repeats=most_repeats, most_rows=most_rows)
    sinks.write_lines(built, "value", ["phase", "line_no", "copy"], f"{out}/manifest.jsonl")
    n, m = rows.count(), built.count()
    appended = built.filter("phase = 1")
    counted = built if counts_after_cap or mode == "target_only" else flagged.filter(~F.col("excluded")).select("text").unionByName(appended.select("text"))
    exposure = curate.term_exposure(rows, counted, terms) if terms else spark.createDataFrame([], "term string, before long, after long, exposure double")
    base = 0 if mode == "target_only" else flagged.filter("not excluded").count()
    wanted = base + flagged.filter("candidate").count() * (1 if mode == "target_only" else curate.repeats(mode, most_repeats))
    cap = most_rows if most_rows is not None and wanted > most_rows else None
    warnings = [r["warning"] for r in curate.build_warnings(exposure, n, m, cap=cap, base_rows=base).collect()]
    counts = {"mode": mode, "input_row_count": n, "excluded_row_count": flagged.filter("excluded").count(), "appended_target_rows": appended.count(), "output_row_count": m, "selected_target_rows": flagged.filter("candidate").count()}
    _save(spark, f"{out}/summary.md", sinks.oversample_markdown(counts, buckets, eligible, exposure, warnings))
    return counts | {"warnings": warnings}


def export_layout(spark: SparkSession, folder: str, out: str, *, limit: int | None = None, sample_rate: int = export.SAMPLE_RATE, language: str = export.LANGUAGE, link_audio: bool = True) -> DataFrame:
    """metadata.csv, a stem list per split, config.json and, unless told not to, wavs/ from the JSONL manifests of a folder."""
    fs = corpus._Files(spark)
    parts = [read_manifest(spark, f"{folder}/{s}.jsonl", MANIFEST_SCHEMA, "drop").withColumn("split", F.lit(s)) for s in manifest.SPLITS if fs.jvm.org.apache.hadoop.fs.Path(f"{folder}/{s}.jsonl").getFileSystem(fs.conf).exists(fs._path(f"{folder}/{s}.jsonl"))]
    if not parts:
        raise ValueError(f"no manifests in {folder}")
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    stemmed = export.unique_stems(export.cap_splits(rows, limit))
    speakers = [r["speaker"] for r in export.speaker_ids(rows).collect()]
    order = ["_o", "line_no"]
    ordered = export.metadata_lines(stemmed, len(speakers) > 1).withColumn("_o", manifest.split_order())
    sinks.write_lines(ordered, "line", order, f"{out}/metadata.csv")
    stems = export.split_stems(stemmed)
    for s in manifest.SPLITS:
        sinks.write_lines(stems.filter(F.col("split") == s), "stem", ["stem"], f"{out}/{s}.txt")
    _save(spark, f"{out}/config.json", export.layout_config(speakers, sample_rate, language))
    if link_audio:
        stemmed.select("audio_filepath", "stem").distinct().foreachPartition(export.link_files(f"{out}/wavs"))
    return stemmed
