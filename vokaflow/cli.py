"""Commands: normalize, phonemize, prepare, validate, audit, clean, filter, terms, exclude, oversample, export, validate-export."""

from __future__ import annotations

import argparse
import sys
from dataclasses import fields

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vokaflow.functions.match import parse_terms, repaired
from vokaflow.functions.normalize import normalize_text
from vokaflow.functions.phonemes import text_to_phonemes
from vokaflow.operators.audit import AuditThresholds
from vokaflow.operators.curate import BUILD_MODES, EXCLUSION_MODES, MIN_RETENTION
from vokaflow.operators.export import LANGUAGE, SAMPLE_RATE
from vokaflow.operators.manifest import MAX_DURATION, MIN_DURATION
from vokaflow.plans import workflows


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="vokaflow", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, *positional: str) -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        for x in positional:
            p.add_argument(x)
        return p

    add("normalize", "text")
    add("phonemize", "text")
    add("prepare", "folder", "out")
    p = add("validate", "manifest")
    p.add_argument("--skip-audio", action="store_true")
    p.add_argument("--min-duration", type=float, default=MIN_DURATION)
    p.add_argument("--max-duration", type=float, default=MAX_DURATION)
    for command in ("audit", "clean"):
        p = add(command, "manifest", "out")
        for f in fields(AuditThresholds):
            p.add_argument("--" + f.name.replace("_", "-"), type=type(f.default), default=f.default)
    p = add("filter", "manifest", "audit", "out")
    p.add_argument("--mode", choices=("strict", "balanced", "rejects", "suspicious"), required=True)
    p = add("terms", "manifest", "out")
    p.add_argument("--terms", required=True)
    p.add_argument("--jsonl", action="store_true")
    p = add("exclude", "manifest", "buckets", "out")
    p.add_argument("--mode", choices=EXCLUSION_MODES, default=EXCLUSION_MODES[0])
    p.add_argument("--protect-terms", default="")
    p.add_argument("--min-protected-retention", type=float, default=MIN_RETENTION)
    p = add("oversample", "manifest", "buckets", "out")
    p.add_argument("--mode", choices=tuple(BUILD_MODES), default="conservative")
    p.add_argument("--target-terms", default="")
    p.add_argument("--min-target-quality", choices=("good", "good_or_suspicious"), default="good")
    p.add_argument("--max-target-repeat", type=int)
    p.add_argument("--max-output-rows", type=int)
    p = add("export", "folder", "out")
    p.add_argument("--limit", type=int)
    p.add_argument("--sample-rate", type=int, default=SAMPLE_RATE)
    p.add_argument("--language", default=LANGUAGE)
    p.add_argument("--no-audio", action="store_true")
    add("validate-export", "folder")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("vokaflow").getOrCreate()
    if a.command in ("normalize", "phonemize"):
        function = normalize_text if a.command == "normalize" else text_to_phonemes
        print(spark.createDataFrame([(repaired(a.text),)], "t string").select(function(F.col("t"))).first()[0])
    elif a.command == "prepare":
        print(f"{workflows.prepare(spark, a.folder, a.out).count()} rows")
    elif a.command == "validate":
        valid, errors = workflows.validate_file(spark, a.manifest, check_audio=not a.skip_audio, min_duration=a.min_duration, max_duration=a.max_duration)
        print("\n".join([*errors, f"{valid} valid, {len(errors)} errors"]))
        return int(bool(errors))
    elif a.command == "clean":
        for r in workflows.clean(spark, a.manifest, a.out, AuditThresholds(**{f.name: getattr(a, f.name) for f in fields(AuditThresholds)})).values():
            print(r)
    elif a.command == "audit":
        print(f"{workflows.audit_manifest(spark, a.manifest, a.out, AuditThresholds(**{f.name: getattr(a, f.name) for f in fields(AuditThresholds)})).count()} rows")
    elif a.command == "filter":
        print(workflows.filter_file(spark, a.manifest, a.audit, a.mode, a.out))
    elif a.command == "validate-export":
        valid, errors = workflows.validate_layout(spark, a.folder)
        print("\n".join([*errors, f"{valid} valid, {len(errors)} errors"]))
        return int(bool(errors))
    elif a.command == "terms":
        print(f"{workflows.audit_terms(spark, a.manifest, parse_terms(a.terms, required=True), a.out, jsonl=a.jsonl).count()} rows")
    elif a.command == "exclude":
        print(workflows.build_excluded(spark, a.manifest, a.buckets, a.out, mode=a.mode, protect=parse_terms(a.protect_terms), least=a.min_protected_retention))
    elif a.command == "oversample":
        print(workflows.build_oversampled(spark, a.manifest, a.buckets, a.out, mode=a.mode, terms=parse_terms(a.target_terms), quality=a.min_target_quality, most_repeats=a.max_target_repeat, most_rows=a.max_output_rows))
    elif a.command == "export":
        workflows.export_layout(spark, a.folder, a.out, limit=a.limit, sample_rate=a.sample_rate, language=a.language, link_audio=not a.no_audio)
    return 0


if __name__ == "__main__":
    sys.exit(main())
