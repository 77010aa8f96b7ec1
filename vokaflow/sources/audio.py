"""WAV files as columns: a RIFF reader, audit metrics and term-audit metrics, in Arrow batches.

PCM of 8, 16, 24 and 32 bits and 32-bit floats are read, extensible headers too; anything else is
unreadable. An unreadable file gives nulls; its row stays.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vokaflow.operators.audit import AuditThresholds

AUDIT_SCHEMA = (
    "audio_duration_sec double, sample_rate int, channels int, rms_level_db double, peak_level_db double, clipping_ratio double, "
    "leading_silence_sec double, trailing_silence_sec double, internal_silence_ratio double, longest_internal_gap_sec double"
)
TERM_SCHEMA = (
    "duration double, rms double, peak double, sample_rate int, channels int, leading_silence_sec double, trailing_silence_sec double, "
    "internal_silence_ratio double, longest_internal_gap_sec double, internal_gap_count int, low_energy_ratio double"
)
#: Term audit: window, silence relative to the loudest window, its floor, least gap.
WINDOW_MS, SILENCE_SCALE, SILENCE_FLOOR, MIN_GAP_SEC = 20, 0.03, 16, 0.08


def parse_wav(data: bytes) -> tuple[int, int, int, bool, bytes]:
    """(sample rate, channels, bytes per sample, whether floats, frames); ValueError if unreadable."""
    if len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"WAVE":
        raise ValueError("not a RIFF WAVE file")
    at, form, frames = 12, b"", None
    while at + 8 <= len(data):
        name, n = data[at : at + 4], struct.unpack("<I", data[at + 4 : at + 8])[0]
        if name == b"fmt ":
            form = data[at + 8 : at + 8 + n]
        elif name == b"data":
            frames = data[at + 8 : at + 8 + n]
            break
        at += 8 + n + n % 2
    if len(form) < 16 or frames is None:
        raise ValueError("a chunk is missing")
    tag, channels, rate, _, _, bits = struct.unpack("<HHIIHH", form[:16])
    if tag == 0xFFFE and len(form) >= 26:
        tag = struct.unpack("<H", form[24:26])[0]
    if (tag, bits) not in ((1, 8), (1, 16), (1, 24), (1, 32), (3, 32)) or not channels or not rate:
        raise ValueError("not a PCM or float format")
    width = bits // 8
    return rate, channels, width, tag == 3, frames[: len(frames) // (width * channels) * width * channels]


def _integers(frames: bytes, width: int) -> np.ndarray:
    """Signed whole samples; 8-bit samples are stored unsigned."""
    if width == 1:
        return np.frombuffer(frames, np.uint8).astype(np.int64) - 128
    if width == 3:
        b = np.frombuffer(frames, np.uint8).reshape(-1, 3).astype(np.int64)
        return ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) ^ 0x800000) - 0x800000
    return np.frombuffer(frames, f"<i{width}").astype(np.int64)


def samples(data: bytes) -> tuple[int, np.ndarray]:
    """(sample rate, float32 samples by channel)."""
    rate, channels, width, floats, frames = parse_wav(data)
    flat = np.frombuffer(frames, "<f4") if floats else (_integers(frames, width) / float(1 << (8 * width - 1))).astype(np.float32)
    return rate, flat.reshape(-1, channels)


def load_mono(data: bytes) -> tuple[np.ndarray, int]:
    """Mean over channels and the file's own rate; nothing is resampled."""
    rate, x = samples(data)
    return x.mean(axis=1), rate


def duration(data: bytes | None) -> float:
    """Seconds, 0.0 for anything unreadable."""
    try:
        rate, channels, width, _, frames = parse_wav(data or b"")
    except ValueError:
        return 0.0
    return len(frames) / (width * channels) / rate


def _db(v: float) -> float:
    return 20.0 * math.log10(v) if v > 0 else -100.0


def _runs(flags: np.ndarray) -> np.ndarray:
    """Lengths of the runs of True."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == -1) - np.flatnonzero(edges == 1)


def audit_metrics(data: bytes, t: AuditThresholds = AuditThresholds()) -> tuple:
    """The values of AUDIT_SCHEMA. A frame is silent if its peak is; frames overlap, the last ones are short."""
    rate, x = samples(data)
    mono = x.mean(axis=1) if len(x) else np.zeros(0, np.float32)
    seconds, size = len(mono) / rate, np.abs(mono)
    frame, hop = max(1, int(rate * t.silence_frame_ms / 1000.0)), max(1, int(rate * t.silence_hop_ms / 1000.0))
    starts = np.arange(0, len(mono), hop)
    # Frame peaks from hop-long pieces: a frame is some whole hops and a remainder.
    padded = np.concatenate([size, np.zeros(frame + hop, size.dtype)])
    view = np.lib.stride_tricks.sliding_window_view(padded, frame)[::hop][: len(starts)]
    silent = view.max(axis=1) <= 10 ** (t.silence_threshold_db / 20.0) if len(starts) else np.zeros(0, bool)
    loud = np.flatnonzero(~silent)
    if len(loud):
        core = silent[loud[0] : loud[-1] + 1]
        silence = (loud[0] * hop / rate, max(0.0, (len(mono) - (loud[-1] * hop + frame)) / rate), float(core.mean()), int(_runs(core).max(initial=0)) * hop / rate)
    else:
        silence = (seconds, seconds, 1.0, seconds)
    rms, peak = (float(np.sqrt(np.mean(np.square(mono)))), float(size.max())) if len(mono) else (0.0, 0.0)
    return (seconds, rate, x.shape[1], _db(rms), _db(peak), float(np.mean(size >= 0.999)) if len(mono) else 0.0, *map(float, silence))


def term_metrics(data: bytes) -> tuple:
    """The values of TERM_SCHEMA, on whole samples; silence fields are null for a file without frames."""
    rate, channels, width, floats, frames = parse_wav(data)
    if floats:
        raise ValueError("not whole samples")
    flat = _integers(frames, width)
    seconds, nothing = len(flat) / channels / rate, (None,) * 6
    if not len(flat):
        return (seconds, None, None, rate, channels, *nothing)
    mono = np.trunc(flat.reshape(-1, channels).mean(axis=1)) if channels > 1 else flat
    window = max(1, int(rate * WINDOW_MS / 1000.0))
    starts = np.arange(0, len(mono), window)
    power = np.add.reduceat(np.square(mono.astype(np.float64)), starts) / np.diff(np.append(starts, len(mono)))
    level = np.sqrt(power)
    silent = level <= max(SILENCE_FLOOR, SILENCE_SCALE * level.max())
    loud = np.flatnonzero(~silent)
    lead, trail = (int(loud[0]), len(silent) - 1 - int(loud[-1])) if len(loud) else (len(silent), len(silent))
    core = silent[lead : len(silent) - trail] if len(loud) else silent[:0]
    gaps, sec = _runs(core), window / rate
    least = max(1, math.ceil(MIN_GAP_SEC / sec))
    rms, peak = float(np.sqrt(np.mean(np.square(flat.astype(np.float64))))), float(np.abs(flat).max())
    return (seconds, rms, peak, rate, channels, lead * sec, trail * sec, float(core.mean()) if len(core) else 0.0, int(gaps.max(initial=0)) * sec, int((gaps >= least).sum()), float(silent.mean()))


def with_metrics(files: DataFrame, kind: str = "audit", thresholds: AuditThresholds = AuditThresholds()) -> DataFrame:
    """Adds the metrics to rows with a binary column content, which goes; nulls where unreadable."""
    schema = AUDIT_SCHEMA if kind == "audit" else TERM_SCHEMA
    names = [c.split()[0] for c in schema.split(", ")]
    measure = (lambda d: audit_metrics(d, thresholds)) if kind == "audit" else term_metrics
    kept = [f for f in files.schema if f.name != "content" and f.name not in names]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for data in batch["content"]:
                try:
                    rows.append(measure(data) if data is not None else (None,) * len(names))
                except (ValueError, struct.error):
                    rows.append((None,) * len(names))
            yield pd.concat([batch[[f.name for f in kept]].reset_index(drop=True), pd.DataFrame(rows, columns=names, dtype=object)], axis=1)

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return files.select(*(f.name for f in kept), "content").mapInPandas(run, f"{head}, {schema}")


def has_rate(rate: int) -> Column:
    """Whether a measured file is readable and has this sample rate."""
    return F.coalesce(F.col("sample_rate") == rate, F.lit(False))


def read_audio(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, content) of files, without the file: scheme."""
    return spark.read.format("binaryFile").load(paths).select(F.regexp_replace("path", "^file:/*", "/").alias("path"), "content")
