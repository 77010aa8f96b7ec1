"""Telephony audio as media columns: mu-law, A-law and IMA ADPCM in RIFF files, resampled PCM.

The two logarithmic laws expand by a table of 256 samples. ADPCM is a chain of steps within a
block but blocks are independent, so numpy decodes one code of all blocks at a time. Everything is
checked on read: a file that is cut or of another kind gives an error, not samples.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Format tags of RIFF WAVE files.
TAGS = {"alaw": 6, "mulaw": 7, "adpcm": 0x11}
CODECS = ("mulaw", "alaw", "adpcm")
RATE, RESAMPLED = 8000, 16000
#: Taps of the filter before a lower rate.
TAPS = 127
#: Bytes of codes in an ADPCM block; its header has four more.
BLOCK = 64

#: How a code moves the step index.
INDEX_STEP = (-1, -1, -1, -1, 2, 4, 6, 8)
#: The step sizes of IMA ADPCM.
STEPS = (
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337,
    371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484,
    7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
)


def _mulaw_table() -> np.ndarray:
    code = ~np.arange(256, dtype=np.int32) & 0xFF
    size = (((code & 15) << 3) + 132 << ((code >> 4) & 7)) - 132
    return np.where(code & 128, -size, size).astype(np.int16)


def _alaw_table() -> np.ndarray:
    code = np.arange(256, dtype=np.int32) ^ 0x55
    segment, low = (code >> 4) & 7, (code & 15) << 4
    size = np.where(segment == 0, low + 8, (low + 264) << np.maximum(segment - 1, 0))
    return np.where(code & 128, size, -size).astype(np.int16)


EXPAND = {"mulaw": _mulaw_table(), "alaw": _alaw_table()}


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """(blocks, header and code bytes) to (blocks, samples): the header's sample, then one per code, low half first."""
    head = np.ascontiguousarray(blocks[:, :4])
    value = head[:, :2].view("<i2")[:, 0].astype(np.int32)
    index = np.minimum(head[:, 2].astype(np.int32), 88)
    codes = np.stack([blocks[:, 4:] & 15, blocks[:, 4:] >> 4], axis=2).reshape(len(blocks), -1)
    steps, moves = np.array(STEPS, np.int32), np.array(INDEX_STEP * 2, np.int32)
    out = np.empty((codes.shape[1] + 1, len(blocks)), np.int16)
    out[0] = value
    for k, code in enumerate(np.ascontiguousarray(codes.T), 1):
        step = steps[index]
        change = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
        value = np.clip(value + np.where(code & 8, -change, change), -32768, 32767)
        index = np.clip(index + moves[code], 0, 88)
        out[k] = value
    return out.T


def wrap(payload: bytes, codec: str, rate: int = RATE) -> bytes:
    """A mono RIFF WAVE file whose coded samples are the payload, untouched. For adpcm its length is a multiple of BLOCK."""
    data, align, bits, extra = payload, 1, 8, b""
    if codec == "adpcm":
        body = np.frombuffer(payload, np.uint8).reshape(-1, BLOCK)
        data = np.concatenate([np.zeros((len(body), 4), np.uint8), body], axis=1).tobytes()
        align, bits, extra = BLOCK + 4, 4, struct.pack("<H", 2 * BLOCK + 1)
    per_second = rate if codec != "adpcm" else rate * align // (2 * BLOCK + 1)
    samples = len(payload) if codec != "adpcm" else len(data) // align * (2 * BLOCK + 1)
    form = struct.pack("<HHIIHHH", TAGS[codec], 1, rate, per_second, align, bits, len(extra)) + extra
    chunks = b"fmt " + struct.pack("<I", len(form)) + form + b"fact" + struct.pack("<II", 4, samples) + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", 4 + len(chunks)) + b"WAVE" + chunks


def unwrap(media: bytes) -> tuple[str, int, np.ndarray]:
    """(codec, rate, coded data: bytes, or a row per ADPCM block) of a file; ValueError if it isn't one of ours."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE" or len(media) < struct.unpack("<I", media[4:8])[0] + 8:
        raise ValueError("not a whole RIFF WAVE file")
    at, form, data = 12, b"", None
    while at + 8 <= len(media):
        name, n = media[at : at + 4], struct.unpack("<I", media[at + 4 : at + 8])[0]
        if at + 8 + n > len(media):
            raise ValueError("a chunk is cut")
        if name == b"fmt ":
            form = media[at + 8 : at + 8 + n]
        elif name == b"data":
            data = np.frombuffer(media, np.uint8, n, at + 8)
        at += 8 + n + n % 2
    if len(form) < 16 or data is None:
        raise ValueError("a chunk is missing")
    tag, channels, rate, _, align, _ = struct.unpack("<HHIIHH", form[:16])
    codec = {v: k for k, v in TAGS.items()}.get(tag)
    if codec is None or channels != 1 or not rate or (codec == "adpcm" and (align <= 4 or len(data) % align)):
        raise ValueError("not mono mu-law, A-law or IMA ADPCM")
    return codec, rate, data.reshape(-1, align) if codec == "adpcm" else data


def payload_of(codec: str, data: np.ndarray) -> bytes:
    return (data[:, 4:] if codec == "adpcm" else data).tobytes()


def low_pass(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """The samples without what the lower rate ``to`` can't hold: a sinc of TAPS taps under a Hamming window."""
    cut = 0.45 * to / rate
    at = np.arange(TAPS) - TAPS // 2
    taps = 2 * cut * np.sinc(2 * cut * at) * np.hamming(TAPS)
    return np.convolve(pcm.astype(np.float64), taps / taps.sum(), "same") if len(pcm) >= TAPS else pcm


def resample(pcm: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation between neighbours, after a low-pass on the way down; the same samples for an equal rate."""
    if rate == to or not len(pcm):
        return pcm
    if to < rate:
        pcm = low_pass(pcm, rate, to)
    at = np.arange(int(len(pcm) * to // rate), dtype=np.float64) * (rate / to)
    low = at.astype(np.int64)
    high = np.minimum(low + 1, len(pcm) - 1)
    part = at - low
    return np.clip(np.rint(pcm[low] * (1 - part) + pcm[high] * part), -32768, 32767).astype(np.int16)


def features(codec: str, rate: int, pcm: np.ndarray) -> str:
    """codec, rate, samples, peak, mean square, mean and sign changes, in whole numbers."""
    wide = pcm.astype(np.int64)
    signs = int(np.count_nonzero((pcm[1:] < 0) != (pcm[:-1] < 0)))
    n = max(1, len(pcm))
    return f"{codec},{rate},{len(pcm)},{int(np.abs(wide).max(initial=0))},{int((wide * wide).sum()) // n},{int(wide.sum()) // n},{signs}"


def _decode_all(parts: Sequence[tuple[str, int, np.ndarray]]) -> list[np.ndarray]:
    """The samples of each file; the ADPCM blocks of all files with one block size go through together."""
    out: list[np.ndarray | None] = [EXPAND[c][d] if c in EXPAND else None for c, _, d in parts]
    for align in {d.shape[1] for c, _, d in parts if c == "adpcm"}:
        own = [i for i, (c, _, d) in enumerate(parts) if c == "adpcm" and d.shape[1] == align]
        samples = decode_adpcm(np.concatenate([parts[i][2] for i in own]))
        ends = np.cumsum([len(parts[i][2]) for i in own])
        for i, part in zip(own, np.split(samples, ends[:-1]), strict=True):
            out[i] = part.reshape(-1)
    return out


_SCHEMA = "codec string, rate int, payload binary, pcm binary, feature string, error string"
_NAMES = ["codec", "rate", "payload", "pcm", "feature", "error"]


def _read(keep_pcm: bool, rate: int):
    def flush(rows: list, keys: pa.RecordBatch) -> pa.RecordBatch:
        good = [r for r in rows if isinstance(r, tuple)]
        pcm = iter(_decode_all(good))
        out = []
        for r in rows:
            if isinstance(r, str):
                out.append((None, None, None, None, None, r))
            else:
                codec, own, data = r
                samples = resample(next(pcm), own, rate)
                out.append((codec, own, payload_of(codec, data), samples.astype("<i2").tobytes() if keep_pcm else None, features(codec, rate, samples), None))
        types = (pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([*keys.columns, *(pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True))], [*keys.schema.names, *_NAMES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows, size = 0, [], 0
            media = batch.schema.get_field_index("media")
            for i, m in enumerate(batch.column(media)):
                data = m.as_py()
                try:
                    rows.append(unwrap(data) if data is not None else "no media")
                except ValueError as e:
                    rows.append(str(e))
                size += len(data or b"")
                if size > 2_000_000 or i + 1 == batch.num_rows:
                    yield flush(rows, batch.slice(at, i + 1 - at))
                    at, rows, size = i + 1, [], 0

    return run


def decode_media(rows: DataFrame, *, keep_pcm: bool = True, rate: int = RESAMPLED) -> DataFrame:
    """Adds codec, rate, payload, pcm (16 bit, little-endian, resampled to ``rate``), feature and
    error to rows with a binary column media.

    An unreadable or null file gets an error and nulls, its row stays. pcm is null unless kept.
    Repeated rows stay repeated, files of any length are read whole, other columns pass, those of the new names are replaced; no rows give no rows.
    """
    own = rows.select(*(c for c in rows.columns if c not in _NAMES))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema)
    return own.mapInArrow(_read(keep_pcm, rate), f"{kinds}, {_SCHEMA}")


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, out, size = 0, [], 0
        for i, t in enumerate(batch.column(batch.num_columns - 1)):
            raw = t.as_py()
            payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
            out.append((len(raw), wrap(payload, CODECS[zlib.crc32(raw) % len(CODECS)])))
            size += len(payload)
            if size > 4_000_000 or i + 1 == batch.num_rows:
                n, media = zip(*out, strict=True)
                part = batch.slice(at, i + 1 - at)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(n, pa.int64()), pa.array(media, pa.binary())], [*part.schema.names[:-1], "n_bytes", "media"])
                at, out, size = i + 1, [], 0


def store_texts(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, media): each text's UTF-8 bytes, zero-padded to a positive multiple of 64, as coded samples.

    The codec follows from the bytes, so equal texts make equal files. A null text is empty; repeated rows make
    equal rows; texts of any length go in whole; other columns are not read; no rows give no rows.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    slim = docs.select(F.col(id_column).alias("key"), F.coalesce(text_column, F.lit("")).cast("binary").alias("raw"))
    return slim.mapInArrow(_store, f"key {kind}, n_bytes long, media binary").withColumnRenamed("key", id_column)
