import hashlib
import struct
import zlib

import numpy as np
import pytest

from vokaflow.llm import queries
from vokaflow.llm import telephony as t

SF = "/root/testdata/sf0.001"


def test_tables_at_known_codes():
    mu, a = t.EXPAND["mulaw"], t.EXPAND["alaw"]
    assert [mu[x] for x in (0x00, 0x7F, 0x80, 0xFF, 0xF0)] == [-32124, 0, 32124, 0, 120]
    assert [a[x] for x in (0x55, 0xD5, 0x2A, 0xAA)] == [-8, 8, -32256, 32256]
    for table in (mu, a):
        assert sorted(table[128:].tolist()) == sorted((-table[:128]).tolist())


def one_block(block):
    value, index = struct.unpack("<hB", block[:3])
    out = [value]
    for byte in block[4:]:
        for code in (byte & 15, byte >> 4):
            step = t.STEPS[index]
            change = step >> 3
            if code & 4:
                change += step
            if code & 2:
                change += step >> 1
            if code & 1:
                change += step >> 2
            value = max(-32768, min(32767, value - change if code & 8 else value + change))
            index = max(0, min(88, index + t.INDEX_STEP[code & 7]))
            out.append(value)
    return out


def test_adpcm_across_blocks_equals_one_by_one():
    rng = np.random.default_rng(2)
    blocks = rng.integers(0, 256, (40, 36)).astype(np.uint8)
    blocks[:, 2] %= 89
    assert t.decode_adpcm(blocks).tolist() == [one_block(b.tobytes()) for b in blocks]


@pytest.mark.parametrize("codec", t.CODECS)
def test_round_trip(codec):
    payload = np.random.default_rng(1).integers(0, 256, 640).astype(np.uint8).tobytes()
    found, rate, data = t.unwrap(t.wrap(payload, codec))
    assert (found, rate, t.payload_of(found, data)) == (codec, 8000, payload)
    for broken in (b"", t.wrap(payload, codec)[:-3], b"X" + t.wrap(payload, codec)[1:], t.wrap(payload, codec).replace(b"data", b"tada")):
        with pytest.raises(ValueError):
            t.unwrap(broken)


def test_resample():
    assert t.resample(np.array([0, 100, -100], np.int16), 8000, 16000).tolist() == [0, 50, 100, 0, -100, -100]
    assert t.resample(np.arange(8, dtype=np.int16), 16000, 8000).tolist() == [0, 2, 4, 6]  # too short for the filter


def plain_samples(codec, payload):
    """Codes to samples one by one, by the definitions of the laws."""
    if codec == "adpcm":
        return [x for i in range(0, len(payload), 64) for x in one_block(bytes(4) + payload[i : i + 64])]
    out = []
    for code in payload:
        if codec == "mulaw":
            code ^= 0xFF
            size = ((2 * (code & 15) + 33) << ((code >> 4) & 7)) - 33
            out.append(-4 * size if code & 128 else 4 * size)
        else:
            code ^= 0x55
            part, low = (code >> 4) & 7, 2 * (code & 15) + 1
            size = low if part == 0 else (low + 32) << (part - 1)
            out.append(8 * size if code & 128 else -8 * size)
    return out


def test_features_of_resampled_samples_by_hand():
    rng = np.random.default_rng(4)
    for codec in t.CODECS:
        payload = rng.integers(0, 256, 256).astype(np.uint8).tobytes()
        own = plain_samples(codec, payload)
        twice = [x for a, b in zip(own, [*own[1:], own[-1]], strict=True) for x in (a, round((a + b) / 2))]
        signs = sum((a < 0) != (b < 0) for a, b in zip(twice, twice[1:], strict=False))
        want = f"{codec},8000,{len(twice)},{max(map(abs, twice))},{sum(x * x for x in twice) // len(twice)},{sum(twice) // len(twice)},{signs}"
        found, rate, data = t.unwrap(t.wrap(payload, codec))
        pcm = t.resample(t._decode_all([(found, rate, data)])[0], rate, 16000)
        assert pcm.tolist() == twice and t.features(codec, rate, pcm) == want


def test_a_lower_rate_drops_what_it_cannot_hold():
    at = np.arange(16000) / 16000
    tone = lambda hz: (10_000 * np.sin(2 * np.pi * hz * at)).astype(np.int16)
    level = lambda pcm: float(np.sqrt(np.mean(pcm[200:-200].astype(float) ** 2)))
    assert level(t.resample(tone(7000), 16000, 8000)) < 0.01 * level(tone(7000))
    assert abs(level(t.resample(tone(1000), 16000, 8000)) / level(tone(1000)) - 1) < 0.02


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    seen = {}
    for r in queries.op6_telephony_media(spark, SF).collect():
        raw = (docs[r["doc_id"]] or "").encode()
        payload = raw.ljust(max(64, -(-len(raw) // 64) * 64), b"\0")
        media = t.wrap(payload, t.CODECS[zlib.crc32(raw) % 3])
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r["media_bytes"], r["media_sha256"]) == (len(media), hashlib.sha256(media).hexdigest())
        codec, rate, data = t.unwrap(media)
        pcm = t.resample(t._decode_all([(codec, rate, data)])[0], rate, 16000)
        assert (r["pcm_bytes"], r["pcm_sha256"]) == (2 * len(pcm), hashlib.sha256(pcm.astype("<i2").tobytes()).hexdigest())
        seen[r["feature"].split(",")[0]] = seen.get(r["feature"].split(",")[0], 0) + 1
    assert set(seen) == set(t.CODECS)


def test_rows(spark):
    texts = [None, "", "a" * 64, "é" * 33, "x" * 3_000_000, "a" * 64]
    df = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(texts)] + [(1, "", "clash")], "doc_id long, text string, media string")
    got = sorted(t.decode_media(t.store_texts(df)).collect(), key=lambda r: r["doc_id"])
    assert len(got) == 7 and all(r["error"] is None for r in got)
    for r in got:
        assert r["payload"][: r["n_bytes"]] == (texts[r["doc_id"]] or "").encode() and len(r["payload"]) % 64 == 0 and len(r["payload"]) >= 64
        assert len(r["pcm"]) // 2 == int(r["feature"].split(",")[2])
    bad = t.decode_media(spark.createDataFrame([(1, b"RIFFxxxx"), (2, None)], "doc_id long, media binary")).collect()
    assert all(r["error"] and r["payload"] is None for r in bad)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert t.decode_media(t.store_texts(none)).count() == 0
