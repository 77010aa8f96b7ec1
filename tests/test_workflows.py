"""End-to-end runs on small folders made at test time."""

import glob
import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from vokaflow import cli
from vokaflow.operators import audit, curate, export, manifest
from vokaflow.plans import workflows
from vokaflow.sources import audio, corpus
from vokaflow.sources import manifest as source


def wav(path, pcm, rate=22050, channels=1):
    data = np.asarray(pcm, "<i2").tobytes()
    head = struct.pack("<HHIIHH", 1, channels, rate, rate * 2 * channels, 2 * channels, 16)
    body = b"WAVEfmt " + struct.pack("<I", 16) + head + b"data" + struct.pack("<I", len(data)) + data
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(b"RIFF" + struct.pack("<I", len(body)) + body)


def tone(seconds, lead=0.0, rate=22050):
    t = np.arange(int(seconds * rate)) / rate
    return np.concatenate([np.zeros(int(lead * rate)), 0.2 * 32767 * np.sin(2 * np.pi * 220 * t)])


def pattern(levels, rate=16000):
    return np.concatenate([np.full(int(rate * 0.02), v) for v in levels])


def lines(folder):
    return [x for f in sorted(glob.glob(f"{folder}/part-*")) for x in open(f, encoding="utf-8").read().split("\n")[:-1]]


def jsonl(path, rows):
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n" for r in rows), encoding="utf-8")
    return str(path)


@pytest.fixture(scope="module")
def prepared(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("corpus")
    data = {"Train": [("Bugün hava çok güzel.", 2.0), ("Türkiye güzel bir ülkedir.", 1.8), ("Çocuklar bahçede oynuyor.", 1.5), ("Kısa", 0.3), ("", 1.0), (None, 1.0), ("Uzun", 25.0)], "Dev": [("Merhaba dünya.", 1.2)], "Test": [("İyi günler.", 1.1)]}
    for split, rows in data.items():
        for i, (text, seconds) in enumerate(rows):
            wav(top / "inner" / split / f"{100000 + i}.wav", np.zeros(int(seconds * 22050)))
            if text is not None:
                (top / "inner" / split / f"{100000 + i}.txt").write_text(text + "\n", encoding="utf-8")
    (top / "inner" / "Train" / "bad.wav").write_text("no audio")
    (top / "inner" / "Train" / "bad.txt").write_text("text")
    out = str(tmp_path_factory.mktemp("out"))
    return out, workflows.prepare(spark, str(top), out)


def test_prepare(spark, prepared):
    out, rows = prepared
    got = {(r["split"], r["stem"]): r for r in rows.collect()}
    assert len(got) == 5 and got["train", "100000"]["phonemes"].startswith("b u j") is False
    assert got["train", "100000"]["phonemes"] == "b u g y n _ h a v a _ tʃ o k _ g y z e l ~" and got["val", "100000"]["duration"] == 1.2
    stats = json.load(open(f"{out}/stats.json"))
    assert stats["total_count"] == 5 and stats["filtered_count"] == 5 and stats["splits"] == {"train": 3, "val": 1, "test": 1}
    symbols = open(f"{out}/symbols.txt", encoding="utf-8").read().split()
    assert symbols == sorted(symbols) and "tʃ" in symbols
    first = json.loads(lines(f"{out}/train.jsonl")[0])
    assert set(first) == set(manifest.REQUIRED)
    with pytest.raises(ValueError):
        corpus.read_corpus(spark, "/nowhere")


def test_validate(spark, prepared, tmp_path):
    out, _ = prepared
    good = [json.loads(x) for x in lines(f"{out}/train.jsonl")]
    assert workflows.validate_file(spark, jsonl(tmp_path / "ok.jsonl", good)) == (3, [])
    bad = [dict(good[0]), {k: v for k, v in good[0].items() if k not in ("phonemes", "speaker_id")}, "", "not json", good[0] | {"audio_filepath": "/no/a.wav"}, good[0] | {"duration": 0.1}, good[0] | {"text": "  "}, good[0] | {"phonemes": ""}]
    valid, errors = workflows.validate_file(spark, jsonl(tmp_path / "bad.jsonl", bad))
    assert valid == 1 and [e.split(":")[0] for e in errors] == [f"line {i}" for i in (2, 4, 5, 6, 7, 8)]
    for e, part in zip(errors, ("['phonemes', 'speaker_id']", "JSON", "not found", "duration 0.100s outside [0.5, 20.0]", "text", "phonemes"), strict=True):
        assert part in e
    assert cli.main(["validate", str(tmp_path / "bad.jsonl"), "--skip-audio"], spark) == 1


def test_clean(spark, tmp_path):
    for name, pcm in (("a", tone(2.0)), ("b", tone(2.0, 0.6)), ("c", tone(0.4))):
        wav(tmp_path / f"{name}.wav", pcm)
    (tmp_path / "d.wav").write_text("x")
    rows = [{"audio_filepath": "a.wav", "text": "Yirmi bir karakterli."}, "", {"audio_filepath": "b.wav", "text": "Yirmi bir karakterli."}, {"audio_filepath": "c.wav", "text": "Kısa."}, {"audio_filepath": "d.wav", "text": "bozuk"}]
    path, out = jsonl(tmp_path / "m.jsonl", rows), str(tmp_path / "out")
    got = workflows.clean(spark, path, out)
    assert {m: (r["kept"], r["total"]) for m, r in got.items()} == {"strict": (1, 4), "balanced": (2, 4), "rejects": (2, 4), "suspicious": (1, 4)}
    assert lines(f"{out}/train_clean_strict.jsonl") == [json.dumps(rows[0], ensure_ascii=False)]
    table = {r["manifest_line"]: r for r in source.read_audit(spark, f"{out}/audit.csv").collect()}
    assert {k: r["status"] for k, r in table.items()} == {1: "keep", 3: "suspicious", 4: "reject", 5: "reject"}
    assert table[3]["reasons"] == ["leading_silence_too_high"] and table[5]["reasons"] == ["audio_unreadable"] and table[5]["quality_score"] == 0
    assert table[1]["audio_duration_sec"] == 2.0 and abs(table[3]["leading_silence_sec"] - 0.6) < 0.02
    assert "- Reject: 2" in open(f"{out}/summary.md").read()
    with pytest.raises(Exception, match="line 2"):
        workflows.audit_file(spark, jsonl(tmp_path / "x.jsonl", [rows[0], "oops"])).collect()
    with pytest.raises(ValueError):
        audit.mode_filter("none")


def frames_one_by_one(mono, rate):
    """Audit silence by a plain loop."""
    flags = [np.abs(mono[s : s + int(rate * 0.02)]).max() <= 10**-2 for s in range(0, len(mono), int(rate * 0.01))]
    loud = [i for i, f in enumerate(flags) if not f]
    if not loud:
        return (len(mono) / rate,) * 2 + (1.0, len(mono) / rate)
    core, longest, run = flags[loud[0] : loud[-1] + 1], 0, 0
    for f in core:
        run = run + 1 if f else 0
        longest = max(longest, run)
    tail = max(0.0, (len(mono) - (loud[-1] * int(rate * 0.01) + int(rate * 0.02))) / rate)
    return loud[0] * int(rate * 0.01) / rate, tail, sum(core) / len(core), longest * int(rate * 0.01) / rate


def test_audit_metrics_equal_a_loop(tmp_path):
    rng = np.random.default_rng(0)
    for k in range(12):
        pcm = np.concatenate([rng.integers(-1, 1, rng.integers(0, 3000)) if i % 2 else rng.integers(-9000, 9000, rng.integers(1, 2500)) for i in range(k)] + [np.zeros(50 * (k % 3) + 1)])
        wav(tmp_path / "x.wav", pcm, 8000)
        got = audio.audit_metrics((tmp_path / "x.wav").read_bytes())
        assert got[6:] == pytest.approx(frames_one_by_one(np.asarray(pcm, np.float32) / 32768, 8000))


def test_wav_kinds(tmp_path):
    wav(tmp_path / "s.wav", [100, -101, 200, 300], channels=2)
    assert audio.load_mono((tmp_path / "s.wav").read_bytes())[0] * 32768 == pytest.approx([-0.5, 250])
    assert audio.duration(b"RIFF") == 0.0 and audio.duration(None) == 0.0
    for bits, tag, data, want in ((8, 1, bytes([0, 128, 255]), [-1, 0, 127 / 128]), (24, 1, b"\x00\x00\x80\x01\x00\x00", [-1, 2**-23]), (32, 3, struct.pack("<2f", 0.5, -2), [0.5, -2])):
        body = b"WAVEfmt " + struct.pack("<IHHIIHH", 16, tag, 1, 8000, 8000 * bits // 8, bits // 8, bits) + b"data" + struct.pack("<I", len(data)) + data
        assert audio.samples(b"RIFF" + struct.pack("<I", len(body)) + body)[1].ravel().tolist() == pytest.approx(want)


def test_terms(spark, tmp_path):
    for name, levels in (("a", [2000] * 5), ("b", [0, 0, 3000, 3000, 0, 0]), ("c", [3200, 3200, 0, 0, 0, 0, 0, 3200, 3200]), ("z", [0] * 5)):
        wav(tmp_path / f"{name}.wav", pattern(levels), 16000)
    rows = [{"sentence": "Çocuklar", "text": "", "audio": "a.wav"}, {"text": "çiçek ve çocuklar", "wav": "b.wav"}, "{bad", {"normalized_text": "öğrenciler", "path": str(tmp_path / "c.wav")}, {"text": "plain", "audio": "a.wav"}, {"text": "çocuklar"}, {"text": "çocuklar", "audio": "z.wav"}]
    got = {r["line_no"]: r for r in workflows.audit_terms(spark, jsonl(tmp_path / "m.jsonl", rows), ["çocuklar", "öğrenci", "çiçek"], str(tmp_path / "out")).collect()}
    assert sorted(got) == [1, 2, 4, 6, 7] and got[2]["matched_terms"] == "çocuklar|çiçek" and got[1]["duration"] == 0.1
    assert (got[2]["leading_silence_sec"], got[2]["trailing_silence_sec"], got[2]["internal_gap_count"]) == (0.04, 0.04, 0)
    assert (got[4]["longest_internal_gap_sec"], got[4]["internal_gap_count"]) == (0.1, 1) and got[4]["internal_silence_ratio"] == pytest.approx(5 / 9, abs=1e-4)
    assert got[6]["duration"] is None and (got[7]["low_energy_ratio"], got[7]["internal_silence_ratio"]) == (1.0, 0.0)
    summary = open(tmp_path / "out" / "summary.md", encoding="utf-8").read()
    assert "- total rows: 7" in summary and "- çocuklar: 4" in summary and "- ç: 4" in summary


BUCKET_HEAD = "line_no,audio_filepath,bucket,matched_terms,bucket_reasons,longest_internal_gap_sec,internal_gap_count,internal_silence_ratio,low_energy_ratio\n"


@pytest.mark.parametrize(("mode", "kept"), [("aggressive", [1, 2, 6]), ("relaxed", [1, 2, 3, 6]), ("hard", [1, 2, 3, 4, 6])])
def test_exclusion(spark, tmp_path, mode, kept):
    texts = ["alpha non target", "çocuklar iyi satir", "çiçek hafif gap satir", "öğrenciler siddetli gap satir", "şeker clip satir", "beta non target"]
    rows = [{"text": t, "audio_filepath": f"/a/{i}.wav"} for i, t in enumerate(texts, 1)]
    b = ["2,/a/2.wav,good,,,,,,", "3.0,,bad_or_reject_like,,longest_internal_gap_too_high|internal_gap_count_too_high,0.46,3,,", "x,/a/4.wav,bad_or_reject_like,,longest_internal_gap_too_high,0.90,6,,", "5,/a/9.wav,bad_or_reject_like,,peak_near_clip|peak_near_clip,,,,"]
    (tmp_path / "b.csv").write_text(BUCKET_HEAD + "\n".join(b) + "\n", encoding="utf-8")
    got = workflows.build_excluded(spark, jsonl(tmp_path / "m.jsonl", rows), str(tmp_path / "b.csv"), str(tmp_path / "out"), mode=mode, protect=["çocuklar", "çiçek", "yok"])
    assert lines(tmp_path / "out" / "manifest.jsonl") == [json.dumps(rows[i - 1], ensure_ascii=False) for i in kept]
    assert got["output_row_count"] == len(kept) and got["retention"] == {"çocuklar": 1.0, "çiçek": float(3 in kept), "yok": 1.0}
    assert got["unmatched_excluded_audio_path_count"] == 1
    assert ("WARNING" in open(tmp_path / "out" / "summary.md").read()) == (mode == "aggressive")


def test_oversampling(spark, tmp_path):
    rows = [{"text": "alpha", "audio_filepath": "/a/1.wav"}, {"text": "çocuklar bir", "audio_filepath": "/a/2.wav"}, {"text": "çocuklar iki", "audio_filepath": "/a/3.wav"}, {"text": "çocuklar kötü", "audio_filepath": "/a/4.wav"}, {"text": "çocuklar yolsuz"}, {"text": "beta", "audio_filepath": "/a/6.wav"}]
    b = ["9,/a/2.wav,good,", "9,/a/3.wav, suspicious ,", "1,/a/4.wav,bad_or_reject_like,", "5,,good,", "6,,bad_or_reject_like,"]
    (tmp_path / "b.csv").write_text("line_no,audio_filepath,bucket,matched_terms\n" + "\n".join(b) + "\n", encoding="utf-8")
    path = jsonl(tmp_path / "m.jsonl", rows)

    def run(**k):
        got = workflows.build_oversampled(spark, path, str(tmp_path / "b.csv"), str(tmp_path / "out"), terms=["çocuklar", "absent"], **k)
        return [json.loads(x)["text"] for x in lines(tmp_path / "out" / "manifest.jsonl")], got

    base = ["alpha", "çocuklar bir", "çocuklar iki", "çocuklar yolsuz", "beta"]
    assert run()[0] == base + ["çocuklar bir", "çocuklar yolsuz"]
    assert run(mode="weighted")[0] == base + ["çocuklar bir"] * 2 + ["çocuklar yolsuz"] * 2
    assert run(mode="weighted", most_repeats=1)[0] == run()[0] and run(mode="weighted", most_repeats=0)[0] == base
    assert run(mode="target_only")[0] == ["çocuklar bir", "çocuklar yolsuz"]
    assert run(quality="good_or_suspicious")[0] == base + ["çocuklar bir", "çocuklar iki", "çocuklar yolsuz"]
    text, got = run(mode="weighted", most_rows=6)
    assert text == base + ["çocuklar bir"] and any("appending target rows: 6" in w for w in got["warnings"])
    assert any("absent from base manifest: absent" in w for w in got["warnings"])
    assert any("writing base rows: 3" in w for w in run(most_rows=3)[1]["warnings"])
    with pytest.raises(ValueError):
        curate.repeats("none")


def test_export(spark, tmp_path):
    rows = lambda s, n: [{"audio_filepath": f"/{s}/utt_{i:04}.wav", "text": f"Örnek metin {i}.", "normalized_text": "", "phonemes": "a", "duration": 1.5, "speaker_id": "spk_b" if i % 2 else "spk_a"} for i in range(n)]
    for s, n in (("train", 8), ("val", 35), ("test", 3)):
        jsonl(tmp_path / f"{s}.jsonl", rows(s, n) + ["{bad"])
    got = workflows.export_layout(spark, str(tmp_path), str(tmp_path / "all"))
    assert got.count() == 46
    meta = lines(tmp_path / "all" / "metadata.csv")
    assert meta[0] == "utt_0000|spk_a|Örnek metin 0." and meta[8] == "utt_0000_2|spk_a|Örnek metin 0." and len(meta) == 46
    assert json.load(open(tmp_path / "all" / "config.json"))["speaker_id_map"] == {"spk_a": 0, "spk_b": 1}
    assert workflows.export_layout(spark, str(tmp_path), str(tmp_path / "few"), limit=5).groupBy("split").count().collect().__len__() == 3
    assert len(lines(tmp_path / "few" / "metadata.csv")) == 5 + 10 + 3 and len(lines(tmp_path / "few" / "val.txt")) == 10
    read = source.read_metadata(spark, str(tmp_path / "all" / "metadata.csv")).first()
    assert (read["stem"], read["speaker"]) == ("utt_0000", "spk_a")
    bad = spark.createDataFrame([(1, "a|x"), (2, ""), (3, "alone"), (4, "|x"), (5, "b| "), (6, "ghost|x")], "line_no long, value string")
    errors = export.validate_metadata(bad, spark.createDataFrame([("a",), ("b",)], "stem string")).orderBy("line_no").collect()
    assert [(r["line_no"], r["error"].split(": ", 1)[1]) for r in errors] == [(3, "too few columns"), (4, "empty stem"), (5, "empty text for stem 'b'"), (6, "wavs/ghost.wav not found")]
    same = spark.createDataFrame([(1, "train", "/p/x.wav"), (2, "train", "/q/x.wav"), (3, "val", "/p/x.wav"), (4, "val", "/q/x.wav")], "line_no long, split string, audio_filepath string")
    assert [r["stem"] for r in export.unique_stems(same).orderBy("line_no").collect()] == ["x", "x_2", "x", "x_3"]


def test_line_numbers_over_many_blocks(spark, tmp_path):
    (tmp_path / "m.txt").write_text("".join(f"line {i}\n" * (i % 7 != 0) or "\n" for i in range(1, 5001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = source.numbered_lines(spark, str(tmp_path / "m.txt")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(r["line_no"] for r in got) == list(range(1, 5001))
    assert all(r["value"] == ("" if r["line_no"] % 7 == 0 else f"line {r['line_no']}") for r in got)


def test_limit_and_modes(spark, tmp_path):
    path = jsonl(tmp_path / "m.jsonl", [{"text": "a"}, "{bad", "", {"text": "b"}, {"text": "c"}])
    assert [r["text"] for r in source.read_manifest(spark, path, limit=2).collect()] == ["a", "b"]
    assert source.read_manifest(spark, path, limit=0).count() == 0
    assert source.read_manifest(spark, path).count() == 4 and source.read_manifest(spark, path, mode="drop").count() == 3


def test_ratio_split(spark):
    for n in (1, 2, 40, 5000):
        got = manifest.ratio_split(spark.range(n), "id").groupBy("split").count().collect()
        sizes = {r["split"]: r["count"] for r in got}
        side = max(1, int(n * 0.025))
        assert sizes.get("test", 0) == min(n, side) and sizes.get("val", 0) == min(max(0, n - side), side) and sum(sizes.values()) == n


def test_strict_suspicious_rejects_are_all_rows(spark):
    from vokaflow.plans.queries import _audited

    rows = _audited(spark, "/root/testdata/sf0.001").cache()
    count = {m: rows.filter(audit.mode_filter(m)).count() for m in ("strict", "balanced", "rejects", "suspicious")}
    assert count["strict"] + count["suspicious"] + count["rejects"] == rows.count() and count["balanced"] == count["strict"] + count["suspicious"]


def test_command_line(spark, capsys):
    assert cli.main(["normalize", "Dr. Ali 3 kg"], spark) == 0 and capsys.readouterr().out.strip() == "doktor Ali üç kilogram"
    assert cli.main(["phonemize", "dağ 1"], spark) == 0 and capsys.readouterr().out.strip() == "d a _ b i ɾ"


def test_milestones(spark, tmp_path):
    from vokaflow.streaming.milestones import watch

    (tmp_path / "in").mkdir()
    steps = spark.readStream.schema("step long").json(str(tmp_path / "in"))
    handled = []
    (tmp_path / "in" / "1.json").write_text('{"step": 120}\n')
    q = watch(steps, [50, 100, 200], str(tmp_path / "done"), handled.append, str(tmp_path / "check"), "0 seconds")
    try:
        q.processAllAvailable()
        (tmp_path / "in" / "2.json").write_text('{"step": 250}\n')
        q.processAllAvailable()
    finally:
        q.stop()
    assert handled == [50, 100, 200]
    assert spark.read.parquet(str(tmp_path / "done")).select(F.sum("milestone")).first()[0] == 350


def test_a_literal_stem_that_meets_a_made_up_one_goes_through_the_ordered_pass(spark):
    def stems(*paths):
        rows = spark.createDataFrame([("train", i, p) for i, p in enumerate(paths)], "split string, line_no long, audio_filepath string")
        return [r["stem"] for r in export.unique_stems(rows).orderBy("line_no").collect()]

    assert stems("a/x.wav", "b/x.wav", "c/x_2.wav", "c/x_2.wav", "a/y.wav", "b/y.wav") == ["x", "x_2", "x_2_2", "x_2_3", "y", "y_2"]
    assert stems("c/x_2.wav", "a/x.wav", "b/x.wav", "a/x.wav", "b/x.wav") == ["x_2", "x", "x_3", "x", "x_4"]


def test_audit_filter_and_layout_commands(spark, tmp_path):
    for name, lead in (("a", 0.0), ("b", 0.6)):
        wav(tmp_path / f"{name}.wav", tone(2.0, lead))
    rows = [{"audio_filepath": f"{x}.wav", "text": "Bugün hava çok güzel.", "normalized_text": "", "phonemes": "a", "duration": 2.0, "speaker_id": "s"} for x in "ab"]
    path = jsonl(tmp_path / "train.jsonl", [*rows, ""])
    assert cli.main(["audit", path, str(tmp_path / "audit")], spark) == 0
    assert cli.main(["filter", path, str(tmp_path / "audit" / "audit.csv"), str(tmp_path / "strict"), "--mode", "strict"], spark) == 0
    assert lines(tmp_path / "strict") == [json.dumps(rows[0], ensure_ascii=False)]
    assert workflows.filter_file(spark, path, str(tmp_path / "audit" / "audit.csv"), "suspicious", str(tmp_path / "s")) == {"mode": "suspicious", "kept": 1, "total": 2, "dropped": 1}
    full = [r | {"audio_filepath": str(tmp_path / r["audio_filepath"])} for r in rows]
    jsonl(tmp_path / "train.jsonl", full)
    assert cli.main(["export", str(tmp_path), str(tmp_path / "layout")], spark) == 0
    assert sorted(p.name for p in (tmp_path / "layout" / "wavs").iterdir()) == ["a.wav", "b.wav"]
    assert (tmp_path / "layout" / "wavs" / "a.wav").read_bytes() == (tmp_path / "a.wav").read_bytes()
    assert cli.main(["validate-export", str(tmp_path / "layout")], spark) == 0
    (tmp_path / "layout" / "wavs" / "a.wav").unlink()
    assert workflows.validate_layout(spark, str(tmp_path / "layout")) == (1, ["metadata.csv line 1: wavs/a.wav not found"])
    assert workflows.validate_layout(spark, str(tmp_path / "none")) == (0, ["missing: metadata.csv", "missing: config.json", "missing: wavs/ directory"])
    assert cli.main(["terms", path, str(tmp_path / "terms"), "--terms", "hava", "--jsonl"], spark) == 0
    assert [json.loads(x)["matched_terms"] for x in lines(tmp_path / "terms" / "terms.jsonl")] == ["hava", "hava"]
