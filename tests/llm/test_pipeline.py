import re
from collections import Counter, defaultdict

import corpus_pipeline as cp
import pytest
from test_near_dedup import brute, corpus
from vokaflow.llm import common
from vokaflow.llm.quality import quality_rules

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_run_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in cp.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()} if name != "packing" else docs.collect()
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        rows = out.collect()
        if name == "quality rules":
            assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in quality_rules(docs).filter("kept").collect()}
        if name == "line dedup":
            assert {r["doc_id"] for r in rows} == set(before)
            assert all(r["text"] == before[r["doc_id"]]["text"] or set(r["text"].split("\n")) < set(before[r["doc_id"]]["text"].split("\n")) for r in rows)
        if name == "MinHash near-dedup":
            assert sorted(r["doc_id"] for r in rows) == sorted(min(c) for c in brute([(i, r["text"]) for i, r in before.items()]))
        if name == "mixing":
            assert max(Counter(r["doc_id"] for r in rows).values()) == 2
            size, took = defaultdict(int), defaultdict(int)
            for r in before.values():
                size[r["source"]] += len(re.findall(r"[^\x20\x09-\x0d]+", r["text"]))
            for r in rows:
                took[r["source"]] += len(re.findall(r"[^\x20\x09-\x0d]+", r["text"]))
            assert all(took[s] <= 2 * size[s] for s in size) and 1.3 < sum(took.values()) / sum(size.values()) < 1.6
        if name == "packing":
            assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter(r["doc_id"] for r in before)
        docs = spark.createDataFrame(rows, out.schema)


def test_hard_rows(spark):
    rows = [(i, t, "en", ["a", None, "b"][i % 3], 1) for i, t in corpus(3)]
    rows += [rows[5], rows[5], (None, "null id " * 30, None, None, None), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = cp.near_duplicates(spark, docs, "").collect()
    assert max(Counter((r["doc_id"], r["text"]) for r in kept).values()) == 1
    assert sum(r["doc_id"] is None for r in kept) >= 1
    mixed = cp.mixing(spark, docs, "").collect()
    assert max(Counter((r["doc_id"], r["text"]) for r in mixed).values()) <= 6
    for stage in (cp.quality, cp.lines, cp.packing):
        stage(spark, docs, "").collect()


CLASHES = ("_doc_id", "_h", "_text_hash", "row", "id", "h", "key_id", "key_h", "own_source", "copies", "copy", "lost_lines", "n_lines", "n_removed", "th", "size", "a.b")


def test_other_columns_may_have_any_name(spark):
    rows = [(i, t, "en", "ab"[i % 2], 1, f"own {i}") for i, t in corpus(3)[:60]] + [(None, None, None, None, None, "own None")]
    docs = spark.createDataFrame(rows, SCHEMA + ", x string")
    docs = docs.select(*docs.columns, *(docs["x"].alias(c) for c in CLASHES)).drop("x")
    for stage in (cp.quality, cp.lines, cp.near_duplicates, cp.mixing):
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        got = out.collect()
        assert got and all(r[c] == f"own {r['doc_id']}" for r in got for c in CLASHES)
    assert cp.packing(spark, docs, "").count() >= len(rows)


def test_run_leaves_only_its_result(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_folder", lambda spark: str(tmp_path))
    assert cp.run(spark, SF).count() > 0
    left = [p.name for p in (tmp_path / "vokaflow").iterdir()]
    assert len(left) == 1 and left[0].startswith("packing")


def test_a_cluster_must_name_its_folder():
    class Session:
        conf = {}

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(Session())


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in cp.STAGES:
        assert stage(spark, docs, "").count() == 0


def test_quality_removes_the_frequent_lines_of_a_host(spark):
    own = lambda i: " ".join(f"q{i}x{k}" for k in range(60))
    texts = {i: f"{own(i)}\n\nSubscribe  to OUR letter\nend {i}" for i in range(52)}
    rows = [(i, t, "en", "a", len(t)) for i, t in texts.items()] + [(0, texts[0], "en", "a", len(texts[0])), (99, f"{own(99)}\nsubscribe to our letter", "en", "b", None)]
    out = cp.quality(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert len(out) == len(rows)
    got = {r["doc_id"]: r for r in out}
    whole = [i for i in texts if got[i]["text"] == texts[i]]
    assert len(whole) == 1 and got[99]["text"] == rows[-1][1] and got[99]["n_chars"] is None
    assert all(got[i]["text"] == f"{own(i)}\n\nend {i}" and got[i]["n_chars"] == len(got[i]["text"]) for i in texts if i not in whole)
