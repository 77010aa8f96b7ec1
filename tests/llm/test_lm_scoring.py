import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from vokaflow.llm import queries
from vokaflow.llm.lm_scoring import Model, count_of, level_of, score_documents

SF = "/root/testdata/sf0.001"


def split(text):
    return [*re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def brute(rows, training):
    c = Counter(t for x in training for t in split(x))
    n, v = sum(c.values()), len(c)
    for i, x in rows:
        own = split(x)
        yield i, (len(own), sum(c[t] > 0 for t in own), n, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in own))


def test_levels():
    counts = np.array([0, 1, 2, 3, 4, 7, 8, 1000])
    assert level_of(counts, 2).tolist() == [0, 0, 1, 1, 2, 2, 3, 9] and level_of(counts, 1).tolist() == [0, 1, 2, 2, 3, 3, 4, 10]
    assert count_of(np.array([0, 1, 2]), 1).tolist()[:2] == [0, 1] and 2 < count_of(np.array([2]), 1)[0] < 4


@pytest.mark.parametrize("dictionary", [1 << 20, 8, 0])
def test_scores(spark, dictionary):
    texts = ["The cat sat. THE END", None, "", " \t\n", "é É a\x0bb", "cat the cat the", "z" * 5000 + " y", "x " * 9000]
    rows = [(i, t, "n", 1.0) for i, t in enumerate(texts)] + [(0, texts[0], "n", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, rid string, score double")
    got = score_documents(docs, docs.filter("doc_id <> 5"), dictionary_words=dictionary).collect()
    want = sorted(brute([r[:2] for r in rows], [r[1] for r in rows if r[0] != 5]))
    for r, (i, w) in zip(sorted(got), want, strict=True):
        assert (r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i, *w[:3])
        assert abs(r["base_score"] - w[3]) < 1e-6 * max(1, abs(w[3]))
        assert math.isfinite(r["score"]) and r["score"] <= 0


def test_query_on_documents(spark):
    got = {r["doc_id"]: r for r in queries.op9_bloom_lm_scoring(spark, SF).collect()}
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 7 == 2}
    assert {i for i, r in got.items() if r["held_out"]} == held
    for i, w in brute(docs, [x for i, x in docs if i not in held]):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3] and abs(r["base_score"] - w[3]) < 1e-6 * abs(w[3])
    # Held out, context helps: the model beats the add-one word model.
    assert sum(got[i]["score"] for i in held) > sum(got[i]["base_score"] for i in held)


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert score_documents(none, none).count() == 0
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert score_documents(some, none).first()["n_known"] == 0


def test_a_filter_beyond_its_bound_is_asked_in_segments(spark):
    # 20,000 words once, 3,000 bigrams often: far more pairs than 4096 bytes hold.
    texts = [" ".join(f"w{i}x{k}" for k in range(500)) for i in range(40)] + [" ".join(f"c{(i * 7 + k) % 3000}" for k in range(1500)) for i in range(20)]
    texts += [None, "", "unseen words only", "c1 c2 unseen c3"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    training = docs.filter("doc_id < 60")
    whole, asked = ({r["doc_id"]: r for r in score_documents(docs, training, filter_bytes=n).collect()} for n in (1 << 24, 1 << 12))
    assert whole.keys() == asked.keys() and len(asked) == len(texts)
    for i, r in whole.items():
        assert tuple(asked[i])[:4] == tuple(r)[:4] and abs(asked[i]["base_score"] - r["base_score"]) < 1e-9 * abs(r["base_score"])
        assert abs(asked[i]["score"] - r["score"]) < 1e-9 * abs(r["score"])


def test_a_full_filter_ends_at_the_largest_level():
    from vokaflow.llm.lm_scoring import LogFrequencyFilter

    full = LogFrequencyFilter(np.full(4096, 255, np.uint8), {1: 5, 2: 3})
    assert full.levels(np.arange(9, dtype=np.uint64), 1).tolist() == [5] * 9 and full.levels(np.arange(9, dtype=np.uint64), 2).tolist() == [3] * 9
