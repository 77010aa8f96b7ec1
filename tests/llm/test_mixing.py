import re

import numpy as np

from vokaflow.llm.mixing import flight, mix_sources


def expected_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    left, free, target = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            target |= {s: weight[s] * level for s in free}
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        free -= over
    return target


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(5)
    size, p = rng.integers(1, 900, 400).astype(float), np.full(400, 0.37)
    q = flight(p, size, rng, False)
    assert ((q > 0) & (q < 1)).sum() <= 2
    assert abs(q.sum() - p.sum()) < 1e-6 and abs((q * size).sum() - (p * size).sum()) < 1e-3


def test_flight_is_unbiased():
    size, p = np.array([3.0, 50.0, 7.0, 7.0, 0.0, 20.0]), np.array([0.2, 0.5, 0.9, 0.1, 0.4, 0.7])
    mean = np.mean([flight(p, size, np.random.default_rng(i), True) for i in range(6000)], axis=0)
    assert np.abs(mean - p).max() < 0.03


def test_mix_sources(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(2500):
        source = [None, "a", "b", "é", "z"][0 if i % 50 == 0 else 1 if i % 3 else 2 + i % 9 // 3]
        text = None if i % 97 == 0 else " ".join(["w"] * int(rng.integers(0, 400)))
        rows.append((i, text, source, "clash"))
    rows += [rows[4], rows[4], (9001, "", "empty only", "x"), (9002, None, "empty only", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, target string")
    got = [r.asDict() for r in mix_sources(docs).collect()]
    assert len(got) == len(rows)
    size = {}
    for _, t, s, _ in rows:
        size[s] = size.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    target = expected_targets(size)
    taken = dict.fromkeys(size, 0)
    for r in got:
        assert r["source_size"] == size[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6 * (1 + target[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        taken[r["source"]] += r["taken"]
    for s in size:
        assert abs(taken[s] - target[s]) <= 400
    again = mix_sources(docs.repartition(7)).collect()
    assert sorted((r["doc_id"], r["copies"]) for r in again) == sorted((r["doc_id"], r["copies"]) for r in got)


def test_no_documents(spark):
    assert mix_sources(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
