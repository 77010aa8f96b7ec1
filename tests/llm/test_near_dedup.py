import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from vokaflow.llm import near_dedup as nd


def bag(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    return Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute(docs):
    """The partition into classes, by all pairs that share a shingle."""
    bags = {i: bag(t) for i, t in docs}
    up = {i: i for i in bags}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    by = defaultdict(set)
    for i, b in bags.items():
        for g in b:
            by[g].add(i)
    seen = set()
    for ids in by.values():
        ids = sorted(ids)
        for n, a in enumerate(ids):
            for b in ids[n + 1 :]:
                if (a, b) not in seen and root(a) != root(b):
                    seen.add((a, b))
                    if sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values()):
                        up[root(b)] = root(a)
    first = {}
    for i, t in docs:
        first.setdefault(t or "", i)
        up[root(i)] = root(first[t or ""])
    out = defaultdict(set)
    for i in bags:
        out[root(i)].add(i)
    return {frozenset(s) for s in out.values()}


def classes(rows):
    out = defaultdict(set)
    for r in rows:
        out[r["class_id"]].add(r["doc_id"])
    return {frozenset(s) for s in out.values()}


def test_registers_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    shingle = np.sort(rng.integers(0, 1 << 48, 300).astype(np.uint64))
    one = rng.integers(1, 9, 300)
    two = np.where(rng.random(300) < 0.4, rng.integers(1, 9, 300), one)
    s = nd.signatures(np.repeat([0, 1], 300), np.tile(shingle, 2), np.concatenate([one, two]), 2, 16384)
    assert abs((s[0] == s[1]).mean() - np.minimum(one, two).sum() / np.maximum(one, two).sum()) < 0.015


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghij", k=4))
    fresh = lambda n: [word() for _ in range(n)]
    docs, passage = [], fresh(60)
    base = fresh(150)
    for _ in range(70):  # near copies of one text, also of one another
        w = base[:]
        for _ in range(rng.choice([1, 2, 3, 4, 5])):
            w[rng.randrange(len(w))] = word()
        docs.append(" ".join(w))
    chain = fresh(200)
    for _ in range(12):  # each like the one before, the ends unlike
        chain = chain[12:] + fresh(12)
        docs.append(" ".join(chain))
    docs += [" ".join(fresh(rng.choice([5, 20, 60, 200])) + passage + fresh(rng.choice([5, 20, 60]))) for _ in range(120)]
    docs += [docs[0]] * 40 + ["one two", "one two", "one  two", "three", None, "", " \n ", "a b c d e", "a b c d e f"]
    docs += ["x y z v w " * k for k in (30, 33, 60, 1)] + [" ".join(fresh(20_000))]
    return list(enumerate(docs))


@pytest.mark.parametrize(("paired", "words"), [(1 << 10, 400_000), (1, 3000)])
def test_classes_equal_brute_force(spark, monkeypatch, paired, words):
    monkeypatch.setattr(nd, "MOST_PAIRED", paired)
    monkeypatch.setattr(nd, "BLOCK_WORDS", words)
    docs = corpus()
    df = spark.createDataFrame([(i, t, "clash") for i, t in docs] + [(3, docs[3][1], "clash")], "doc_id long, text string, node string")
    got = nd.near_duplicate_classes(df).collect()
    assert len(got) == len(docs) + 1
    assert classes(got) == brute(docs)
    assert all(min(r["doc_id"] for r in got if r["class_id"] == c) == c for c in {r["class_id"] for r in got})
    assert {r["doc_id"] for r in got if r["kept"]} == {r["class_id"] for r in got}


def test_shuffled_lists_join_by_broadcast_or_not(spark, monkeypatch):
    monkeypatch.setattr(nd, "BROADCAST_TEXTS", 0)
    docs = corpus(2)[:90]
    got = nd.near_duplicate_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert classes(got) == brute(docs)


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 160)] + [(i, i + 1) for i in range(260, 200, -1)] + [(300, i) for i in range(301, 330)] + [tuple(rng.sample(range(400, 500), 2)) for _ in range(90)] + [(7, 7)]
    up = {x: x for e in edges for x in e}

    def root(x):
        return x if up[x] == x else root(up[x])

    for a, b in edges:
        lo, hi = sorted((root(a), root(b)))
        up[hi] = lo
    got = {r["node"]: r["comp"] for r in nd.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in up if x != 7}


def test_no_rows(spark):
    assert nd.near_duplicate_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_blocks_bring_every_open_pair_of_a_bucket_together(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_WORDS", 40)
    rows = [(7, i, 0 if i < 9 else i, 0, 210, 120) for i in range(21)]
    got = nd._blocks(spark.createDataFrame(rows, "key long, node long, comp long, top long, words long, words_outside long")).collect()
    asking, asked = ({k: {r["node"] for r in got if r["key"] == k and r["asks"] == a} for k in {r["key"] for r in got}} for a in (True, False))
    assert {(x, y) for k in asking for x in asking[k] for y in asked[k]} == {(x, y) for x in range(9, 21) for y in range(21)}
    assert len(asked) > 1


def test_a_pair_in_a_large_family_below_the_threshold_is_found(spark, monkeypatch):
    # 40 texts on one template, unlinked, but for the two last; every bucket counts as too large for one task.
    rng = random.Random(5)
    template = [f"t{k}" for k in range(300)]

    def changed(words, n, tag):
        out = list(words)
        for k in rng.sample(range(len(out)), n):
            out[k] = f"{tag}y{k}"
        return out

    texts = [changed(template, 14, i) for i in range(40)]
    texts[39] = changed(texts[38], 4, "z")
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    monkeypatch.setattr(nd, "MOST_PAIRED", 0)
    monkeypatch.setattr(nd, "BLOCK_WORDS", 2400)
    got = nd.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by: dict = {}
    for r in got:
        by.setdefault(r["class_id"], set()).add(r["doc_id"])
    assert sorted(map(sorted, by.values())) == sorted(map(sorted, brute(rows)))
    assert by[38] == {38, 39}
