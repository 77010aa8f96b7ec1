import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from vokaflow.llm.packing import best_fit_decreasing, pack_documents, token_bytes

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def one_by_one(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fitting = [i for i, left in enumerate(room) if left >= n]
        if fitting:
            best = min(fitting, key=lambda i: room[i])
            room[best] -= n
        else:
            room.append(capacity - n)
    return sorted(room)


@given(st.lists(st.integers(1, 40), max_size=120))
@settings(max_examples=150, deadline=None)
def test_runs_equal_packing_one_by_one(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    runs, opened = best_fit_decreasing(counts, 40)
    fill = {}
    for length in counts:
        own = [r for r in runs.tolist() if r[0] == length]
        for rank in range(counts[length]):
            _, first, per, start, offset = [r for r in own if r[1] <= rank][-1]
            at = fill.setdefault(start + (rank - first) // per, [])
            at.append((offset + (rank - first) % per * length, length))
    for places in fill.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 40
    assert sorted(40 - sum(n for _, n in p) for p in fill.values()) == one_by_one(lengths, 40)
    assert opened == len(fill)


alphabet = st.lists(st.sampled_from([*"ab'sZ9.,!<|>\n\t\r  éßğ½²\xa0", "<|endoftext|>", "  ", "don't", "日本", "\x1c", "\x85", "\u3000", "🙂"]), max_size=40).map("".join)


@given(st.lists(alphabet | st.text(max_size=30), min_size=1, max_size=5))
@settings(max_examples=400, deadline=None)
def test_token_bytes_equal_the_tokenizer(tokenizer, parts):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    assert np.frombuffer(token_bytes(PATH)(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_pack_documents(spark, tokenizer):
    rng = random.Random(3)
    words = ["alpha", "beta,", "gamma\n", "delta", "ε", "x1"]
    texts = [" ".join(rng.choices(words, k=rng.choice([0, 1, 5, 90, 700, 5000]))) for _ in range(60)] + [None, ""]
    rows = [(i, t, "s", 1) for i, t in enumerate(texts)] + [(3, texts[3], "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, piece int")
    got = [r.asDict() for r in pack_documents(docs, tokenizer=PATH).collect()]
    for i, text in enumerate(texts):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        own = sorted((r for r in got if r["doc_id"] == i), key=lambda r: (r["piece"], r["sequence_id"]))
        own = own[::2] if i == 3 else own
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert sum(r["length"] for r in own) == len(ids) and all(r["length"] == 1024 for r in own[1:])
        for r in own:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(by) <= sum(r["length"] for r in got) / 1024 * 1.1 + 1


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(docs, tokenizer=PATH).count() == 0
