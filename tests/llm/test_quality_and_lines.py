import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from vokaflow.llm import line_dedup, quality

WORD = r"[^\x20\x09-\x0d]+"


def brute_counts(text):
    t = text or ""
    w = re.findall(WORD, t)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(WORD, x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None, "", " \t\n", "a b c a b c a b c", "x x x x", "a\nb\na\n\n \na b\r\na b\r", "é🙂 #*$%&|<> \x0b\x0cz", "w " * 49 + "w",
    " ".join(f"w{i}" for i in range(50)), " ".join(f"w{i % 400}" for i in range(40_000)), "\n".join(["same line here"] * 500),
]


def test_counts(spark):
    rows = [(i, t, "s", True) for i, t in enumerate(TEXTS)] + [(8, TEXTS[8], "s", True), (99, TEXTS[8], None, True)]
    got = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string, kept boolean")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute_counts(TEXTS[8 if r["doc_id"] == 99 else r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def boilerplate_rows():
    own = lambda i, n: " ".join(f"q{i}x{k}" for k in range(n))
    rows = [(i, f"{own(i, 60)}\nShared  line of SOME words\n{own(i, 5)}", f"s{i % 6}" if i % 7 else None) for i in range(60)]
    rows += [(100 + i, f"{own(1000, 80)}\n{own(i, 3)}", "s0") for i in range(12)]  # mostly one shared line
    rows += [(200 + i, own(5000, 70), f"s{i}") for i in range(9)]  # exact copies
    rows += [(300 + i, f"tiny\n{own(300 + i, 55)}", f"s{i}") for i in range(9)]
    return rows + [(400, None, "s1"), (401, "", None), rows[0], rows[0]]


def duck(rows, sql):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?)", rows)
    return con.sql(sql)


@pytest.mark.parametrize("most", [3, 8, 50])
def test_frequency_equals_sql(spark, most):
    rows = boilerplate_rows()
    want = duck(rows, quality.oracle_sql(most_documents=most))
    got = quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"), most_documents=most).withColumn("n_left_words", F.col("n_words") - F.col("n_lost_words")).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())
    if most == 8:
        kept = {r["doc_id"]: r["kept"] for r in got}
        assert sum(kept[100 + i] for i in range(12)) == 1 and all(kept[200 + i] for i in range(9))


@pytest.mark.parametrize(("sites", "words"), [(5, 5), (3, 1), (2, 4)])
def test_spread_equals_sql(spark, sites, words):
    rows = boilerplate_rows()
    want = duck(rows, line_dedup.oracle_sql(sites, words))
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, source string, h string")
    names = ("row", "gone", "lines", "id", "th", "site", "place", "_id", "_th", "_gone", "_lines", "_hash", "a.b")
    df = df.select("*", *(F.col("h").alias(n) for n in names))
    got = line_dedup.dedupe_lines(df, least_sites=sites, least_words=words)
    assert got.columns == ["doc_id", "text", "source", "h", *names, "n_lines", "n_removed"]
    assert got.filter(" or ".join(f"`{n}` <> 'clash'" for n in names)).isEmpty()
    key = lambda r: (r[0], r[1] is None, r[1] or "", r[2], r[3])
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=key) == sorted(want.fetchall(), key=key)


def test_spread_of_many_sites(spark):
    rows = [(f"h{k}", f"site{i}", b"x") for k, n in ((1, 4), (2, 5), (3, 6), (4, 3000)) for i in range(n)]
    got = {r["h"]: r["n_sites"] for r in line_dedup.line_spread(spark.createDataFrame(rows, "h string, site string, th binary")).collect()}
    assert got["h2"] == 5 and got["h3"] == 6 and abs(got["h4"] - 3000) < 300 and "h1" not in got


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert quality.quality_rules(none).count() == 0 and line_dedup.dedupe_lines(none).count() == 0
