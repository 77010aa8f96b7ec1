import numpy as np
from pyspark.sql import functions as F

from vokaflow.llm import language_id as li
from vokaflow.llm import queries

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, declared string, host string, suffix string, confidence string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = li.train(docs.filter("doc_id % 2 = 0"))
    held = docs.filter("doc_id % 2 = 1").selectExpr("doc_id", "lang as truth", "text", "'' as declared", "source as host", "'' as suffix")
    got = li.identify(held, model).collect()
    assert sum(r["lang"] == r["truth"] for r in got) / len(got) > 0.97


def test_query_covers_documents_and_pages(spark):
    got = queries.op1_language_fusion(spark, SF)
    assert got.filter("doc_id is not null").count() == 1000 and got.filter("page_id is not null").count() == 250
    pages = got.filter("page_id is not null and declared <> ''")
    assert pages.filter("lang = declared").count() / pages.count() > 0.9


def test_evidence_without_text(spark):
    model = li.train(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = [(1, "", "fr", "a.com", "com", "x"), (2, None, "", "b.de", "de", "x"), (3, "", "xx", "c.com", "com", "x"), (4, None, "", None, "", "x")]
    rows += [(10 + i, "", "es", "h.net", "net", "x") for i in range(30)] + [(50, "", "", "h.net", "net", "x"), (50, "", "", "h.net", "net", "x")]
    got = [r for r in li.identify(spark.createDataFrame(rows, SCHEMA), model).collect()]
    by = {r["doc_id"]: r["lang"] for r in got}
    assert len(got) == len(rows) and by[1] == "fr" and by[2] == "de" and by[50] == "es"
    assert all(0 < r["confidence"] <= 1 for r in got)


def test_posterior_equals_brute_force(spark):
    """Without text: declared and host prior by hand."""
    model = np.log(np.full((4, li.BUCKETS), 1 / li.BUCKETS))
    rows = [(1, "", "de", "h", "s", ""), (2, "", "de", "h", "s", ""), (3, "", "en", "k", "s", "")]
    got = {r["doc_id"]: r for r in li.identify(spark.createDataFrame(rows, SCHEMA), model).collect()}
    L = li.LANGUAGES
    named = lambda d: np.array([li.DECLARED_RIGHT if x == d else 0.05 for x in L])
    p = {i: named(d) / named(d).sum() for i, d in ((1, "de"), (2, "de"), (3, "en"))}
    whole = sum(p.values())
    q = (whole + 10 * (whole + 1) / (3 + 4)) / (3 + 10)
    f = named("de") * (p[2] + 10 * q) / (2 - 1 + 10)
    assert got[1]["lang"] == "de" and abs(got[1]["confidence"] - f.max() / f.sum()) < 1e-9


def test_hard_rows_and_clashing_names(spark):
    model = li.train(spark.read.parquet(f"{SF}/documents.parquet"))
    german = "der Hund und die Katze sind nicht im Haus "
    rows = [(1, german, "", "h", "s", "c"), (1, german, "", "h", "s", "c"), (None, german * 20_000, None, None, None, "c"), (None, "", None, None, None, "c")]
    names = ("t0", "hn", "q0", "cc", "p0", "f0", "h0", "row", "h", "n", "wanted", "sn", "_l0", "_e0", "_most", "_host", "a.b")
    df = spark.createDataFrame(rows, SCHEMA).select("*", *(F.col("confidence").alias(c) for c in names))
    out = li.identify(df, model)
    assert out.columns == ["doc_id", "declared", "host", "suffix", *names, "text_lang", "lang", "confidence"]
    got = out.collect()
    assert len(got) == 4 and all(r[c] == "c" for r in got for c in names)
    assert sum(r["lang"] == "de" for r in got) >= 3 and sum(r["doc_id"] is None for r in got) == 2
    assert got[0]["declared"] is not None and any(r["host"] is None for r in got)


def test_markup(spark):
    html = "<HTML class=a LANG='Fr-CA'><!-- x --><script>var a='<p>';</script><p>bon<b>jour</b>"
    row = spark.createDataFrame([(html, "m.x.co.uk:80")], "html string, host string")
    r = row.select(li.visible_text(F.col("html")).alias("t"), li.declared_language(F.col("html")).alias("d"), li.host_suffix(F.col("host")).alias("s")).first()
    assert r["t"].split() == ["bon", "jour"] and r["d"] == "fr" and r["s"] == "uk"


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    model = li.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert li.identify(none, model).count() == 0
