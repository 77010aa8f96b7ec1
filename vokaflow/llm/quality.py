"""Quality rules: counts on one text, and the cross-document frequency of its lines.

Every stage is a Column or a join; nothing runs in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, HEAVY, WORD, spread_join, text_or_empty, written

#: A line that more documents of a host than this share is boilerplate there.
MOST_DOCUMENTS = 50
#: A document that loses more than this share of its words with such lines is depleted.
MOST_LOST = 0.7
LEAST_WORDS, MOST_REPEATED = 50, 50


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def normalised(line: Column) -> Column:
    """A line in lower case, its words one space apart."""
    return F.lower(F.array_join(word_array(line), " "))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))


def repeated_words(df: DataFrame, words: str, name: str) -> DataFrame:
    """Adds how many words lie in a three-word window found twice or more in the array column.

    Windows are hashed and sorted with their places; equal neighbours are repeats. The sort only
    runs where the windows are not all different.
    """
    n = F.size(words)
    window = F.transform(F.slice(words, 1, F.greatest(n - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.col(words)[i + 1], F.col(words)[i + 2]))
    df = df.withColumn("_w", window)
    placed = F.sort_array(F.transform("_w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    df = df.withColumn("_s", F.when(F.size(F.array_distinct("_w")) < F.size("_w"), placed).otherwise(none))
    s = F.col("_s")
    # get() gives null beyond either end, and null is not equal to a hash.
    twice = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
    df = df.withColumn("_p", F.sort_array(F.transform(twice, lambda x: x["i"])))
    # A window adds three words, less what the next one covers too.
    steps = F.zip_with("_p", F.slice("_p", 2, F.greatest(F.size("_p"), F.lit(1))), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3))))
    return df.withColumn(name, F.aggregate(steps, F.lit(0).cast("long"), lambda t, x: t + x)).drop("_w", "_s", "_p")


def quality_rules(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source", most_documents: int = MOST_DOCUMENTS, most_lost: float = MOST_LOST) -> DataFrame:
    """One row per document: the id, host, text_hash, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, n_lost_words, kept, n_lost_lines, lost_lines.

    The method: lines are normalised and hashed, and the distinct documents with a line counted per
    host. A line in more than ``most_documents`` is removed from all of them but those whose text has the
    least hash among them: their content stays, as one document and its exact copies. A document that thereby
    loses more than ``most_lost`` of its words is depleted. kept is false if the base rules fail or it is depleted.
    lost_lines holds the places of the removed lines in the text split at newlines (null for none); without_lines() takes them out.

    A null text has no words and fails; null hosts are one host; repeated rows (of one id and text) are one document and
    get equal results; texts of any length are counted whole; other columns, whatever their names, are not read; no rows give no rows.
    """
    text = text_or_empty(text_column)
    df = docs.select(F.col(id_column).alias("id"), F.col(host_column).alias("host"), F.unhex(F.md5(text.cast("binary"))).alias("th"), text.alias("text"))
    df = df.withColumn("words", word_array(F.col("text"))).withColumn("lines", lines_with_words(F.col("text")))
    hashed = F.transform(F.split("text", "\n"), lambda line, i: F.struct(F.xxhash64(normalised(line)).alias("h"), F.size(word_array(line)).alias("n"), i.alias("place")))
    df = df.withColumn("hashed", F.filter(hashed, lambda line: line["n"] > 0))
    df = repeated_words(df, "words", "n_repeat_words").select(
        "id", "host", "th",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", "hashed",
    )
    counted = written(df.withColumn("rid", F.monotonically_increasing_id()), "counted")
    lines = counted.select("rid", "id", "th", "host", F.explode("hashed").alias("line"))
    lines = written(lines.select("rid", "id", "th", F.xxhash64(F.coalesce(F.col("host").cast("string"), F.lit("\0")), "line.h").alias("h"), "line.n", "line.place"), "lines")
    documents = lines.select("h", "id", "th").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("documents"), F.min("th").alias("owner"))
    total = lines.count()
    rows = lines.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter((F.col("n") * HEAVY > total) | (F.col("n") > most_documents))
    frequent = written(documents.join(rows, "h").withColumn("wanted", F.col("documents") > most_documents).drop("documents"), "frequent")
    lost = spread_join(lines.withColumnRenamed("n", "words"), frequent, "h", total).filter(F.col("th") != F.col("owner"))
    lost = lost.groupBy("rid").agg(F.sum("words").alias("lost"), F.sort_array(F.collect_list("place")).alias("lost_lines"))
    out = counted.drop("hashed").join(lost, "rid", "left").withColumn("n_lost_words", F.coalesce("lost", F.lit(0)).cast("long"))
    out = out.withColumn("n_lost_lines", F.coalesce(F.size("lost_lines"), F.lit(0)).cast("long"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    out = out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("n_lost_words") <= most_lost * F.col("n_words")))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_lost_words", "kept", "n_lost_lines", "lost_lines")
    return out.select(F.col("id").alias(id_column), F.col("host").alias(host_column), F.lower(F.hex("th")).alias("text_hash"), *counts)


def without_lines(text: Column, places: Column) -> Column:
    """The text without the lines at these places; as it is where they are null."""
    lines = F.split(text, "\n")
    left = F.filter(lines, lambda _, i: ~F.array_contains(places, i))
    return F.when(places.isNull(), text).otherwise(F.array_join(left, "\n"))


def oracle_sql(most_documents: int = MOST_DOCUMENTS, most_lost: float = MOST_LOST) -> str:
    """quality_rules of ``documents`` in DuckDB's SQL."""
    word = r"[^\x20\x09-\x0D]+"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t, md5(coalesce(text, '')) AS th FROM documents
), w AS (
  SELECT *, regexp_extract_all(t, '{word}') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{word}')) AS ls FROM d
), g AS (
  SELECT rid, unnest(range(1, len(ws) - 1)) AS p, ws FROM w
), g3 AS (
  SELECT rid, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS x FROM g
), again AS (
  SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, x) AS n FROM g3) WHERE n > 1
), rep AS (
  SELECT rid, count(DISTINCT q) AS n FROM again GROUP BY rid
), l AS (
  SELECT rid, doc_id, source, th, unnest(ls) AS line FROM w
), l2 AS (
  SELECT rid, doc_id, source, th, lower(array_to_string(regexp_extract_all(line, '{word}'), ' ')) AS x, len(regexp_extract_all(line, '{word}')) AS n FROM l
), f AS (
  SELECT source, x, min(th) AS owner FROM l2 GROUP BY source, x HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '-') || ' ' || th) > {most_documents}
), lost AS (
  SELECT l2.rid, sum(l2.n) AS n, count(*) AS k FROM l2 JOIN f ON l2.x = f.x AND l2.source IS NOT DISTINCT FROM f.source WHERE l2.th <> f.owner GROUP BY l2.rid
), c AS (
  SELECT w.doc_id, w.source, w.th AS text_hash, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_lost_words, CAST(coalesce(lost.k, 0) AS BIGINT) AS n_lost_lines
  FROM w LEFT JOIN rep USING (rid) LEFT JOIN lost USING (rid)
), b AS (
  SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM c
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND n_lost_words <= {most_lost} * n_words AS kept, n_lost_words, n_lost_lines, n_words - n_lost_words AS n_left_words FROM b
"""
