"""Line dedup by distinct-site spread.

The sites of each line are counted by HyperLogLog sketches, which merge in the aggregation and
stay small however many documents share a line. Lines whose estimate is near the threshold are
counted exactly. All of it is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HEAVY, spread_join, text_or_empty, whole_row, written
from .quality import normalised, word_array

#: A line of so many words or more on so many sites or more is boilerplate.
LEAST_SITES, LEAST_WORDS = 5, 5
#: 2**LOG_K slots: a relative error of about 1.04 / 2**(LOG_K / 2), 1.6 %. Exact counts
#: are made within NEAR of the threshold, six times that, and at least one site to either side.
LOG_K, NEAR = 12, 0.1


def line_spread(lines: DataFrame, *, least_sites: int = LEAST_SITES) -> DataFrame:
    """(h, n_sites, owner) of the boilerplate lines among rows of (h, site, th).

    n_sites is exact near the threshold and an estimate far above it; owner is the least th.
    """
    return _counted(lines, lines.count(), least_sites).filter("wanted").select("h", "n_sites", "owner")


def _counted(lines: DataFrame, total: int, least_sites: int) -> DataFrame:
    """(h, n_sites, owner, n, wanted) of the boilerplate lines, which are wanted, and of all lines with a heavy share of the rows."""
    sketches = lines.groupBy("h").agg(F.hll_sketch_agg("site", F.lit(LOG_K)).alias("sketch"), F.min("th").alias("owner"), F.count(F.lit(1)).alias("n"))
    likely = F.col("estimate") >= min(least_sites * (1 - NEAR), least_sites - 1)
    sketches = sketches.select("h", "owner", "n", F.hll_sketch_estimate("sketch").alias("estimate"))
    spread = written(sketches.filter(likely | (F.col("n") * HEAVY > total)), "spread")
    near = likely & (F.col("estimate") <= max(least_sites * (1 + NEAR), least_sites + 1))
    exact = spread_join(lines.select("h", "site"), spread.select("h", "n", near.alias("wanted")), "h", total).distinct().groupBy("h").agg(F.count(F.lit(1)).alias("exact"))
    counted = spread.join(exact, "h", "left").withColumn("n_sites", F.coalesce("exact", "estimate"))
    return written(counted.select("h", "n_sites", "owner", "n", (F.col("n_sites") >= least_sites).alias("wanted")), "boilerplate")


def dedupe_lines(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", site_column: str = "source", least_sites: int = LEAST_SITES, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows and columns of docs with cross-site lines removed from the text, and n_lines, n_removed.

    Lines are split at newlines and compared in lower case with their words one space apart.
    A line of ``least_words`` words or more on ``least_sites`` sites or more stays only in the text
    with the least hash (and in its exact copies); all other lines, blank ones too, stay as
    they are. A null text stays null with no lines; a null site counts as one site; repeated rows
    stay repeated; texts of any length are split whole; extra columns pass through, whatever their names, but n_lines
    and n_removed replace columns of those names; no rows give no rows.
    """
    text = text_or_empty(text_column)
    key = docs.select(F.col(id_column).alias("id"), F.unhex(F.md5(text.cast("binary"))).alias("th"), F.coalesce(F.col(site_column).cast("string"), F.lit("\0")).alias("site"), text.alias("text"))
    line = key.select("id", "th", "site", F.posexplode(F.split("text", "\n")).alias("place", "line"))
    line = line.filter(F.size(word_array(F.col("line"))) >= least_words)
    line = written(line.select("id", "th", "site", "place", F.xxhash64(normalised(F.col("line"))).alias("h")), "lines")
    total = line.count()
    boilerplate = _counted(line, total, least_sites).select("h", "owner", "n", "wanted")
    gone = spread_join(line.select("id", "th", "place", "h"), boilerplate, "h", total).filter(F.col("th") != F.col("owner"))
    gone = gone.groupBy(F.col("id").alias("gone_id"), F.col("th").alias("gone_th")).agg(F.sort_array(F.collect_set("place")).alias("gone"))
    rows = docs.select(whole_row(docs).alias("row"), F.unhex(F.md5(text.cast("binary"))).alias("th"))
    joined = rows.join(gone, (F.col("th") == F.col("gone_th")) & F.col(f"row.`{id_column}`").eqNullSafe(F.col("gone_id")), "left")
    own = F.col(f"row.`{text_column}`")
    joined = joined.withColumn("lines", F.split(own, "\n"))
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"), lambda i: F.col("lines")[i])
    new = {text_column: F.when(F.col("gone").isNull(), own).otherwise(F.array_join(left, "\n")), "n_lines": F.coalesce(F.size("lines"), F.lit(0)).cast("long"), "n_removed": F.coalesce(F.size("gone"), F.lit(0)).cast("long")}
    columns = [*docs.columns, *(c for c in ("n_lines", "n_removed") if c not in docs.columns)]
    return joined.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in columns))


def oracle_sql(least_sites: int = LEAST_SITES, least_words: int = LEAST_WORDS) -> str:
    """dedupe_lines of ``documents`` in DuckDB's SQL, with exact counts throughout."""
    word = r"[^\x20\x09-\x0D]+"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, text, coalesce(source, chr(0)) AS site, md5(coalesce(text, '')) AS th FROM documents
), p AS (
  SELECT rid, site, th, i, ls[i] AS line FROM (SELECT rid, site, th, string_split(text, chr(10)) AS ls, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM d)
), l AS (
  SELECT rid, site, th, i, line, lower(array_to_string(regexp_extract_all(line, '{word}'), ' ')) AS x, len(regexp_extract_all(line, '{word}')) AS n FROM p
), b AS (
  SELECT x, min(th) AS owner FROM l WHERE n >= {least_words} GROUP BY x HAVING count(DISTINCT site) >= {least_sites}
), k AS (
  SELECT l.rid, l.i, l.line, b.x IS NOT NULL AND l.th <> b.owner AS gone FROM l LEFT JOIN b ON l.x = b.x AND l.n >= {least_words}
), r AS (
  SELECT rid, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text FROM k GROUP BY rid
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE r.text END AS text, CAST(coalesce(r.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(r.n_removed, 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN r USING (rid)
"""
