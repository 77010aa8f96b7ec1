"""The training-data pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each as Parquet in
the shared folder and reads it back as the next one's documents. All stages but the last keep the columns of documents.

A stage's operator decides on slim rows; the decision then meets the texts in one join on (id, text hash).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vokaflow.llm.common import dropped, scratch, text_or_empty, whole_row, written
from vokaflow.llm.line_dedup import dedupe_lines
from vokaflow.llm.mixing import mix_sources
from vokaflow.llm.near_dedup import near_duplicate_classes
from vokaflow.llm.packing import pack_documents
from vokaflow.llm.quality import quality_rules, without_lines


def _matched(docs: DataFrame, keys: DataFrame, how: str, *more: str) -> DataFrame:
    """(row, id, h, and the other columns of keys) of docs joined to rows of (doc_id, text_hash and the columns in more), null ids and all.

    The documents travel as one struct, so their columns may have any names.
    """
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").alias("id"), F.md5(text_or_empty("text").cast("binary")).alias("h"), *(F.col(c).alias(f"own_{c}") for c in more))
    keys = keys.withColumnsRenamed({"doc_id": "key_id", "text_hash": "key_h"} | {c: f"key_{c}" for c in more})
    on = (F.col("h") == F.col("key_h")) & F.col("id").eqNullSafe(F.col("key_id"))
    for c in more:
        on = on & F.col(f"own_{c}").eqNullSafe(F.col(f"key_{c}"))
    return rows.join(keys, on, how)


def _rows(matched: DataFrame, docs: DataFrame, text: Column | None = None, changed: Column | None = None) -> DataFrame:
    """The documents again; where ``changed`` holds, with this text and its length as n_chars."""
    own = lambda c: F.col(f"row.`{c}`")
    new = {}
    if text is not None:
        new = {"text": F.when(changed, text).otherwise(own("text"))}
        if "n_chars" in docs.columns:
            new["n_chars"] = F.when(changed, F.length(text)).otherwise(own("n_chars")).cast(docs.schema["n_chars"].dataType)
    return matched.select(*(new.get(c, own(c)).alias(c) for c in docs.columns))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, and from the others the lines that are frequent on their host; n_chars follows.

    A null or empty text has no words and goes; null sources are one host; repeated rows are one document and all
    of them stay or go; texts of any length are read whole; of documents that tie for a frequent line the one with the
    least text hash keeps it; other columns pass, whatever their names; no rows give no rows.
    """
    kept = quality_rules(docs).filter("kept").select("doc_id", "text_hash", "source", "lost_lines").distinct()
    found = _matched(docs, kept, "inner", "source")
    return _rows(found, docs, without_lines(F.col("row.text"), F.col("lost_lines")), F.col("lost_lines").isNotNull())


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cross-site boilerplate lines leave the texts; n_chars follows. Every document stays.

    A null text stays null, a text of which nothing is left becomes empty; null sources are one site; repeated rows are
    treated alike; texts of any length are split whole; of documents that tie for a line the one with the least text hash
    keeps it; other columns pass, whatever their names; no rows give no rows.
    """
    own = docs.select(whole_row(docs).alias("row"), "doc_id", "text", "source")
    clean = dedupe_lines(own)
    return _rows(clean, docs, F.col("text"), F.col("n_removed") > 0)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays: the one with the least id, and of equal ids the least text hash.

    Null texts count as empty and are copies of one another, so one of them stays; a null id is the least only where a class
    has no other; of repeated rows one stays; texts of any length are compared whole; other columns pass, whatever
    their names; no rows give no rows.
    """
    first = written(near_duplicate_classes(docs).filter("kept").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")), "kept")
    out = _matched(docs, first.select("doc_id", "text_hash"), "left_semi")
    # Only where a kept row is repeated do its repeats have to be told apart.
    return _rows(out if first.filter("n > 1").isEmpty() else out.dropDuplicates(["id", "h"]), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: its row repeated, or none.

    Null and empty texts have size 0 and are taken at their source's rate; null sources are one source, the last; repeated
    rows are documents of their own that share what they take; sizes that tie are ordered by a hash; texts of any length are
    counted whole; other columns pass, whatever their names; no rows give no rows.
    """
    taken = mix_sources(docs).groupBy("doc_id", "text_hash", "source").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n"))
    taken = written(taken.filter("copies > 0"), "taken")
    out = _matched(docs, taken, "inner", "source")
    if not taken.filter("n > 1").isEmpty():  # repeated rows share their copies
        out = out.dropDuplicates(["id", "h", "own_source"])
    return _rows(out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents in sequences of 1024 tokens; one row per piece.

    A null or empty text takes one place for its end; repeated rows are packed each on their own; longer texts are cut, never
    cropped; equal lengths are placed in the order of a hash; other columns are not read; no rows give no rows.
    """
    import public_tokenizers

    return pack_documents(docs, tokenizer=public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("MinHash near-dedup", near_duplicates), ("mixing", mixing), ("packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. What a stage wrote on its way, and its input, is deleted once its result is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with scratch(spark) as keep:
            docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            keep(docs)
        if before is not None:
            dropped(before)
        before = docs
    return docs


#: Signatures, balanced sampling and tokens are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None
