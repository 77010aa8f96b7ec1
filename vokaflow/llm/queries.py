"""The queries of the training-data operators, with the SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import line_dedup, quality
from .common import TEXTS_PER_BATCH, table, written


def op1_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages in one population: pages bring markup and addresses, a document's host is its source."""
    from . import language_id as li
    from .url_filter import url_host

    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    nothing = F.lit(None).cast("long")
    host = url_host(F.col("url"))
    rows = docs.select("doc_id", nothing.alias("page_id"), "text", F.lit("").alias("declared"), F.col("source").alias("host"), F.lit("").alias("suffix")).unionByName(
        pages.select(nothing.alias("doc_id"), "page_id", li.visible_text(F.col("html")).alias("text"), li.declared_language(F.col("html")).alias("declared"), host.alias("host"), li.host_suffix(host).alias("suffix"))
    )
    return li.identify(rows, li.train(docs))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicate_classes

    return near_duplicate_classes(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer=public_tokenizers.path("byte_bpe_50k.json"))


def op4_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op5_line_frequency_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_rules

    ruled = quality_rules(table(spark, sf_dir, "documents")).drop("source", "text_hash", "lost_lines")
    return ruled.withColumn("n_left_words", F.col("n_words") - F.col("n_lost_words"))


def op6_telephony_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .telephony import decode_media, store_texts

    # The files are stored, and all else comes from what is read back.
    stored = written(store_texts(table(spark, sf_dir, "documents")), "media", TEXTS_PER_BATCH)
    read = decode_media(stored)
    digest = lambda c: F.sha2(c, 256)
    size = lambda c: F.length(c).cast("long")
    return read.select(
        "doc_id", "n_bytes", size("payload").alias("payload_bytes"), digest("payload").alias("payload_sha256"), F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"),
        size("media").alias("media_bytes"), digest("media").alias("media_sha256"), "feature", size("pcm").alias("pcm_bytes"), digest("pcm").alias("pcm_sha256"),
    )


def op7_credential_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import scan_secrets

    scanned = scan_secrets(table(spark, sf_dir, "documents"))
    return scanned.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


def op8_link_graph_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"))


def op9_bloom_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scoring import score_documents

    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    scored = score_documents(docs.withColumn("doc_id", F.struct("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"))), docs.filter(~F.coalesce(held_out, F.lit(False))))
    return scored.select("doc_id.doc_id", "doc_id.held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_line_site_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedupe_lines

    return dedupe_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: f for name, f in list(globals().items()) if name.startswith(("op", "pipeline")) and callable(f)}
ORACLE_SQL: dict[str, str] = {"op5_line_frequency_quality": quality.oracle_sql(), "op10_line_site_spread": line_dedup.oracle_sql()}
