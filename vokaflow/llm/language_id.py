"""Language identification by Bayesian evidence fusion.

Four kinds of evidence meet in one posterior per row: the likelihood of the text (byte trigrams),
the language that the markup declares, a country-code address suffix, and a prior of
the host. The prior is smoothed hierarchically: a host's counts lean on those of its suffix, and
these on all rows. Counts are sums of posteriors from text and markup, made by grouped
aggregation; a row's own share is taken out of its host's counts before they are used on it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import TEXTS_PER_BATCH, spread_join, text_or_empty, written
from .hashing import mix, runs

#: The candidate languages; labels, declarations and suffixes of others are no evidence.
LANGUAGES = ("de", "en", "es", "fr")
#: The classifier is fitted on about so many labelled rows at most, chosen by a hash of the id.
TRAINING_ROWS = 50_000
#: The main language of country-code suffixes.
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "uk": "en", "us": "en", "au": "en", "ie": "en", "nz": "en", "es": "es", "mx": "es", "ar": "es", "cl": "es", "co": "es", "pe": "es", "fr": "fr"}
#: How often markup and suffix name the language that the text is in.
DECLARED_RIGHT, SUFFIX_RIGHT = 0.85, 0.7
#: Rows that a level of the prior weighs against its own counts.
STRENGTH = 10.0
#: Trigrams are not independent: a text counts as so many of them at most.
EFFECTIVE_TRIGRAMS = 40.0
BUCKETS = 1 << 15
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SLOT = [(mix(np.arange(256, dtype=np.uint64) + np.uint64(1000 * k)) & np.uint64(BUCKETS - 1)).astype(np.uint16) for k in (1, 2, 3)]


def trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each byte trigram of the joined texts, first, end): a text has those in [first, end)."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = _LOWER[np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    n = max(0, len(data) - 2)
    bucket = _SLOT[0][data[:n]] ^ _SLOT[1][data[1 : n + 1]] ^ _SLOT[2][data[2 : n + 2]]
    return bucket, np.minimum(offsets[:-1], n), np.minimum(np.maximum(offsets[1:] - 2, offsets[:-1]), n)


def _count(languages: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS), np.int64)
        for batch in batches:
            label = np.array([languages.index(x) for x in batch.column(0).to_pylist()], np.int64)
            for a, b in runs(batch.column(1)):
                bucket, first, end = trigrams(batch.column(1).slice(a, b - a))
                for i, (s, e) in enumerate(zip(first.tolist(), end.tolist(), strict=True), a):
                    counts[label[i]] += np.bincount(bucket[s:e], minlength=BUCKETS)
        lang, slot = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(slot.astype(np.int32)), pa.array(counts[lang, slot])], ["lang", "slot", "n"])

    return run


def train(labelled: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang", languages: Sequence[str] = LANGUAGES, rows: int = TRAINING_ROWS) -> np.ndarray:
    """log P(trigram bucket | language), add-one smoothed: one row per language. At most
    len(languages) * BUCKETS counts reach the driver."""
    usable = labelled.filter(F.col(label_column).isin(*languages))
    share = min(1.0, rows / max(1, usable.count()))
    # The whole range of the hash: a share of one row in 10**12 still picks rows.
    picked = usable.filter(F.shiftrightunsigned(F.xxhash64(id_column, text_column), 1) <= min((1 << 63) - 1, int(share * 2.0**63)))
    counted = picked.select(F.col(label_column).alias("lang"), text_or_empty(text_column).alias("text")).mapInArrow(_count(tuple(languages)), "lang int, slot int, n long")
    got = counted.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    counts = np.ones((len(languages), BUCKETS))
    counts[got["lang"], got["slot"]] += got["n"]
    return np.log(counts / counts.sum(axis=1, keepdims=True))


def _likelihood(table, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = np.ascontiguousarray(table.value.T)
        for batch in batches:
            for a, b in runs(batch.column(0)):
                part = batch.slice(a, b - a)
                bucket, first, end = trigrams(part.column(0))
                sums = np.concatenate([np.zeros((1, n)), np.cumsum(logs[bucket], axis=0)])
                length = end - first
                total = (sums[end] - sums[first]) * (np.minimum(length, EFFECTIVE_TRIGRAMS) / np.maximum(length, 1))[:, None]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *map(pa.array, (total - total.max(axis=1, keepdims=True)).T)], [*part.schema.names[1:], *(f"t{i}" for i in range(n))])

    return run


def visible_text(html: Column) -> Column:
    """Markup without comments, scripts, styles and tags."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")


def declared_language(html: Column) -> Column:
    """The primary subtag that the html element declares, in lower case; empty if none."""
    return F.lower(F.regexp_extract(F.coalesce(html, F.lit("")), r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?\s*([A-Za-z]{2,3})\b""", 1))


def host_suffix(host: Column) -> Column:
    return F.regexp_extract(F.coalesce(host, F.lit("")), r"([^.:]+)(?::[0-9]*)?$", 1)


def _named(column: str, right: float, languages: Sequence[str], i: int) -> Column:
    """log P(evidence names this language | row is in language i); no evidence says nothing."""
    wrong = (1 - right) / max(1, len(languages) - 1)
    return F.when(~F.col(column).isin(*languages), 0.0).otherwise(F.log(F.when(F.col(column) == languages[i], right).otherwise(wrong)))


def _posterior(df: DataFrame, scores: Sequence[Column], names: Sequence[str]) -> DataFrame:
    df = df.withColumns(dict(zip([f"_l{n}" for n in names], scores, strict=True)))
    most = F.greatest(*(f"_l{n}" for n in names)) if len(names) > 1 else F.col(f"_l{names[0]}")
    df = df.withColumn("_most", most).withColumns({f"_e{n}": F.exp(F.col(f"_l{n}") - F.col("_most")) for n in names})
    total = sum((F.col(f"_e{n}") for n in names), F.lit(0.0))
    return df.withColumns({n: F.col(f"_e{n}") / total for n in names}).drop("_most", *(f"_{x}{n}" for n in names for x in "le"))


def identify(rows: DataFrame, model: np.ndarray, *, languages: Sequence[str] = LANGUAGES) -> DataFrame:
    """Adds text_lang, lang and confidence to rows of (text, declared, host, suffix, ...); text goes.

    lang is the most probable language, the first of ``languages`` on a tie; a null or empty text
    is no evidence, so such a row follows its markup, suffix and host; nulls of these are no evidence either, and
    null hosts are one host. Repeated rows get equal results; texts of any length are read whole; other columns
    pass, whatever their names, but those of the three new names are replaced; no rows give no rows.
    """
    n = range(len(languages))
    table = rows.sparkSession.sparkContext.broadcast(model.astype(np.float64))
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    kept = [c for c in rows.columns if c not in ("text", "lang", "text_lang", "confidence")]
    passed = F.struct(*(F.col(f"`{c}`") for c in kept))
    own = rows.select(text_or_empty("text").alias("text"), blank("declared").alias("declared"), blank("suffix").alias("suffix"), F.xxhash64(F.coalesce(F.col("host").cast("string"), F.lit("\0")), blank("suffix")).alias("h"), passed.alias("row"))
    layout = T.StructType([*own.schema.fields[1:], *(T.StructField(f"t{i}", T.DoubleType()) for i in n)])
    scored = own.mapInArrow(_likelihood(table, len(languages)), layout)
    scored = scored.withColumn("cc", F.coalesce(F.create_map(*(F.lit(x) for kv in SUFFIX_LANGUAGE.items() for x in kv))[F.col("suffix")], F.lit("")))
    scored = written(_posterior(scored, [F.col(f"t{i}") + _named("declared", DECLARED_RIGHT, languages, i) for i in n], [f"p{i}" for i in n]), "likelihoods", TEXTS_PER_BATCH)

    sums = lambda names: [F.sum(a).alias(b) for a, b in names]
    host = scored.groupBy("h", "suffix").agg(F.count(F.lit(1)).alias("hn"), *sums((f"p{i}", f"h{i}") for i in n))
    host = written(host, "hosts")
    suffix = host.groupBy("suffix").agg(F.sum("hn").alias("sn"), *sums((f"h{i}", f"s{i}") for i in n))
    whole = host.agg(F.sum("hn"), *(F.sum(f"h{i}") for i in n)).first()  # one row: the totals
    total = whole[0] or 0
    base = [((whole[i + 1] or 0.0) + 1) / (total + len(languages)) for i in n]
    # Suffixes may be many, and one of them common to most hosts.
    by_suffix = suffix.join(host.groupBy("suffix").agg(F.count(F.lit(1)).alias("n")), "suffix").withColumn("wanted", F.lit(True))
    prior = spread_join(host, by_suffix, "suffix", host.count())
    prior = prior.select("h", F.col("hn").alias("n"), F.lit(True).alias("wanted"), "hn", *(f"h{i}" for i in n), *(((F.col(f"s{i}") + STRENGTH * base[i]) / (F.col("sn") + STRENGTH)).alias(f"q{i}") for i in n))
    joined = spread_join(scored, written(prior, "priors"), "h", total)
    fused = [
        F.col(f"t{i}") + _named("declared", DECLARED_RIGHT, languages, i) + _named("cc", SUFFIX_RIGHT, languages, i)
        + F.log((F.greatest(F.col(f"h{i}") - F.col(f"p{i}"), F.lit(0.0)) + STRENGTH * F.col(f"q{i}")) / (F.col("hn") - 1 + STRENGTH))
        for i in n
    ]
    out = _posterior(joined, fused, [f"f{i}" for i in n])
    best = lambda x: F.get(F.array(*map(F.lit, languages)), (F.array_position(F.array(*(f"{x}{i}" for i in n)), F.array_max(F.array(*(f"{x}{i}" for i in n)))) - 1).cast("int"))
    return out.select(*(F.col(f"row.`{c}`").alias(c) for c in kept), best("t").alias("text_lang"), best("f").alias("lang"), F.array_max(F.array(*(f"f{i}" for i in n))).alias("confidence"))
