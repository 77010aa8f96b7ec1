"""The engine's operators as queries on the driver tables, each with the SQL it must equal.

No driver table holds audio or Turkish text. Fixed views stand in: manifest rows from documents,
metrics and buckets by arithmetic on ids. Figures derived from them measure nothing real.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vokaflow.functions import match, numbers, phonemes, signal, text
from vokaflow.functions.normalize import normalize_text
from vokaflow.operators import audit, curate, export, manifest
from vokaflow import sinks
from vokaflow.sources import audio
from vokaflow.sources.manifest import MANIFEST_SCHEMA, config_summary, numbered_lines, parse_manifest, read_audit, read_buckets, read_manifest, read_metadata, resolved
from vokaflow.streaming import milestones

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

TERMS = ("the", "straße", "é", "schön", "absent term")
#: SQL's class of white space and of solid characters, as the engine's.
SP, SOLID = r"[\s\x1c-\x1f\x85\p{Z}]", r"[^\s\x1c-\x1f\x85\p{Z}]"
MANIFEST = (
    "doc_id", "doc_id + 1 AS line_no", "concat(source, '/', CAST(doc_id AS STRING), '.wav') AS audio_filepath", "text", "CAST(n_chars AS DOUBLE) / 15e0 AS duration", "source AS speaker_id",
    "CASE WHEN doc_id % 40 = 0 THEN 'val' WHEN doc_id % 40 = 1 THEN 'test' ELSE 'train' END AS split",
)
METRICS = (
    "doc_id + 1 AS manifest_line", "concat(source, '/', CAST(doc_id AS STRING), '.wav') AS audio_filepath", "text", "CAST(n_chars AS DOUBLE) / 15e0 AS audio_duration_sec",
    "-10e0 - (doc_id % 37) * 0.75e0 AS rms_level_db", "-((doc_id % 23) * 0.625e0) AS peak_level_db", "(doc_id % 19) / 1024e0 AS clipping_ratio", "(doc_id % 11) * 0.0625e0 AS leading_silence_sec",
    "(doc_id % 13) * 0.0625e0 AS trailing_silence_sec", "(doc_id % 17) * 0.03125e0 AS internal_silence_ratio", "(doc_id % 29) * 0.03125e0 AS longest_internal_gap_sec",
)
BUCKETS = (
    "CASE WHEN doc_id % 5 = 0 THEN 'n/a' ELSE concat(CAST(doc_id + 1 AS STRING), '.7') END AS line_no",
    "CASE WHEN doc_id % 7 = 0 THEN '' ELSE concat('src', CAST(doc_id % 20 AS STRING), '/', CAST(doc_id AS STRING), '.wav') END AS audio_filepath",
    "CASE WHEN toxic = 1 THEN 'bad_or_reject_like' WHEN quality = 1 THEN 'good' ELSE 'suspicious' END AS bucket",
    "concat(CASE WHEN doc_id % 3 = 0 THEN 'longest_internal_gap_too_high|' ELSE '' END, CASE WHEN doc_id % 4 = 0 THEN 'peak_near_clip||' ELSE '' END, CASE WHEN doc_id % 6 = 1 THEN 'low_energy_ratio_too_high|low_energy_ratio_too_high' ELSE '' END) AS bucket_reasons",
    "CAST((doc_id % 20) * 0.0625e0 AS STRING) AS longest_internal_gap_sec", "CAST(doc_id % 9 AS STRING) AS internal_gap_count", "'' AS internal_silence_ratio",
    "CASE WHEN doc_id % 8 = 0 THEN 'x' ELSE CAST((doc_id % 10) * 0.125e0 AS STRING) END AS low_energy_ratio",
)
M, A, B = (f"(SELECT {', '.join(cols)} FROM {t})" for cols, t in ((MANIFEST, "documents"), (METRICS, "documents"), (BUCKETS, "labels")))
#: The stand-in metrics need wider limits than speech.
LIMITS = replace(audit.AuditThresholds(), max_text_chars=4000, max_duration_sec=250.0)


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _manifest(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "documents").selectExpr(*MANIFEST)


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "documents").selectExpr(*METRICS)


def _buckets(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "labels").selectExpr(*BUCKETS)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# --- scan and project


@query("SELECT doc_id + 1 AS line_no, doc_id, text, source FROM documents")
def jsonl_scan(spark, d):
    lines = _table(spark, d, "documents").select((F.col("doc_id") + 1).alias("line_no"), F.to_json(F.struct("doc_id", "text", "source")).alias("value"))
    return parse_manifest(lines, "doc_id long, text string, source string", "drop").select("line_no", "doc_id", "text", "source")


@query("SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN text WHEN doc_id % 2 = 0 THEN source ELSE lang END AS value FROM documents")
def alias_coalesce(spark, d):
    rows = _table(spark, d, "documents").selectExpr("doc_id", "CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END AS text", "CASE WHEN doc_id % 2 = 0 THEN source END AS sentence", "lang AS normalized_text")
    return rows.select("doc_id", text.first_filled("text", "sentence", "normalized_text").alias("value"))


@query(f"SELECT line_no, duration FROM {M} WHERE duration BETWEEN 0.5 AND 20")
def duration_filter(spark, d):
    return _manifest(spark, d).filter(F.col("duration").between(manifest.MIN_DURATION, manifest.MAX_DURATION)).select("line_no", "duration")


@query(f"SELECT doc_id, text FROM documents WHERE regexp_matches(text, '{SOLID}')")
def nonblank_filter(spark, d):
    return _table(spark, d, "documents").filter(~text.is_blank("text")).select("doc_id", "text")


@query(f"SELECT count(*) AS total, count(*) FILTER (WHERE bad) AS filtered, count(*) FILTER (WHERE NOT bad) AS kept FROM (SELECT text IS NULL OR NOT regexp_matches(text, '{SOLID}') OR NOT coalesce(duration BETWEEN 0.5 AND 20, false) AS bad FROM {M})")
def filtered_count(spark, d):
    return manifest.filtered_count(_manifest(spark, d))


@query(f"SELECT line_no, split FROM {M}")
def union_splits(spark, d):
    rows = _manifest(spark, d).select("line_no", "split")
    parts = [rows.filter(F.col("split") == s) for s in manifest.SPLITS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT d.doc_id, l.quality, CASE WHEN l.doc_id IS NULL THEN 'no_text' END AS drop_reason FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def pair_join(spark, d):
    labels = _table(spark, d, "labels").withColumn("there", F.lit(True))
    return _table(spark, d, "documents").join(labels, "doc_id", "left").select("doc_id", "quality", F.when(F.col("there").isNull(), "no_text").alias("drop_reason"))


# --- validation

_V = ("line_no", "CASE WHEN doc_id % 31 = 0 THEN NULL ELSE audio_filepath END AS audio_filepath", "CASE WHEN doc_id % 29 = 0 THEN NULL ELSE speaker_id END AS speaker_id", "CASE WHEN doc_id % 23 = 0 THEN '  ' ELSE text END AS text", "text AS normalized_text", "CASE WHEN doc_id % 19 = 0 THEN '' ELSE 'a b' END AS phonemes", "duration")
_MISSING = "concat_ws(', ', CASE WHEN audio_filepath IS NULL THEN '''audio_filepath''' END, CASE WHEN speaker_id IS NULL THEN '''speaker_id''' END)"
_ERROR = f"""SELECT line_no, 'line ' || line_no || ': ' || CASE WHEN {_MISSING} <> '' THEN 'missing fields: [' || {_MISSING} || ']'
 WHEN NOT duration BETWEEN 0.5 AND 200 THEN 'duration ' || printf('%.3f', duration) || 's outside [0.5, 200.0]'
 WHEN NOT regexp_matches(text, '{SOLID}') THEN 'empty text' WHEN NOT regexp_matches(phonemes, '{SOLID}') THEN 'empty phonemes' END AS error FROM (SELECT {", ".join(_V)} FROM {M})"""


@query(f"SELECT * FROM ({_ERROR}) WHERE error IS NOT NULL")
def validate_rows(spark, d):
    return manifest.validate(_manifest(spark, d).selectExpr(*_V), max_duration=200.0)


@query(f"SELECT count(*) FILTER (WHERE error IS NULL) AS valid, count(error) AS errors FROM ({_ERROR})")
def validate_summary(spark, d):
    return manifest.validation_summary(_manifest(spark, d).selectExpr(*_V), max_duration=200.0)


_LINE = "CASE WHEN doc_id % 11 = 0 THEN CAST(doc_id AS STRING) WHEN doc_id % 13 = 0 THEN concat(' |', source) WHEN doc_id % 17 = 0 THEN concat(CAST(doc_id AS STRING), '| ') ELSE concat(CAST(doc_id AS STRING), '|', source, '|words') END"


@query(f"""SELECT * FROM (SELECT d.doc_id + 1 AS line_no, 'metadata.csv line ' || (d.doc_id + 1) || ': ' || CASE WHEN d.doc_id % 11 = 0 THEN 'too few columns' WHEN d.doc_id % 13 = 0 THEN 'empty stem'
 WHEN d.doc_id % 17 = 0 THEN 'empty text for stem ''' || d.doc_id || '''' WHEN l.doc_id IS NULL THEN 'wavs/' || d.doc_id || '.wav not found' END AS error FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) WHERE error IS NOT NULL""")
def validate_export_rows(spark, d):
    lines = _table(spark, d, "documents").selectExpr("doc_id + 1 AS line_no", f"{_LINE} AS value")
    return export.validate_metadata(lines, _table(spark, d, "labels").selectExpr("CAST(doc_id AS STRING) AS stem"))


# --- text


def _scalar(name: str, table: str, key: str, column: str, function, sql: str | None) -> None:
    def run(spark, d):
        return _table(spark, d, table).select(key, function(F.col(column)).alias("value"))

    run.__name__ = name
    query(sql and f"SELECT {key}, {sql.format(c=column)} AS value FROM {table}")(run)


_W = r"[\p{L}\p{N}_]"
_SQL_PLAIN = "trim(regexp_replace(translate(nfc_normalize({c}), '“”‘’«»„—–()[]', '\"\"''''\"\"\",,    '), '" + SP.replace("{", "{{").replace("}", "}}") + "+', ' ', 'g'))"
_b = lambda s: s.replace("{", "{{").replace("}", "}}")


def _sql_abbreviations(c: str) -> str:
    """A word boundary by captures, each replacement twice because the separator is consumed."""
    for a in sorted(text.ABBREVIATIONS, key=len, reverse=True):
        right = "($|[^\\p{L}\\p{N}_])" if a[-1].isalpha() else "()"
        for _ in range(2):
            c = f"regexp_replace({c}, '(^|[^\\p{{L}}\\p{{N}}_]){a.replace('.', chr(92) + '.')}{right}', '\\1{text.ABBREVIATIONS[a]}\\2', 'g')"
    return c


def _sql_words(n: str) -> str:
    """Words of a whole number below 10**12, from lists."""
    ones, tens = (lambda k, names="|".join(names): f"split_part('{names}', '|', CAST({k} + 1 AS INTEGER))" for names in (numbers.ONES, numbers.TENS))
    below = lambda x: f"concat_ws(' ', CASE WHEN {x} // 100 = 1 THEN 'yüz' WHEN {x} >= 200 THEN {ones(f'{x} // 100')} || ' yüz' END, nullif({tens(f'{x} // 10 % 10')}, ''), nullif({ones(f'{x} % 10')}, ''))"
    group = lambda p: f"({n} // {p} % 1000)"
    large = ", ".join(f"CASE WHEN {group(p)} > 0 THEN {below(group(p))} || ' {name}' END" for p, name in ((10**9, "milyar"), (10**6, "milyon")))
    thousand = f"CASE WHEN {group(1000)} = 1 THEN 'bin' WHEN {group(1000)} > 1 THEN {below(group(1000))} || ' bin' END"
    return f"CASE WHEN {n} = 0 THEN 'sıfır' ELSE concat_ws(' ', {large}, {thousand}, CASE WHEN {group(1)} > 0 THEN {below(group(1))} END) END"


def _sql_long_words(n: str) -> str:
    """Words of a whole number of 18 digits at most: trillions are counted like numbers of their own."""
    low, high = "(n % 1000000000000)", "(n // 1000000000000)"
    of = lambda x: f"list_transform([{x}], lambda n: {_sql_words('n')})[1]"
    large = f"concat_ws(' ', CASE WHEN {high} > 0 THEN {of(high)} || ' trilyon' END, CASE WHEN {low} > 0 THEN {of(low)} END)"
    return f"list_transform([CAST({n} AS BIGINT)], lambda n: CASE WHEN n < 1000000000000 THEN {_sql_words('n')} ELSE {large} END)[1]"


def _sql_numbers(c: str) -> str:
    """Each pass fences its matches, and again between them as a match takes its boundaries, splits at the fences and maps every other piece."""
    o, z = text.FENCES
    edge = rf"[^\p{{L}}\p{{N}}_{o}{z}]"
    digits = lambda x: f"regexp_replace({x}, '[^0-9]', '', 'g')"
    plain = lambda x: _sql_long_words(digits(x))
    decimal = lambda x: f"{plain(f'split_part({x}, {chr(39)},{chr(39)}, 1)')} || ' virgül ' || {plain(f'split_part({x}, {chr(39)},{chr(39)}, 2)')}"
    ordinal = lambda x: f"list_transform([{plain(x)}], lambda w: w || {_SQL_SUFFIX.format(v='regexp_extract(w, {0}.*([aıeioöuü]){0}, 1)'.format(chr(39)))})[1]"
    passes = (
        ("()", rf"%{SP}*[0-9]+", "()", lambda x: f"'yüzde ' || {plain(x)}"), (f"(^|{edge})", r"[0-9]{1,3}(?:\.[0-9]{3})+,[0-9]+", f"($|{edge})", decimal), (f"(^|{edge})", r"[0-9]{1,3}(?:\.[0-9]{3})+", f"($|{edge})", plain),
        (f"(^|{edge})", "[0-9]+,[0-9]+", f"($|{edge})", decimal), (f"(^|{edge})", r"[0-9]+\.", r"([ \t])", ordinal), (f"(^|{edge})", "[0-9]+", f"($|{edge})", plain),
    )
    c = f"translate({c}, '{o}{z}', '')"
    for left, pattern, right, words in passes:
        fenced = lambda x: f"regexp_replace({x}, '{left}({pattern}){right}', '\\1{o}\\2{o}\\3', 'g')"  # noqa: B023, E731
        pieces = lambda x, found, rest: f"list_aggregate(list_transform(string_split({x}, '{o}'), lambda x, i: CASE WHEN i % 2 = 0 THEN {found} ELSE {rest} END), 'string_agg', '')"
        c = pieces(pieces(fenced(c), f"'{o}' || x || '{o}'", fenced("x")), words("x"), "x")
    return c


_SQL_SUFFIX = "CASE WHEN {v} IN ('a', 'ı') THEN 'ıncı' WHEN {v} IN ('o', 'u') THEN 'uncu' WHEN {v} IN ('ö', 'ü') THEN 'üncü' ELSE 'inci' END"


def _sql_markup(c: str) -> str:
    for pattern in ("<[^>]+>", rf"https?://{SOLID}+|www\.{SOLID}+", rf"{SOLID}+@{SOLID}+\.[a-zA-Z]{{2,}}", f"@{_W}+", f"#{_W}+"):
        c = f"regexp_replace({c}, '{pattern}', ' ', 'g')"
    return c


def _sql_normalized(c: str) -> str:
    """A whole text by way of every step; the punctuation step composes too."""
    return _sql_numbers(_sql_abbreviations(_SQL_PLAIN.format(c=_sql_markup(c))))


_scalar("strip_html", "pages", "page_id", "html", text.strip_html, "regexp_replace({c}, '<[^>]+>', ' ', 'g')")
_scalar("strip_urls", "pages", "page_id", "url", text.strip_urls, _b(f"regexp_replace(url, 'https?://{SOLID}+|www\\.{SOLID}+', ' ', 'g')"))
_scalar("strip_emails", "documents", "doc_id", "text", text.strip_emails, _b(f"regexp_replace(text, '{SOLID}+@{SOLID}+\\.[a-zA-Z]{{2,}}', ' ', 'g')"))
_scalar("strip_mentions", "documents", "doc_id", "text", text.strip_mentions, _b(f"regexp_replace(text, '@{_W}+', ' ', 'g')"))
_scalar("strip_hashtags", "documents", "doc_id", "text", text.strip_hashtags, _b(f"regexp_replace(text, '#{_W}+', ' ', 'g')"))
_scalar("nfc", "documents", "doc_id", "text", text.nfc, "nfc_normalize({c})")
_scalar("normalize_punctuation", "documents", "doc_id", "text", text.normalize_punctuation, _SQL_PLAIN)
_scalar("normalize_abbreviations", "documents", "doc_id", "text", text.normalize_abbreviations, _b(_sql_abbreviations("text")))
_scalar("normalize_numbers", "documents", "doc_id", "text", numbers.normalize_numbers, _b(_sql_numbers("text")))
_scalar("normalize_text", "documents", "doc_id", "text", normalize_text, _b(_sql_normalized("text")))
_scalar("casefold_text", "documents", "doc_id", "text", text.casefold, "translate(replace(lower(replace({c}, 'İ', 'i̇')), 'ß', 'ss'), 'ς', 'σ')")


@query(f"SELECT doc_id, length(t) AS text_length, len(regexp_extract_all(t, '{SOLID}+')) AS word_count, CASE WHEN n > 0 THEN length(t) / n ELSE 0 END AS chars_per_sec FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '^{SP}+', ''), '{SP}+$', '') AS t, CAST(n_chars AS DOUBLE) / 15e0 AS n FROM documents)")
def text_stats(spark, d):
    rows = _table(spark, d, "documents").selectExpr("doc_id", "text", "CAST(n_chars AS DOUBLE) / 15e0 AS audio_duration_sec")
    return audit.with_text_stats(rows).select("doc_id", F.col("text_length").cast("long").alias("text_length"), F.col("word_count").cast("long").alias("word_count"), "chars_per_sec")


@query("SELECT conv_id, turn, len(string_split(text, '')) AS n_codepoints, string_split(text, '')[1] AS first FROM conversations WHERE text <> ''")
def codepoints(spark, d):
    one = F.get(phonemes.codepoints("text"), 0)
    return _table(spark, d, "conversations").filter("text <> ''").select("conv_id", "turn", F.size(one).cast("long").alias("n_codepoints"), F.get(one, 0).alias("first"))


# --- number words


_N = "SELECT o_orderkey AS n FROM orders UNION SELECT o_orderkey * 7919 FROM orders UNION SELECT CAST(p_size AS BIGINT) FROM part UNION SELECT CAST(l_linenumber AS BIGINT) * 1000 FROM lineitem"


def _numbers(spark, d) -> DataFrame:
    orders = _table(spark, d, "orders").select(F.col("o_orderkey").alias("n"))
    more = [orders.select((F.col("n") * 7919).alias("n")), _table(spark, d, "part").select(F.col("p_size").cast("long").alias("n")), _table(spark, d, "lineitem").select((F.col("l_linenumber").cast("long") * 1000).alias("n"))]
    return orders.union(more[0]).union(more[1]).union(more[2]).distinct()


@query(f"SELECT n, {_sql_words('n')} AS words FROM ({_N})")
def number_words(spark, d):
    return _numbers(spark, d).select("n", numbers.number_words("n").alias("words"))


@query(f"SELECT n, w || CASE WHEN v IN ('a', 'ı') THEN 'ıncı' WHEN v IN ('o', 'u') THEN 'uncu' WHEN v IN ('ö', 'ü') THEN 'üncü' ELSE 'inci' END AS words FROM (SELECT n, w, regexp_extract(w, '.*([aıeioöuü])', 1) AS v FROM (SELECT n, {_sql_words('n')} AS w FROM ({_N})))")
def ordinal_words(spark, d):
    return _numbers(spark, d).select("n", numbers.ordinal_words("n").alias("words"))


# --- phonemes

_G2P = "CASE c WHEN 'ı' THEN 'ɯ' WHEN 'ö' THEN 'ø' WHEN 'ü' THEN 'y' WHEN 'c' THEN 'dʒ' WHEN 'ç' THEN 'tʃ' WHEN 'j' THEN 'ʒ' WHEN 'r' THEN 'ɾ' WHEN 'ş' THEN 'ʃ' WHEN 'y' THEN 'j' WHEN ' ' THEN '_' ELSE CASE WHEN c IN ('.', ',', '!', '?', ';', ':', '-') THEN '~' ELSE c END END"
_CHARS = "string_split(lower(replace(text, 'İ', 'i̇')), '')"
_PHONES = f"list_transform(list_filter(list_transform({_CHARS}, lambda c, i: CASE WHEN c = 'ğ' THEN CASE WHEN i > 1 AND ({_CHARS})[i - 1] IN ('e', 'i', 'ö', 'ü') THEN 'y' ELSE '' END ELSE c END), lambda c: c <> ''), lambda c: {_G2P})"
_ALPHABET = "'" + phonemes.ID_ORDER.replace("'", "''") + "'"
_ID = f"CASE WHEN length(p) = 1 THEN list_position(string_split({_ALPHABET}, ''), p) - 1 END"


def _phones(spark, d) -> DataFrame:
    return _table(spark, d, "conversations").select("conv_id", "turn", F.array_remove(F.split(phonemes.phonemize("text"), " "), "").alias("p"))


@query(f"SELECT conv_id, turn, array_to_string({_PHONES}, ' ') AS phonemes FROM conversations")
def phonemize(spark, d):
    return _table(spark, d, "conversations").select("conv_id", "turn", phonemes.phonemize("text").alias("phonemes"))


@query(f"SELECT conv_id, turn, array_to_string(list_concat(list_concat([1, 0], flatten(list_transform(list_filter(list_transform({_PHONES}, lambda p: {_ID}), lambda i: i IS NOT NULL), lambda i: [i, 0]))), [2]), ',') AS ids FROM conversations")
def phoneme_ids(spark, d):
    return _phones(spark, d).select("conv_id", "turn", F.array_join(F.transform(phonemes.phoneme_ids("p"), lambda i: i.cast("string")), ",").alias("ids"))


@query(f"SELECT p AS phoneme, count(*) AS n FROM (SELECT unnest({_PHONES}) AS p FROM conversations) WHERE ({_ID}) IS NULL GROUP BY p")
def missing_phonemes(spark, d):
    return _phones(spark, d).select(F.explode(phonemes.missing_phonemes("p")).alias("phoneme")).groupBy("phoneme").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT DISTINCT unnest(regexp_extract_all(array_to_string({_PHONES}, ' '), '{SOLID}+')) AS symbol FROM conversations ORDER BY symbol")
def symbol_inventory(spark, d):
    return manifest.symbol_inventory(_table(spark, d, "conversations").select(phonemes.phonemize("text").alias("phonemes")))


_STRIPPED = f"regexp_replace(regexp_replace(text, '^{SP}+', ''), '{SP}+$', '')"


@query(f"""SELECT line_no, split, audio_filepath, text, normalized_text, phonemes, round_even(duration, 4) AS duration, speaker_id FROM (
 SELECT *, array_to_string({_PHONES.replace("(text,", "(normalized_text,")}, ' ') AS phonemes FROM (
  SELECT line_no, split, audio_filepath, duration, speaker_id, {_STRIPPED} AS text, {_sql_normalized(_STRIPPED)} AS normalized_text FROM {M} WHERE duration BETWEEN 0.5 AND 5000 AND regexp_matches(text, '{SOLID}')))
 WHERE regexp_matches(normalized_text, '{SOLID}') AND regexp_matches(phonemes, '{SOLID}')""")
def manifest_prepare(spark, d):
    return manifest.prepare_manifest(_manifest(spark, d), max_duration=5000.0, keep=("line_no", "split"))


# --- audit

_CLAMP = "greatest(0e0, least(1e0, {0}))".format


def _sql_range(v: str, low: float, high: float, w: float) -> str:
    return f"CASE WHEN {v} >= {low}e0 AND {v} <= {high}e0 THEN {w}e0 WHEN {v} < {low}e0 THEN {w}e0 * {_CLAMP(f'({v}) / {max(low, 1e-6)!r}::DOUBLE')} ELSE {w}e0 * {_CLAMP(f'1e0 - ({v} - {high}e0) / {max(high, 1e-6)!r}::DOUBLE')} END"


_STATS = f"SELECT *, length(t) AS text_length, len(regexp_extract_all(t, '{SOLID}+')) AS word_count, CASE WHEN audio_duration_sec > 0 THEN length(t) / audio_duration_sec ELSE 0e0 END AS chars_per_sec, CASE WHEN audio_duration_sec > 0 THEN len(regexp_extract_all(t, '{SOLID}+')) / audio_duration_sec ELSE 0e0 END AS words_per_sec FROM (SELECT *, regexp_replace(regexp_replace(text, '^{SP}+', ''), '{SP}+$', '') AS t FROM {A})"
_SCORE = (
    f"{_sql_range('audio_duration_sec', 1.0, 12.0, 20.0)} + {_sql_range('chars_per_sec', 8.0, 18.0, 20.0)} + 20e0 * {_CLAMP('1e0 - greatest(0e0, greatest(leading_silence_sec / 0.5::DOUBLE, trailing_silence_sec / 0.7::DOUBLE, internal_silence_ratio / 0.4::DOUBLE, longest_internal_gap_sec / 0.45::DOUBLE) - 1e0)')}"
    f" + ({_sql_range('rms_level_db', -26.0, -14.0, 12.0)} + {_sql_range('(-peak_level_db)', 0.7, 12.0, 8.0)}) + CASE WHEN clipping_ratio <= 0.01::DOUBLE THEN 20e0 ELSE 20e0 * {_CLAMP('1e0 - (clipping_ratio - 0.01::DOUBLE) / 0.01::DOUBLE')} END"
    " - CASE WHEN words_per_sec > 4.5 THEN 5e0 ELSE 0e0 END - CASE WHEN words_per_sec < 1 AND audio_duration_sec > 0 THEN 5e0 ELSE 0e0 END"
)
_TESTS = (
    ("duration_too_short", "audio_duration_sec < 0.8::DOUBLE"), ("duration_too_long", "audio_duration_sec > 250"), ("text_too_short", "text_length < 3"), ("text_too_long", "text_length > 4000"),
    ("chars_per_sec_too_low", "chars_per_sec < 6"), ("chars_per_sec_too_high", "chars_per_sec > 22"), ("leading_silence_too_high", "leading_silence_sec > 0.5"), ("trailing_silence_too_high", "trailing_silence_sec > 0.7::DOUBLE"),
    ("internal_silence_too_high", "internal_silence_ratio > 0.4::DOUBLE"), ("longest_internal_gap_too_high", "longest_internal_gap_sec > 0.45::DOUBLE"), ("clipping_too_high", "clipping_ratio > 0.01::DOUBLE"),
    ("rms_too_low", "rms_level_db < -30"), ("peak_too_high", "peak_level_db > -0.5"),
)
_AUDITED = (
    "SELECT *, CASE WHEN list_has_any(reasons, [" + ", ".join(f"'{r}'" for r in audit.SEVERE) + "]) OR quality_score < 50 THEN 'reject' WHEN quality_score >= 75 AND len(reasons) = 0 THEN 'keep' ELSE 'suspicious' END AS status FROM ("
    f"SELECT *, CAST(round_even(greatest(0e0, least(100e0, {_SCORE})), 0) AS INTEGER) AS quality_score, list_filter([{', '.join(f'CASE WHEN {t} THEN {chr(39)}{r}{chr(39)} END' for r, t in _TESTS)}], lambda x: x IS NOT NULL) AS reasons FROM ({_STATS}))"
)


def _audited(spark, d) -> DataFrame:
    return audit.audit(_metrics(spark, d), LIMITS)


@query("SELECT event_id, CASE WHEN value <= 0 THEN -100e0 ELSE 20e0 * log10(value) END AS db FROM events")
def safe_db(spark, d):
    return _table(spark, d, "events").select("event_id", signal.safe_db(F.col("value")).alias("db"))


@query(f"SELECT event_id, {_sql_range('value', 8.0, 18.0, 20.0)} AS score, CASE WHEN value <= 30 THEN 20e0 ELSE 20e0 * {_CLAMP('1e0 - (value - 30e0) / 30e0')} END AS ceiling FROM events")
def score_range(spark, d):
    v = F.col("value")
    return _table(spark, d, "events").select("event_id", signal.score_range(v, 8.0, 18.0, 20.0).alias("score"), signal.score_ceiling(v, 30.0, 20.0).alias("ceiling"))


@query(f"SELECT manifest_line, quality_score FROM ({_AUDITED})")
def quality_score(spark, d):
    return _audited(spark, d).select("manifest_line", "quality_score")


@query(f"SELECT manifest_line, array_to_string(reasons, ';') AS reasons FROM ({_AUDITED})")
def audit_reasons(spark, d):
    return _audited(spark, d).select("manifest_line", F.array_join("reasons", ";").alias("reasons"))


@query(f"SELECT manifest_line, status FROM ({_AUDITED})")
def audit_status(spark, d):
    return _audited(spark, d).select("manifest_line", "status")


@query(f"SELECT count(*) AS total, count(*) FILTER (WHERE status = 'keep') AS keep, count(*) FILTER (WHERE status = 'suspicious') AS suspicious, count(*) FILTER (WHERE status = 'reject') AS reject, round(avg(quality_score), 6) AS mean_quality_score FROM ({_AUDITED})")
def audit_summary(spark, d):
    return audit.audit_summary(_audited(spark, d)).select("total", *audit.STATUSES, F.round("mean_quality_score", 6).alias("mean_quality_score"))


@query(f"SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM ({_AUDITED})) GROUP BY reason")
def reason_histogram(spark, d):
    return audit.reason_histogram(_audited(spark, d))


@query(f"SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM ({_AUDITED})) GROUP BY reason ORDER BY n DESC, reason LIMIT 10")
def top_reasons(spark, d):
    return audit.top_reasons(_audited(spark, d))


@query("SELECT 'value' AS metric, round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max FROM events UNION ALL SELECT 'user_id', round(avg(user_id), 6), min(user_id), max(user_id) FROM events")
def numeric_stats(spark, d):
    return audit.numeric_stats(_table(spark, d, "events"), ["value", "user_id"]).withColumn("mean", F.round("mean", 6))


@query(f"SELECT manifest_line, quality_score FROM ({_AUDITED}) WHERE status = 'keep'")
def filter_strict(spark, d):
    return _audited(spark, d).filter(audit.mode_filter("strict")).select("manifest_line", "quality_score")


@query(f"SELECT manifest_line, status FROM ({_AUDITED}) WHERE status <> 'reject'")
def filter_balanced(spark, d):
    return _audited(spark, d).filter(audit.mode_filter("balanced")).select("manifest_line", "status")


@query(f"SELECT 'balanced' AS mode, count(*) FILTER (WHERE status <> 'reject') AS kept, count(*) AS total, count(*) FILTER (WHERE status = 'reject') AS dropped FROM ({_AUDITED})")
def filter_totals(spark, d):
    return audit.filter_totals(_audited(spark, d), "balanced")


@query(f"SELECT line_no, split FROM {M} WHERE line_no IN (SELECT manifest_line FROM ({_AUDITED}) WHERE status = 'suspicious')")
def semi_join_filter(spark, d):
    return audit.filter_lines(_manifest(spark, d).select("line_no", "split"), _audited(spark, d), "suspicious")


# --- statistics


@query(f"SELECT round_even(sum(duration) / 3600, 3) AS total_hours, count(*) AS total_count, count(DISTINCT speaker_id) AS speaker_count, array_to_string(list_sort(list(DISTINCT speaker_id)), ',') AS speakers FROM {M}")
def manifest_stats(spark, d):
    return manifest.manifest_stats(_manifest(spark, d))


@query(f"SELECT split, count(*) AS n FROM {M} GROUP BY split")
def split_counts(spark, d):
    return _manifest(spark, d).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT speaker, row_number() OVER (ORDER BY speaker) - 1 AS id FROM (SELECT DISTINCT source AS speaker FROM documents)")
def speaker_ids(spark, d):
    return export.speaker_ids(_manifest(spark, d))


@query("SELECT 'test' AS split, greatest(1, CAST(floor(count(*) * 0.025) AS BIGINT)) AS n FROM documents UNION ALL SELECT 'val', greatest(1, CAST(floor(count(*) * 0.025) AS BIGINT)) FROM documents UNION ALL SELECT 'train', count(*) - 2 * greatest(1, CAST(floor(count(*) * 0.025) AS BIGINT)) FROM documents")
def ratio_split(spark, d):
    return manifest.ratio_split(_manifest(spark, d).select("line_no"), "line_no").groupBy("split").agg(F.count(F.lit(1)).alias("n"))


# --- terms

_FOLD = "translate(replace(lower(replace(text, 'İ', 'i̇')), 'ß', 'ss'), 'ς', 'σ')"
_has = lambda t: f"contains({_FOLD}, '{t.casefold()}')"
_list = lambda terms: "list_filter([" + ", ".join(f"CASE WHEN {_has(t)} THEN '{t}' END" for t in terms) + "], lambda x: x IS NOT NULL)"
_CHARACTERS = match.TARGET_CHARACTERS


@query("SELECT doc_id, " + ", ".join(f"{_has(t)} AS t{i}" for i, t in enumerate(TERMS)) + " FROM documents")
def term_match(spark, d):
    return _table(spark, d, "documents").select("doc_id", *(match.has_term("text", t).alias(f"t{i}") for i, t in enumerate(TERMS)))


@query("SELECT doc_id, " + " OR ".join(_has(c) for c in _CHARACTERS) + " AS any_char FROM documents")
def char_match(spark, d):
    return _table(spark, d, "documents").select("doc_id", (F.size(match.matched("text", _CHARACTERS)) > 0).alias("any_char"))


def _sql_hits(terms, source, name):
    return " UNION ALL ".join(f"SELECT '{t}' AS term, count(*) FILTER (WHERE {_has(t)}) AS {name} FROM {source}" for t in terms)


@query(f"SELECT * FROM ({_sql_hits(TERMS, 'documents', 'n')}) ORDER BY n DESC, term")
def term_counts(spark, d):
    return curate.term_hits(_table(spark, d, "documents"), TERMS, "n").orderBy(F.desc("n"), "term")


@query(f"SELECT * FROM ({_sql_hits(_CHARACTERS, 'documents', 'n')}) ORDER BY n DESC, term")
def char_counts(spark, d):
    return curate.term_hits(_table(spark, d, "documents"), _CHARACTERS, "n").orderBy(F.desc("n"), "term")


@query(f"SELECT line_no, text, audio_filepath, array_to_string({_list(TERMS)}, '|') AS matched_terms, array_to_string({_list(_CHARACTERS)}, '|') AS matched_chars FROM {M} WHERE len({_list(TERMS)}) > 0")
def term_audit_rows(spark, d):
    rows = _manifest(spark, d).withColumn("terms", match.matched("text", TERMS)).filter(F.size("terms") > 0)
    return rows.select("line_no", "text", "audio_filepath", F.array_join("terms", "|").alias("matched_terms"), F.array_join(match.matched("text", _CHARACTERS), "|").alias("matched_chars"))


@query(f"SELECT count(*) AS total_rows, count(*) FILTER (WHERE len({_list(TERMS)}) > 0) AS rows_with_any_term, count(*) FILTER (WHERE len({_list(_CHARACTERS)}) > 0) AS rows_with_any_char FROM conversations")
def term_audit_summary(spark, d):
    rows = _table(spark, d, "conversations")
    return rows.agg(F.count(F.lit(1)).alias("total_rows"), F.count_if(F.size(match.matched("text", TERMS)) > 0).alias("rows_with_any_term"), F.count_if(F.size(match.matched("text", _CHARACTERS)) > 0).alias("rows_with_any_char"))


# --- curation

_SET = "list_distinct(list_filter(string_split(bucket_reasons, '|'), lambda x: x <> ''))"
_HARD = f"list_has_any({_SET}, [" + ", ".join(f"'{r}'" for r in curate.HARD_REASONS) + "])"
_RELAXED = " OR ".join(f"(list_contains({_SET}, '{r}') AND coalesce(try_cast(trim({c}) AS DOUBLE) >= {v}, false))" for r, c, v in curate.RELAXED)
_EXCLUDED = {"aggressive": "bucket = 'bad_or_reject_like'", "hard": f"bucket = 'bad_or_reject_like' AND {_HARD}", "relaxed": f"bucket = 'bad_or_reject_like' AND ({_HARD} OR {_RELAXED})"}
_LINE_KEY = "CAST(trunc(try_cast(trim(line_no) AS DOUBLE)) AS BIGINT)"
_paths = lambda where: f"(SELECT DISTINCT trim(audio_filepath) AS k FROM {B} WHERE trim(audio_filepath) <> '' AND {where})"
_lines = lambda where: f"(SELECT DISTINCT {_LINE_KEY} AS k FROM {B} WHERE {_LINE_KEY} IS NOT NULL AND {where})"
_KEPT = f"(SELECT * FROM {M} WHERE audio_filepath NOT IN {_paths(_EXCLUDED['aggressive'])} AND line_no NOT IN {_lines(_EXCLUDED['aggressive'])})"
#: A manifest in which every ninth row has no audio path.
_MP = f"(SELECT line_no, CASE WHEN doc_id % 9 = 0 THEN '' ELSE audio_filepath END AS audio_filepath, text FROM {M})"
_named = lambda names: f"CASE WHEN audio_filepath <> '' THEN audio_filepath IN {_paths(f'bucket IN {names}')} ELSE line_no IN {_lines(f'bucket IN {names}')} END"
_ANY = "(" + " OR ".join(_has(t) for t in TERMS[1:]) + ")"
_FLAGGED = f"(SELECT *, NOT excluded AND listed AND {_ANY} AS candidate FROM (SELECT *, {_named(chr(40) + chr(39) + 'bad_or_reject_like' + chr(39) + chr(41))} AS excluded, {_named(chr(40) + chr(39) + 'good' + chr(39) + chr(41))} AS listed FROM {_MP}))"


def _sql_oversample(n: int, base: bool = True) -> str:
    more = f"SELECT 1 AS phase, line_no, c AS copy, text FROM (SELECT *, unnest(generate_series(1, {n})) AS c FROM {_FLAGGED} WHERE candidate)"
    return f"SELECT 0 AS phase, line_no, 1 AS copy, text FROM {_FLAGGED} WHERE NOT excluded UNION ALL {more}" if base else more


def _with_paths(spark, d) -> DataFrame:
    return _manifest(spark, d).selectExpr("line_no", "CASE WHEN doc_id % 9 = 0 THEN '' ELSE audio_filepath END AS audio_filepath", "text")


def _flagged(spark, d) -> DataFrame:
    return curate.target_candidates(_with_paths(spark, d), _buckets(spark, d), TERMS[1:])


def _exclusion(mode: str) -> None:
    def run(spark, d):
        rows = _buckets(spark, d)
        return rows.select("line_no", "audio_filepath", curate.excluded(mode).alias("excluded"))

    run.__name__ = f"bucket_exclusion_{mode}"
    query(f"SELECT line_no, audio_filepath, {_EXCLUDED[mode]} AS excluded FROM {B}")(run)


for _mode in curate.EXCLUSION_MODES:
    _exclusion(_mode)


@query(f"SELECT line_no, audio_filepath FROM {_KEPT}")
def anti_join_or(spark, d):
    rows = _manifest(spark, d).select("line_no", "audio_filepath")
    return curate.exclude_either(rows, *curate.exclusion_keys(_buckets(spark, d))).select("line_no", "audio_filepath")


@query(f"SELECT line_no, audio_filepath, excluded FROM {_FLAGGED}")
def anti_join_fallback(spark, d):
    return _flagged(spark, d).select("line_no", "audio_filepath", "excluded")


@query(f"SELECT 'audio_filepath' AS key, count(*) FILTER (WHERE k IN (SELECT audio_filepath FROM {M})) AS matched, count(*) FILTER (WHERE k NOT IN (SELECT audio_filepath FROM {M})) AS unmatched FROM {_paths(_EXCLUDED['relaxed'])} UNION ALL SELECT 'line_no', count(*) FILTER (WHERE k IN (SELECT line_no FROM {M})), count(*) FILTER (WHERE k NOT IN (SELECT line_no FROM {M})) FROM {_lines(_EXCLUDED['relaxed'])}")
def unmatched_keys(spark, d):
    return curate.unmatched_keys(_manifest(spark, d), *curate.exclusion_keys(_buckets(spark, d), "relaxed"))


@query(f"SELECT count(*) AS bucket_rows_total, count(*) FILTER (WHERE bucket = 'bad_or_reject_like') AS bucket_rows_matching_bucket, count(*) FILTER (WHERE {_EXCLUDED['relaxed']}) AS bucket_rows_selected_for_exclusion, count(*) FILTER (WHERE {_EXCLUDED['relaxed']} AND trim(audio_filepath) <> '') AS bucket_rows_with_audio_key, count(*) FILTER (WHERE {_EXCLUDED['relaxed']} AND {_LINE_KEY} IS NOT NULL) AS bucket_rows_with_line_key FROM {B}")
def bucket_stats(spark, d):
    return curate.bucket_stats(_buckets(spark, d), "relaxed")


@query(f"SELECT bucket, count(*) AS n FROM {B} GROUP BY bucket ORDER BY bucket")
def bucket_counts(spark, d):
    return curate.bucket_counts(_buckets(spark, d))


@query(f"SELECT reason, count(*) AS n FROM (SELECT unnest({_SET}) AS reason FROM {B} WHERE {_EXCLUDED['aggressive']}) GROUP BY reason ORDER BY n DESC, reason LIMIT 20")
def bucket_reason_counts(spark, d):
    return curate.bucket_reason_counts(_buckets(spark, d))


_two = lambda a, b: f"(SELECT * FROM ({_sql_hits(TERMS, a, 'before')}) JOIN ({_sql_hits(TERMS, b, 'after')}) USING (term))"


@query(f"SELECT *, CASE WHEN retention < 0.8 THEN 'WARNING' ELSE 'OK' END AS status FROM (SELECT *, CASE WHEN before <= 0 THEN 1e0 ELSE after / before END AS retention FROM {_two(M, _KEPT)})")
def term_retention(spark, d):
    rows = _manifest(spark, d)
    return curate.term_retention(rows, curate.exclude_either(rows, *curate.exclusion_keys(_buckets(spark, d))), TERMS)


@query(f"SELECT line_no, audio_filepath FROM {_FLAGGED} WHERE candidate")
def target_candidates(spark, d):
    return _flagged(spark, d).filter("candidate").select("line_no", "audio_filepath")


def _oversampled(name: str, mode: str, sql: str, most_rows: int | None = None) -> None:
    def run(spark, d):
        return curate.oversample(_flagged(spark, d), mode, most_rows=most_rows).select(F.col("phase").cast("long").alias("phase"), "line_no", F.col("copy").cast("long").alias("copy"))

    run.__name__ = name
    query(f"SELECT CAST(phase AS BIGINT) AS phase, line_no, CAST(copy AS BIGINT) AS copy FROM ({sql})")(run)


_oversampled("oversample_conservative", "conservative", _sql_oversample(1))
_oversampled("oversample_weighted", "weighted", _sql_oversample(2))
_oversampled("oversample_target_only", "target_only", _sql_oversample(1, False))
_oversampled("oversample_cap", "weighted", f"SELECT * FROM ({_sql_oversample(2)}) ORDER BY phase, line_no, copy LIMIT 900", 900)


@query(f"SELECT *, CASE WHEN before <= 0 THEN 0e0 ELSE after / before END AS exposure FROM {_two(_MP, '(' + _sql_oversample(2) + ')')}")
def term_exposure(spark, d):
    return curate.term_exposure(_with_paths(spark, d), curate.oversample(_flagged(spark, d), "weighted"), TERMS)


@query(f"SELECT warning FROM (SELECT CASE WHEN before = 0 THEN 'target term absent from base manifest: ' || term WHEN after <= 5 THEN 'target term remains sparse after build: ' || term || ' (' || after || ')' END AS warning FROM {_two(_MP, '(' + _sql_oversample(2) + ')')}) WHERE warning IS NOT NULL")
def build_warnings(spark, d):
    base = _with_paths(spark, d)
    built = curate.oversample(_flagged(spark, d), "weighted")
    return curate.build_warnings(curate.term_exposure(base, built, TERMS), base.count(), built.count())


# --- export

_STEM = "split_part(split_part(audio_filepath, '/', 2), '.', 1)"
_SHARED = f"(SELECT line_no, split, text, CAST(NULL AS STRING) AS normalized_text, speaker_id, concat(speaker_id, '/', CAST(doc_id % 100 AS STRING), '.wav') AS audio_filepath, CASE split WHEN 'train' THEN 1 WHEN 'val' THEN 2 ELSE 3 END AS o FROM {M})"
_STEMMED = f"(SELECT *, CASE WHEN audio_filepath = own THEN base ELSE concat(base, '_', CAST(1 + count(*) FILTER (WHERE audio_filepath <> own) OVER (PARTITION BY base ORDER BY o, line_no) AS STRING)) END AS stem FROM (SELECT *, {_STEM} AS base, first_value(audio_filepath) OVER (PARTITION BY {_STEM} ORDER BY o, line_no) AS own FROM {_SHARED}))"


def _stemmed(spark, d) -> DataFrame:
    rows = _manifest(spark, d).selectExpr("line_no", "split", "text", "CAST(NULL AS STRING) AS normalized_text", "speaker_id", "concat(speaker_id, '/', CAST(doc_id % 100 AS STRING), '.wav') AS audio_filepath")
    return export.unique_stems(rows)


@query(f"SELECT line_no, audio_filepath, stem FROM {_STEMMED}")
def unique_stem(spark, d):
    return _stemmed(spark, d).select("line_no", "audio_filepath", "stem")


@query(f"SELECT split, line_no, concat_ws('|', stem, speaker_id, text) AS line FROM {_STEMMED}")
def export_metadata(spark, d):
    return export.metadata_lines(_stemmed(spark, d), True)


@query(f"SELECT stem, arg_max(split, o) AS split FROM {_STEMMED} GROUP BY stem")
def split_stems(spark, d):
    return export.split_stems(_stemmed(spark, d))


@query(f"SELECT line_no, split FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY line_no) AS r FROM {M}) WHERE r <= CASE WHEN split = 'train' THEN 100 ELSE 10 END")
def split_limit(spark, d):
    return export.cap_splits(_manifest(spark, d).select("line_no", "split"), 100)


# --- sources and sinks: what is written is read back


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder where the session keeps checkpoints; a temporary one only for a local session without."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(base or tempfile.mkdtemp(prefix='vokaflow-')).rstrip('/')}/vokaflow/{name}-{uuid.uuid4().hex}"


@query(f"SELECT line_no, audio_filepath, text, duration, speaker_id FROM {M}")
def manifest_sink(spark, d):
    path = _folder(spark, "manifest")
    sinks.write_jsonl(_manifest(spark, d).select("line_no", "audio_filepath", "text", "duration", "speaker_id"), ["line_no"], path)
    return read_manifest(spark, path, MANIFEST_SCHEMA, "fail").select("line_no", "audio_filepath", "text", "duration", "speaker_id")


@query("SELECT row_number() OVER (ORDER BY doc_id) AS line_no, concat(CAST(doc_id AS STRING), ' | ', source, ' é ') AS value FROM documents WHERE doc_id % 3 = 0")
def raw_line_sink(spark, d):
    path = _folder(spark, "lines")
    rows = _table(spark, d, "documents").filter("doc_id % 3 = 0").selectExpr("doc_id", "concat(CAST(doc_id AS STRING), ' | ', source, ' é ') AS value")
    sinks.write_lines(rows, "value", ["doc_id"], path)
    return numbered_lines(spark, path)


@query(f"SELECT manifest_line, t AS text, quality_score, status, array_to_string(reasons, ';') AS reasons FROM ({_AUDITED}) WHERE status = 'suspicious'")
def audit_csv_sink(spark, d):
    path = _folder(spark, "audit")
    sinks.write_audit(_audited(spark, d), path, "suspicious")
    return read_audit(spark, path).select(F.col("manifest_line").cast("long").alias("manifest_line"), "text", "quality_score", "status", F.array_join("reasons", ";").alias("reasons"))


@query(f"SELECT line_no, nullif(audio_filepath, '') AS audio_filepath, bucket, nullif(bucket_reasons, '') AS bucket_reasons, low_energy_ratio FROM {B}")
def bucket_csv_scan(spark, d):
    path = _folder(spark, "buckets")
    sinks.write_csv(_buckets(spark, d), ["audio_filepath", "line_no"], path)
    return read_buckets(spark, path).select("line_no", "audio_filepath", "bucket", "bucket_reasons", "low_energy_ratio")


@query("SELECT row_number() OVER (ORDER BY doc_id) AS line_no, CAST(doc_id AS STRING) AS stem, CASE WHEN doc_id % 2 = 0 THEN source END AS speaker, concat('\"', lang, '\" words') AS text FROM documents")
def pipe_metadata_scan(spark, d):
    path = _folder(spark, "metadata")
    line = "concat_ws('|', CAST(doc_id AS STRING), CASE WHEN doc_id % 2 = 0 THEN source END, concat('\"', lang, '\" words')) AS value"
    sinks.write_lines(_table(spark, d, "documents").selectExpr("doc_id", line), "value", ["doc_id"], path)
    return read_metadata(spark, path)


@query("SELECT doc_id, CASE WHEN doc_id % 5 > 0 THEN doc_id % 4 END AS n_map, CASE WHEN doc_id % 5 > 0 THEN 100 + doc_id END AS num_symbols, CASE WHEN doc_id % 5 > 0 THEN 22050 END AS sample_rate, CASE WHEN doc_id % 5 > 0 THEN lang END AS voice FROM documents")
def config_probe(spark, d):
    ids = "map_from_entries(transform(slice(sequence(1, 4), 1, CAST(doc_id % 4 AS INT)), x -> struct(CAST(x AS STRING) AS key, array(x) AS value)))"
    json = f"CASE WHEN doc_id % 5 = 0 THEN '{{no json' ELSE to_json(named_struct('num_symbols', 100 + doc_id, 'audio', named_struct('sample_rate', 22050), 'espeak', named_struct('voice', lang), 'phoneme_id_map', {ids})) END AS value"
    rows = _table(spark, d, "documents").selectExpr("doc_id", json).withColumn("c", config_summary("value"))
    return rows.select("doc_id", *(F.col(f"c.{n}").cast("long").alias(n) for n in ("n_map", "num_symbols", "sample_rate")), "c.voice")


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '/data/b/' WHEN 1 THEN '/' WHEN 2 THEN '../x/' ELSE '' END || CAST(doc_id AS STRING) || '.wav' AS path FROM documents")
def path_resolution(spark, d):
    head = "CASE doc_id % 4 WHEN 0 THEN '/data/a/../b/./' WHEN 1 THEN '/../a//..//' WHEN 2 THEN 'a/../../x/' ELSE './' END"
    return _table(spark, d, "documents").selectExpr("doc_id", f"concat({head}, CAST(doc_id AS STRING), '.wav') AS path").select("doc_id", resolved("path").alias("path"))


@query("SELECT user_id, max(CAST(event_id AS BIGINT)) AS step FROM events GROUP BY user_id")
def last_steps(spark, d):
    """The last training step of each run, where users stand for runs and events for steps."""
    return milestones.last_step(_table(spark, d, "events").select(F.col("user_id"), F.col("event_id").cast("long").alias("step")), "user_id")


# --- audio: files made of the tables' numbers, 20 ms of one level after the other

_LEVEL = "CASE WHEN (doc_id * 7 + i * i) % 5 < 2 THEN 0 ELSE 1 + (doc_id + i) % 3 END"


def _audio(spark, d) -> DataFrame:
    """(doc_id, content): mono 16-bit files of 1000 Hz, and some that are none."""
    le = lambda n: f"lpad(hex({n} % 256), 2, '0'), lpad(hex(({n}) DIV 256), 2, '0'), '0000'"
    size = "((1 + doc_id % 40) * 40)"
    data = f"array_join(transform(sequence(0, CAST(doc_id % 40 AS INT)), i -> repeat(element_at(array('0000', '0020', '0040', '0060'), CAST({_LEVEL} + 1 AS INT)), 20)), '')"
    head = f"'52494646', {le('(36 + ' + size + ')')}, '57415645', '666D7420', '10000000', '0100', '0100', 'E8030000', 'D0070000', '0200', '1000', '64617461', {le(size)}"
    return _table(spark, d, "documents").selectExpr("doc_id", f"CASE WHEN doc_id % 17 = 0 THEN CAST('no sound' AS BINARY) ELSE unhex(concat({head}, {data})) END AS content")


#: By hand: one digit a window, 0 for a silent one; core is without silence at its ends.
_WINDOWS = f"""SELECT *, length(ltrim(z, '0')) = 0 AS mute, length(z) - length(ltrim(z, '0')) AS lead, length(z) - length(rtrim(z, '0')) AS trail, trim(z, '0') AS core, list_transform(regexp_extract_all(trim(z, '0'), '0+'), lambda x: length(x)) AS runs FROM (
 SELECT doc_id, levels, length(z) AS n, z FROM (SELECT doc_id, levels, array_to_string(levels, '') AS z FROM (SELECT doc_id, list_transform(range(0, 1 + doc_id % 40), lambda i: {_LEVEL}) AS levels FROM documents WHERE doc_id % 17 <> 0)))"""
_RMS = "sqrt(list_sum(list_transform(levels, lambda x: x * x * 67108864.0)) / n)"


@query(f"""SELECT d.doc_id, n * 20 / 1000e0 AS audio_duration_sec, round(CASE WHEN mute THEN -100e0 ELSE 20 * log10({_RMS} / 32768) END, 3) AS rms_level_db, round(CASE WHEN mute THEN -100e0 ELSE 20 * log10(list_max(levels) / 4e0) END, 3) AS peak_level_db,
 CASE WHEN mute THEN n * 20 / 1000e0 WHEN n > 0 THEN greatest(0, 2 * lead - 1) * 10 / 1000e0 END AS leading_silence_sec, CASE WHEN mute THEN n * 20 / 1000e0 WHEN n > 0 THEN greatest(0, 20 * trail - 10) / 1000e0 END AS trailing_silence_sec,
 CASE WHEN mute THEN 1e0 WHEN n > 0 THEN coalesce(2 * list_sum(runs) - len(runs), 0) / CAST(2 * (n - trail) - greatest(0, 2 * lead - 1) AS DOUBLE) END AS internal_silence_ratio,
 CASE WHEN mute THEN n * 20 / 1000e0 WHEN n > 0 THEN greatest(0, coalesce(2 * list_max(runs) - 1, 0)) * 10 / 1000e0 END AS longest_internal_gap_sec, n IS NOT NULL AS rate_ok FROM documents d LEFT JOIN ({_WINDOWS}) w ON d.doc_id = w.doc_id""")
def audio_metrics(spark, d):
    rows = audio.with_metrics(_audio(spark, d), "audit")
    own = ("audio_duration_sec", "leading_silence_sec", "trailing_silence_sec", "internal_silence_ratio", "longest_internal_gap_sec")
    return rows.select("doc_id", *own, *(F.round(c, 3).alias(c) for c in ("rms_level_db", "peak_level_db")), audio.has_rate(1000).alias("rate_ok"))


@query(f"""SELECT d.doc_id, n * 20 / 1000e0 AS duration, round({_RMS}, 6) AS rms, list_max(levels) * 8192e0 AS peak, lead * 0.02e0 AS leading_silence_sec, CASE WHEN mute THEN n ELSE trail END * 0.02e0 AS trailing_silence_sec,
 CASE WHEN mute THEN 0e0 WHEN n > 0 THEN coalesce(list_sum(runs), 0) / CAST(length(core) AS DOUBLE) END AS internal_silence_ratio, CASE WHEN mute THEN 0 WHEN n > 0 THEN coalesce(list_max(runs), 0) END * 0.02e0 AS longest_internal_gap_sec,
 CAST(CASE WHEN mute THEN 0 ELSE len(list_filter(runs, lambda x: x >= 4)) END AS BIGINT) AS internal_gap_count, len(regexp_extract_all(z, '0')) / CAST(n AS DOUBLE) AS low_energy_ratio FROM documents d LEFT JOIN ({_WINDOWS}) w ON d.doc_id = w.doc_id""")
def term_audio_metrics(spark, d):
    rows = audio.with_metrics(_audio(spark, d), "term")
    own = ("duration", "peak", "leading_silence_sec", "trailing_silence_sec", "internal_silence_ratio", "longest_internal_gap_sec", "low_energy_ratio")
    return rows.select("doc_id", *own, F.round("rms", 6).alias("rms"), F.col("internal_gap_count").cast("long").alias("internal_gap_count"))


# --- runs

_RUNS = "(SELECT user_id, g, count(*) AS n FROM (SELECT user_id, quiet, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, quiet ORDER BY ts, event_id) AS g FROM (SELECT *, value <= 20 AS quiet FROM events)) WHERE quiet GROUP BY user_id, g)"


@query(f"SELECT user_id, max(n) AS longest, count(*) FILTER (WHERE n >= 2) AS gaps FROM {_RUNS} GROUP BY user_id")
def longest_run(spark, d):
    """Longest run and number of runs of quiet events, two long or more, per user."""
    from vokaflow.operators.runs import run_lengths

    rows = _table(spark, d, "events").withColumn("quiet", F.col("value") <= 20)
    return run_lengths(rows, "user_id", ["ts", "event_id"], "quiet").groupBy("user_id").agg(F.max("n").alias("longest"), F.count_if(F.col("n") >= 2).alias("gaps"))
