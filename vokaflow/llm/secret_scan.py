"""Secret scans with multipart credential linking, in DataFrame functions only.

Strong patterns are always reported. Weak ones (an account identifier, a random-looking value, an
endpoint) are reported only where complementary parts lie in one scope, found by an interval
semi-join on cells of the scope's width: each part stands in every cell that it touches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from vokaflow.functions.text import bound

from .common import text_or_empty, written

#: (kind, pattern, group whose length counts (0: the match), least length). Strong kinds come first.
STRONG = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
WEAK = (
    ("ident", r"""(?<![A-Za-z0-9_])(?:client_id|access_key_id|account_id|username|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{4,}|(?<![A-Za-z0-9])(?:ASIA|AROA|AIDA)[A-Z0-9]{16,}""", 0, 1),
    ("value", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}", 0, 1),
    ("endpoint", r"""(?:https?|wss?|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+""", 0, 1),
)
#: What a match must hold besides, and what a text must hold to have a match at all.
HOLDS = {"value": ("[0-9]", "[A-Za-z]")}
ONLY_WITH = {"access": ("AKIA",), "endpoint": ("://",), "ident": ("user", "login", "_id", "ASIA", "AROA", "AIDA")}
KINDS = tuple(k[0] for k in STRONG + WEAK)
#: What a span is a part of a credential as.
ROLES = {"access": "id", "ident": "id", "assign": "secret", "hex": "secret", "value": "secret", "endpoint": "endpoint"}
#: Characters between the end of one part and the start of the next that belong together, at most.
SCOPE = 300


def _pieces(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """(characters before the match and after the last one, its length, whether it counts) of each match; null if none."""
    of_match = lambda m: F.length(F.regexp_extract(m, pattern, group) if group else m) >= least
    counts = lambda m: reduce(lambda x, p: x & m.rlike(p), HOLDS.get(kind, ()), of_match(m))
    gaps = F.transform(F.split(text, pattern), F.length)
    each = lambda found: F.transform(found, lambda m, i: F.struct(F.length(m).alias("n"), counts(m).alias("counts"), i.alias("at")))
    zipped = bound(gaps, lambda g: F.transform(each(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), lambda m: F.struct(g[m["at"]].alias("gap"), m["n"].alias("n"), m["counts"].alias("counts"))))
    has = reduce(Column.__or__, (F.contains(text, F.lit(x)) for x in ONLY_WITH[kind])) if kind in ONLY_WITH else F.lit(True)
    return F.when(has & text.rlike(pattern), zipped)


def find_spans(found: DataFrame, *, scope: int = SCOPE) -> DataFrame:
    """(rid, kind, start, end) of all reported spans of rows with a unique ``rid`` and a column of matches per kind.

    Places are code points, the end exclusive. Each kind's matches are leftmost and do not
    overlap; one that is too short is dropped after it has taken its place.
    """
    found = found.filter(" or ".join(f"{k} is not null" for k in KINDS))
    each = found.select("rid", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), F.col(k).alias("all")) for k in KINDS))).alias("x"))
    each = each.select("rid", "x.kind", F.posexplode("x.all").alias("at", "m"))
    end = F.sum(F.col("m.gap") + F.col("m.n")).over(Window.partitionBy("rid", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    spans = each.withColumn("end", end).filter("m.counts").select("rid", "kind", (F.col("end") - F.col("m.n")).alias("start"), "end")
    spans = written(spans, "spans")

    role = F.create_map(*(F.lit(x) for kv in ROLES.items() for x in kv))[F.col("kind")]
    placed = spans.withColumn("role", role)
    cell = lambda c: F.floor(c / scope)
    cells = lambda a, b: F.explode(F.sequence(cell(a), cell(b)))
    start, end = F.col("start"), F.col("end")
    # Of all parts that touch a cell only the least start and the greatest end matter, so a crowded scope makes no pairs.
    parts = placed.filter("role <> 'endpoint'").select("rid", "role", "start", "end", cells(start, end).alias("cell")).groupBy("rid", "cell")
    near = parts.agg(*(f(F.when(F.col("role") == r, F.col(c))).alias(f"{r}_{c}") for r in ("id", "secret") for c, f in (("start", F.min), ("end", F.max))))
    # A part is near if it starts no later than a scope behind this one and ends no earlier than a scope before it.
    weak = placed.filter(F.col("kind").isin(*(k[0] for k in WEAK))).select("*", cells(start - scope, end + scope).alias("cell")).join(near, ["rid", "cell"])
    has = lambda r: F.max((F.col(f"{r}_start") <= end + scope) & (F.col(f"{r}_end") >= start - scope))
    linked = weak.groupBy("rid", "kind", "role", "start", "end").agg(F.coalesce(has("id"), F.lit(False)).alias("id"), F.coalesce(has("secret"), F.lit(False)).alias("secret"))
    linked = linked.filter(F.when(F.col("role") == "id", F.col("secret")).when(F.col("role") == "secret", F.col("id")).otherwise(F.col("id") & F.col("secret")))
    return spans.filter(F.col("kind").isin(*(k[0] for k in STRONG))).unionByName(linked.select("rid", "kind", "start", "end"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["order"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: the id, n_<strong kind> each, base (the strong spans), spans (all).

    Spans are kind:start:end, by start and then in the order of KINDS, joined by commas. A null or
    empty text has none; repeated rows are scanned each; other columns are not read; no rows give no rows.
    """
    text = text_or_empty(text_column)
    found = docs.select(F.col(id_column).alias("id"), *(_pieces(text, k, p, g, n).alias(k) for k, p, g, n in STRONG + WEAK))
    keyed = written(found.withColumn("rid", F.monotonically_increasing_id()), "matches")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    spans = find_spans(keyed, scope=scope).select("rid", F.struct("start", order.alias("order"), "end").alias("s"))
    by = spans.groupBy("rid").agg(F.sort_array(F.collect_list("s")).alias("all"))
    strong = F.filter("all", lambda s: s["order"] < len(STRONG))
    out = keyed.select("rid", "id").join(by, "rid", "left")
    count = lambda i: F.coalesce(F.size(F.filter("all", lambda s: s["order"] == i)), F.lit(0)).cast("long")
    return out.select(F.col("id").alias(id_column), *(count(i).alias(f"n_{k[0]}") for i, k in enumerate(STRONG)), F.coalesce(_joined(strong), F.lit("")).alias("base"), F.coalesce(_joined(F.col("all")), F.lit("")).alias("spans"))
