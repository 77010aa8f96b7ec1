"""URL filters: host and path rules, and link-graph propagation for what no rule covers.

Trust flows from allowed hosts along links (personalised PageRank); distrust flows from blocked
hosts against them: who links to a blocked host is suspect, by the share of its own links that lead to
distrusted hosts, however many others link there. Both run as joins and grouped
sums over host edges, with partial sums before each shuffle, so a host with a third of all links is one key
of a pre-aggregated sum and of a join that may be split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, spread_join, union_all, written

#: (verdict, host and path prefix)
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
DAMPING = 0.85
#: Masses are carried on until no host can gain more than EPSILON * DAMPING / (1 - DAMPING) by what is still on its way.
EPSILON = 1e-3
#: So many steps of mass are summed up at a time.
FOLDED = 8
#: A host is blocked when its distrust reaches this and outweighs its trust. Seeds have up to 1 - DAMPING of their own,
#: scaled here to 1. A host without blocked pages reaches it from 59 % of its links on, where those lead to fully blocked hosts.
LEAST_DISTRUST = 0.5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The index of the longest rule that fits, or null."""
    out = F.lit(None).cast("int")
    for i in sorted(range(len(rules)), key=lambda i: len(rules[i][1])):
        of, slash, rest = rules[i][1].partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(slash + rest)
        out = F.when(fits, i).otherwise(out)
    return out


def propagate(edges: DataFrame, seeds: DataFrame, *, damping: float = DAMPING, epsilon: float = EPSILON, shared_by: str = "src") -> DataFrame:
    """(host, mass): seed mass plus what arrives along edges (src, dst, n), weighted by n.

    mass = seed + damping * arriving, so a seed without links keeps exactly its own. The
    outgoing shares of a host sum to 1, or with ``shared_by`` dst the incoming ones. What is on its way is sent on until
    it is at most ``epsilon``: its sum, as all of it could meet in one host, or with shared incoming links its
    greatest value, as no host can then receive more. Either shrinks by ``damping`` a step, so the steps grow
    with the logarithm of the seeds at most.
    """
    total = edges.groupBy(shared_by).agg(F.sum("n").alias("total"))
    shares = written(edges.join(total, shared_by).select(F.col("src").alias("host"), "dst", (F.col("n") / F.col("total")).alias("share")), "shares")
    start = seeds.select("host", F.col("seed").alias("mass"))
    n_edges = shares.count()
    if not n_edges:
        return start
    degrees = written(shares.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "degrees")
    added = lambda tables: written(union_all(tables).groupBy("host").agg(F.sum("mass").alias("mass")), "mass")
    left = F.sum("mass") if shared_by == "src" else F.max("mass")
    steps = [written(start.filter("mass > 0"), "mass")]
    while True:
        of = degrees.join(steps[-1], "host", "left").withColumn("wanted", F.col("mass").isNotNull())
        arriving = spread_join(shares, of, "host", n_edges).groupBy(F.col("dst").alias("host")).agg((damping * F.sum(F.col("mass") * F.col("share"))).alias("mass"))
        steps.append(written(arriving, "step"))
        if (steps[-1].agg(left).first()[0] or 0.0) <= epsilon:
            break
        if len(steps) > FOLDED:
            folded = added(steps[:-1])
            dropped(*steps[:-1])
            steps = [folded, steps[-1]]
    mass = added(steps)
    dropped(*steps, shares, degrees)
    return seeds.select("host").join(mass, "host", "full").select("host", F.coalesce("mass", F.lit(0.0)).alias("mass"))


def host_edges(pages: DataFrame, *, html_column: str = "html") -> DataFrame:
    """(src, dst, n) of links between different hosts, from rows of (host, html)."""
    links = pages.filter("host <> ''").select(F.col("host").alias("src"), F.explode(F.regexp_extract_all(html_column, F.lit(_LINK), F.lit(1))).alias("dst"))
    links = links.withColumn("dst", F.translate("dst", _UPPER, _LOWER)).filter("src <> dst")
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def judge_urls(pages: DataFrame, *, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", rules: Sequence[tuple[str, str]] = RULES, damping: float = DAMPING, epsilon: float = EPSILON, least_distrust: float = LEAST_DISTRUST) -> DataFrame:
    """One row per page: the id, host, path, rule, verdict, trust, distrust.

    The longest fitting rule decides. Elsewhere the host does: the share of its pages that rules
    allow (block) seeds its trust (distrust), which links spread; it is blocked from
    ``least_distrust`` on if distrust outweighs trust, else allowed. A null url, or one without
    ``://``, has an empty host and path and is allowed; null html has no links; repeated rows are
    judged alike; other columns are not read; no rows give no rows.
    """
    host, path = url_host(F.col(url_column)), url_path(F.col(url_column))
    named = pages.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path"), F.col(html_column).alias("html"))
    edges = written(host_edges(named, html_column="html"), "links")
    judged = named.drop("html").withColumn("_rule", longest_rule(F.col("host"), F.col("path"), rules))
    verdicts = F.array(*(F.lit(v) for v, _ in rules))
    judged = written(judged.withColumn("ruled", F.get(verdicts, F.col("_rule"))), "judged")
    share = lambda v: F.avg(F.when(F.col("ruled") == v, 1.0).otherwise(0.0))
    seeds = written(judged.filter("host <> ''").groupBy("host").agg(share("allow").alias("allowed"), share("block").alias("blocked")), "seeds")
    trust = propagate(edges, seeds.select("host", F.col("allowed").alias("seed")), damping=damping, epsilon=epsilon)
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    distrust = propagate(back, seeds.select("host", F.col("blocked").alias("seed")), damping=damping, epsilon=epsilon, shared_by="dst")
    hosts = seeds.select("host").join(trust.withColumnRenamed("mass", "trust"), "host", "left").join(distrust.withColumnRenamed("mass", "distrust"), "host", "left")
    hosts = written(hosts, "hosts").withColumnRenamed("host", "_host")
    out = judged.join(hosts, F.col("host") == F.col("_host"), "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    method = F.when((distrust >= least_distrust) & (distrust > trust), "block").otherwise("allow")
    prefixes = F.array(*(F.lit(p) for _, p in rules))
    return out.select(F.col("id").alias(id_column), "host", "path", F.get(prefixes, F.col("_rule")).alias("rule"), F.coalesce("ruled", method).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))
