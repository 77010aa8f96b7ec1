import random
import re
from collections import Counter

import numpy as np
import pytest

from vokaflow.llm import queries
from vokaflow.llm.url_filter import RULES, judge_urls, propagate


def brute(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(p), p, v) for v, p in RULES for h, _, q in [p.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + q)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTPS://A.Example.ORG/es/x?y#z", "http://example.org/en/17", "http://x.example.org:80/en/1", "http://org/", "http://org", "http://notorg/", "http://É.com/FR/", "http://a.com/fr/?://b.org/", "http://a.com/de/#x", "x://a.com?b/de/", "http://u@a.org/\nq"]
    pages = spark.createDataFrame([(i, u, None, "clash") for i, u in enumerate(urls)] + [(5, urls[5], "", "clash")], "page_id long, url string, html string, verdict string")
    got = judge_urls(pages).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        host, path, rule, verdict = brute(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and (verdict is None or r["verdict"] == verdict)


def test_links_spread_trust_and_distrust(spark):
    link = lambda *hosts: "".join(f'<a HREF="//{h}/x">y</a>' for h in hosts)
    rows = [
        (1, "http://bad.net/x", "", ), (2, "http://farm.net/x", link("bad.com", "Bad.com")), (3, "http://far.net/x", link("farm.net")),
        (4, "http://good.net/x", link("fine.org")), (5, "http://bad.com/de/", link("bad.net")), (6, "http://fine.org/x", link("good.net")), (7, "http://alone.net/", "<a href='/local'>"),
    ]
    got = {r["page_id"]: r for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[2]["verdict"] == "block" and got[3]["verdict"] == "block" and abs(got[3]["distrust"] - 0.85**2) < 1e-9
    assert got[1]["verdict"] == got[4]["verdict"] == got[7]["verdict"] == "allow"
    assert got[4]["trust"] > 0.8 and got[7]["trust"] == 0


@pytest.mark.parametrize("shared_by", ["src", "dst"])
def test_propagation_equals_a_dense_solve(spark, shared_by):
    rng = random.Random(3)
    hosts = [f"h{i}" for i in range(40)]
    edges = list({(a, b): (a, b, rng.randrange(1, 9)) for _ in range(130) for a, b in [rng.sample(hosts, 2)]}.values())
    edges += [("h0", f"leaf{i}", 1) for i in range(30)] + [(f"leaf{i}", "h1", 2) for i in range(30)]  # a hub and a sink
    seeds = {h: rng.choice([0.0, 0.0, 1.0, 0.25]) for h in hosts} | {"alone": 0.5}
    names = sorted({x for e in edges for x in e[:2]} | set(seeds))
    at = {h: i for i, h in enumerate(names)}
    total = Counter()
    for s, d, n in edges:
        total[s if shared_by == "src" else d] += n
    moved = np.zeros((len(names), len(names)))
    for s, d, n in edges:
        moved[at[d], at[s]] += 0.85 * n / total[s if shared_by == "src" else d]
    want = np.linalg.solve(np.eye(len(names)) - moved, [seeds.get(h, 0.0) for h in names])
    got = propagate(spark.createDataFrame(edges, "src string, dst string, n long"), spark.createDataFrame(list(seeds.items()), "host string, seed double"), shared_by=shared_by)
    got = {r["host"]: r["mass"] for r in got.collect()}
    assert set(seeds) <= got.keys() <= at.keys()
    assert all(abs(got.get(h, 0.0) - want[at[h]]) <= 1e-3 * 0.85 / 0.15 + 1e-9 for h in names)


def test_query(spark):
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = queries.op8_link_graph_urls(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = brute(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] == (verdict or r["verdict"])


def test_no_rows(spark):
    assert judge_urls(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_distrust_does_not_thin_out_over_many_linkers(spark):
    link = lambda *hosts: "".join(f'<a href="//{h}/x">y</a>' for h in hosts)
    rows = [(i, f"http://farm{i}.net/x", link("bad.com")) for i in range(200)] + [(500, "http://bad.com/de/", "")]
    rows += [(600, "http://paper.net/x", link("bad.com", *(f"other{k}.net" for k in range(9)))), (601, "http://mostly.net/x", link("bad.com", "bad.com", "bad.com", "other1.net"))]
    got = {r["page_id"]: r for r in judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i]["verdict"] == "block" and abs(got[i]["distrust"] - 0.85) < 1e-9 for i in range(200))
    assert got[600]["verdict"] == "allow" and abs(got[600]["distrust"] - 0.085) < 1e-9
    assert got[601]["verdict"] == "block" and abs(got[601]["distrust"] - 0.85 * 0.75) < 1e-9
