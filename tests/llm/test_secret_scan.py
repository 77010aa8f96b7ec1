import hashlib
import random
import re

from vokaflow.llm import queries
from vokaflow.llm.secret_scan import scan_secrets

BASE = (("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6), ("access", re.compile("(AKIA[A-Z0-9]+)"), 1, 20), ("hex", re.compile("([0-9a-f]+)"), 1, 24))


def base(text):
    spans = [(m.start(), i, f"{k}:{m.start()}:{m.end()}") for i, (k, p, g, n) in enumerate(BASE) for m in p.finditer(text or "") if len(m[g]) >= n]
    return [s[2] for s in sorted(spans)]


HEX = "0123456789abcdef01234567"
VALUE = "wJalrXUtnFEMI7K7MDENGbPxRfiCYzz0123456789"
TEXTS = [
    f"é🙂 password={HEX} and Token : 'abcdef' secret=abc TOKEN=12345 api_key=\"a.b-c_d\" {HEX}ff",
    "AKIA" + "A1" * 8 + " x AKIASHORT AKIA" + "Z" * 40,
    f"secret=token: abcdefgh passwd:={HEX}",
    None,
    "",
    "\n".join(["nothing here"] * 50),
    f"user=alice then {VALUE} at https://db.example.com/x",
    f"only {VALUE} alone",
    "only https://db.example.com/x",
    "user=alice" + " x" * 200 + f" {VALUE}",
    f"login: bob99 {'x' * 270} {VALUE} {'y' * 280} {VALUE}",
    f"token={HEX} " * 3000,
]


PARTS = {
    "access": (r"AKIA[A-Z0-9]+", "id"), "hex": (r"[0-9a-f]{24,}", "secret"),
    "ident": (r"""(?<![A-Za-z0-9_])(?:client_id|access_key_id|account_id|username|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{4,}|(?<![A-Za-z0-9])(?:ASIA|AROA|AIDA)[A-Z0-9]{16,}""", "id"),
    "value": (r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}", "secret"),
    "endpoint": (r"""(?:https?|wss?|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+""", "endpoint"),
}
ORDER = ("assign", "access", "hex", "ident", "value", "endpoint")


def linked(text, scope=300):
    """All spans, each weak part held against every other one."""
    found = [(m.start(), m.end(), "assign", "secret") for m in BASE[0][1].finditer(text) if len(m[2]) >= 6]
    for kind, (pattern, role) in PARTS.items():
        for m in re.finditer(pattern, text):
            if (kind != "access" or len(m[0]) >= 20) and (kind != "value" or (re.search("[0-9]", m[0]) and re.search("[A-Za-z]", m[0]))):
                found.append((m.start(), m.end(), kind, role))
    near = lambda s, e, role: any(r == role and a <= e + scope and b >= s - scope for a, b, _, r in found)
    needs = {"id": ("secret",), "secret": ("id",), "endpoint": ("id", "secret")}
    kept = [x for x in found if x[2] in ORDER[:3] or all(near(x[0], x[1], n) for n in needs[x[3]])]
    return ",".join(f"{k}:{s}:{e}" for s, e, k, _ in sorted(kept, key=lambda x: (x[0], ORDER.index(x[2]))))


def test_links_equal_all_pairs(spark):
    rng = random.Random(5)
    parts = ["user=alice", "login: bob99", "AIDA" + "Q7" * 9, "AKIA" + "B2" * 9, HEX, VALUE, "q" * 40, "secret=abcdefgh", "https://db.example.com/x", "https://e.org/" + "p" * 700, VALUE * 12]
    texts = ["".join(rng.choice(parts) + " " + "é z " * rng.choice([0, 1, 40, 70, 74, 75, 76, 100, 200]) for _ in range(rng.randrange(1, 14))) for _ in range(150)]
    texts += ["user=alice " + "x" * 250 + "1b2c3", "user=alice " + "7" * 250 + "b", "user=alice " + "x" * 250, f"{VALUE * 30} user=alice", " ".join([VALUE, "user=alice"] * 400)]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r["spans"] for r in scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        assert got[i] == linked(t), t
    assert got[150] and got[151] and not got[152] and got[153]


def test_scan(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "clash")]
    got = scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = base(TEXTS[r["doc_id"]])
        assert r["base"] == ",".join(want)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s.startswith(k + ":") for s in want) for k in ("assign", "access", "hex"))
        assert set(want) <= set(r["spans"].split(",")) or not want
    by = {r["doc_id"]: r["spans"] for r in got}
    assert [s.split(":")[0] for s in by[6].split(",")] == ["ident", "value", "endpoint"]
    assert by[7] == by[8] == by[9] == ""
    assert [s.split(":")[0] for s in by[10].split(",")] == ["ident", "value"]


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    for r in queries.op7_credential_linking(spark, "/root/testdata/sf0.01").collect():
        assert r["base_sha256"] == hashlib.sha256(",".join(base(docs[r["doc_id"]])).encode()).hexdigest()


def test_no_rows(spark):
    assert scan_secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0
