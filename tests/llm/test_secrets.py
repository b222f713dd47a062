"""Secret scans: spans against a plain search, the ledger's bookkeeping, no Python on the executors."""

import hashlib
import re

import pytest
from tallyfield.llm import queries
from tallyfield.llm import secrets as se
from tallyfield.sources.tables import load_table

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
PLAIN = {
    "assign": lambda t: [m.span() for m in ASSIGN.finditer(t) if len(m[2]) >= 12],
    "access": lambda t: [m.span() for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18],
    "hex": lambda t: [m.span() for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16],
    "private_key": lambda t: [m.span() for m in re.finditer(se.EXTRA[0].pattern, t)],
    "github": lambda t: [m.span() for m in re.finditer(se.EXTRA[1].pattern, t)],
    "slack": lambda t: [m.span() for m in re.finditer(se.EXTRA[2].pattern, t)],
    "jwt": lambda t: [m.span() for m in re.finditer(se.EXTRA[3].pattern, t)],
}
HEX = "0123456789abcdef"


def plain(doc, text):
    found = sorted((a, place, b, kind) for place, kind in enumerate(PLAIN) for a, b in PLAIN[kind](text or ""))
    text_of = lambda spans: ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
    base = [s for s in found if s[1] < 3]
    return (doc, *(sum(s[3] == k for s in base) for k in ("assign", "access", "hex")),
            hashlib.sha256(text_of(base).encode()).hexdigest(), text_of(found))


ROWS = [
    (1, "token:token:abcdefghijklmnop"), (2, f"PassWord = '{HEX}'{HEX}z"), (3, None), (4, ""), (4, ""),
    (5, f"é𝒳 api_key:\"{HEX}\" AKIA{'A1' * 7} AKIA{'A1' * 6} xAKIAAKIA{'B' * 12}"), (None, "secret=short token==============x"),
    (6, f"{HEX}"), (7, f"{HEX[:15]} {HEX}g{HEX} tok"), (8, f"a {HEX}\n" * 8000), (9, "-----BEGIN RSA PRIVATE KEY-----"),
    (10, "ghp_" + "a1" * 20 + " xoxb-123456789-abc eyJhbGciOiJI.eyJzdWIiOiIx.c2ln token= eyJhbGciOiJI.eyJzdWIiOiIx.c2ln"),
    (11, "APIKEY:abcdefghijkl" * 3), (12, f"{HEX}"), (12, f"{HEX}"), (13, "tokenÉ=abcdefghijklm toKen  =  abcdefghijklm"),
]
SCHEMA = "doc_id long, text string, blob string, spans string, rule string"


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(*r, "", "", "") for r in ROWS], SCHEMA).repartition(3)


def test_spans(spark, docs, tmp_path):
    found = se.report(se.scan(docs, str(tmp_path / "ledger")))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted((plain(*r) for r in ROWS), key=repr)
    assert se.report(se.scan(docs.limit(0), str(tmp_path / "none"))).count() == 0


def test_ledger_scans_only_unseen_pairs(spark, docs, tmp_path):
    folder = str(tmp_path / "ledger")
    one = se.scan(docs.filter("doc_id < 6"), folder).count()
    assert one == sum(r[0] is not None and r[0] < 6 for r in ROWS)
    first = spark.read.parquet(folder)
    blobs = {r[1] or "" for r in ROWS if r[0] is not None and r[0] < 6}
    assert first.count() == len(blobs) * len(se.RULES)
    se.scan(docs, folder).count()
    ledger = spark.read.parquet(folder)
    assert ledger.count() == len({r[1] or "" for r in ROWS}) * len(se.RULES)
    assert ledger.groupBy("blob", "rule").count().filter("count > 1").count() == 0
    # A new rule is scanned over known blobs, the others are not scanned again.
    rule = se.Rule("digits", "[0-9]{4,}", "[0-9]{4}")
    versions = docs.select("doc_id", se.F.sha2(se.F.coalesce("text", se.F.lit("")), 256).alias("blob"), "text")
    se.scan_new(versions, folder, (*se.RULES, rule))
    again = spark.read.parquet(folder)
    assert again.filter(again.rule == rule.version).count() == len({r[1] or "" for r in ROWS})
    assert again.filter(again.rule != rule.version).count() == ledger.count()


def test_pairs_that_stand_in_the_ledger_twice_count_once(spark, tmp_path):
    docs = spark.createDataFrame([(1, "password = hunter2hunter2 and token: abcdefabcdef12"), (2, None)], "doc_id long, text string")
    folder = str(tmp_path / "ledger")
    once = sorted(map(tuple, se.report(se.scan(docs, folder)).collect()))
    spark.read.parquet(folder).write.mode("append").parquet(str(tmp_path / "copy"))
    spark.read.parquet(str(tmp_path / "copy")).write.mode("append").parquet(folder)
    assert sorted(map(tuple, se.report(se.scan(docs, folder)).collect())) == once


def test_versions_name_the_definition():
    assert len({r.version for r in se.RULES}) == len(se.RULES)
    assert se.Rule("a", "x", "y").version == se.Rule("a", "x", "z").version != se.Rule("a", "x+", "y").version


def test_query_equals_a_plain_search_without_python(spark, small_sf):
    df = queries.op2_secret_scan(spark, small_sf)
    rows = load_table(spark, small_sf, "documents").select("doc_id", "text").collect()
    assert sorted(map(tuple, df.collect())) == sorted(plain(r.doc_id, r.text) for r in rows)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
