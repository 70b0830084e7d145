import hashlib
import re

from pyspark.sql import functions as F

from cellweave.llm import queries, secret_scan
from cellweave.llm.shared import saved

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def plain(text):
    text = text or ""
    spans = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    text = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
    return tuple(sum(k == s[2] for s in spans) for k in ("assign", "access", "hex")) + (hashlib.sha256(text.encode()).hexdigest(), text)


ODD = [None, "", "AKIA" + "B" * 16, "AKIAAKIA" + "C" * 12, "xAKIA" + "Z" * 15, "é" * 9 + "PassWord = 'abc.def'", "secret: token = abcdef1",
       "ſecret=abcdefg", "toKen=abcdefg", "api-key=abcdefg apikey:=x API_KEY=\"0123456789abcdef01234567\"", "token=token=abcdef",
       "f" * 30 + "g" + "0" * 24, "password=\n123456", "token = " + "9" * 100_000, "🙂token=abcdef"]


def test_odd_texts(spark):
    df = spark.createDataFrame([(i, t, b"x") for i, t in enumerate(ODD + ODD)], "path long, content string, blob binary")
    ledger = saved(secret_scan.scan_new(df), "t")
    for r in secret_scan.findings(df, ledger).collect():
        spans = [s for s in r["spans"] if s["rule"] in ("assign", "access", "hex")]
        assert ",".join(f"{s['rule']}:{s['start']}:{s['end']}" for s in spans) == plain((ODD + ODD)[r["path"]])[-1]
    assert secret_scan.findings(df, ledger).count() == 2 * len(ODD)


def test_query_equals_brute_force(spark, folder, given):
    rows = queries.queries()["op8_secret_scan"](spark, folder).collect()
    texts = {r["doc_id"]: r["text"] for r in given("documents").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) == plain(texts[r["doc_id"]])[:4]


def test_only_unseen_pairs_are_scanned(spark):
    one = spark.createDataFrame([("a@1", "token=abcdef"), ("b@1", "token=abcdef"), ("a@2", "clean")], "path string, content string")
    ledger = saved(secret_scan.scan_new(one), "t")
    assert ledger.count() == 2 * len(secret_scan.RULES)
    two = one.union(spark.createDataFrame([("c@1", "clean"), ("d@1", "xoxb-0123456789abcdefghij")], one.schema))
    more = saved(secret_scan.scan_new(two, ledger=ledger), "t")
    assert more.count() == len(secret_scan.RULES)
    assert secret_scan.scan_new(two, ledger=ledger.union(more)).count() == 0
    newer = (*secret_scan.BASE[:2], secret_scan.Rule("hex", "[0-9a-f]+", least=8, version=2))
    again = secret_scan.scan_new(two, newer, ledger.union(more))
    assert {(r["rule"], r["version"]) for r in again.collect()} == {("hex", 2)}
    found = {r["path"]: [s["rule"] for s in r["spans"]] for r in secret_scan.findings(two, ledger.union(more)).collect()}
    assert found == {"a@1": ["assign"], "b@1": ["assign"], "a@2": [], "c@1": [], "d@1": ["slack"]}


def test_versions_of_one_path_and_missing_paths(spark):
    df = spark.createDataFrame([("a", "token=abcdef"), ("a", "token=ghijkl secret=123456"), (None, "passwd:abcdef"), ("a", "token=abcdef")], "path string, content string")
    ledger = saved(secret_scan.scan_new(df), "t")
    assert ledger.count() == 3 * len(secret_scan.RULES)
    assert sorted(len(r["spans"]) for r in secret_scan.findings(df, ledger).collect()) == [1, 1, 1, 2]


def test_redact(spark):
    df = spark.createDataFrame([(1, "é token=abcdef, " + "a" * 24), (2, "clean"), (3, "password=" + "0" * 30)], "path long, content string")
    found = secret_scan.findings(df, saved(secret_scan.scan_new(df), "t"))
    out = df.join(found, "path").select("path", secret_scan.redact(F.col("content"), F.col("spans")).alias("t"))
    assert {r[0]: r[1] for r in out.collect()} == {1: "é [assign], [hex]", 2: "clean", 3: "[assign]"}


def test_empty(spark):
    df = spark.createDataFrame([], "path long, content string")
    ledger = saved(secret_scan.scan_new(df), "t")
    assert (ledger.count(), secret_scan.findings(df, ledger).count()) == (0, 0)
