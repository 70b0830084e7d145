import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellweave.llm import queries
from cellweave.llm import source_divergence as divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "text string, lang string, source string"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain(rows, least=10, top=10):
    rows = [tuple(v or "" for v in r) for r in rows]
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        terms = TERM.findall(lower(text))
        groups[lang].add(source)
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        counts[lang, None].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        p = {}
        for s in [None, *sources]:
            size = sum(counts[lang, s][t] for t in kept)
            p[s] = {t: 1 + 10**9 * (counts[lang, s][t] + 2) // (size + 2 * len(kept)) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], p[None][t])) for t in kept if counts[lang, s][t] and p[s][t] > p[None][t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])]
    return out


def made(n, seed):
    rng = random.Random(seed)
    words = ["the", "The", "Ünder", "é", "ÉTÉ", "straße", "x1y", "don't", "a" * 40, "日本", "a b", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))]
    rows = []
    for i in range(n):
        own = rng.sample(words, rng.randint(5, 60))
        text = rng.choice([None, "", "123 !"]) if i % 17 == 0 else " ".join(rng.choice(own) for _ in range(rng.randint(0, 90)))
        rows.append((text, rng.choice([None, "", "en", "en", "de"]), rng.choice([None, "s1", "s2", "s10", "é"])))
    return rows + [("", "xx", "s1"), (None, "xx", "s2"), ("only", "yy", "s1"), ("the the", "en", "late")]


def test_random_tables_equal_brute_force(spark):
    rows = made(400, 1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    for name in ("term", "n", "counts", "size", "value", "rank", "docs"):
        df = df.withColumn(name, F.lit(1))
    got = [tuple(r) for r in divergence.audit(df).collect()]
    assert sorted(got) == sorted(plain(rows))
    assert [tuple(r) for r in divergence.audit(df.limit(0)).collect()] == []
    small = sorted(tuple(r) for r in divergence.audit(df, least_docs=40, top=2).collect())
    assert small == sorted(plain(rows, 40, 2))


def test_repeated_rows_are_documents(spark):
    rows = [("one two", "en", "a")] * 9 + [("one", "en", "b")]
    assert sorted(tuple(r) for r in divergence.audit(spark.createDataFrame(rows, SCHEMA)).collect()) == sorted(plain(rows))


def test_small_blocks_and_flushes_change_nothing(spark, monkeypatch):
    rows = made(300, 2)
    batches = [b.select(["lang", "source", "text"]) for b in spark.createDataFrame([(s or "", g or "", bytearray((t or "").encode())) for t, g, s in rows], "lang string, source string, text binary").toArrow().to_batches(max_chunksize=20)]
    whole = Counter()
    for batch in divergence._sums(iter(batches)):
        for r in batch.to_pylist():
            whole[r["lang"], r["source"], r["term"]] += r["n"]
    monkeypatch.setattr(divergence, "_HELD", 5)
    parts = Counter()
    for batch in divergence._sums(iter(batches)):
        for r in batch.to_pylist():
            parts[r["lang"], r["source"], r["term"]] += r["n"]
    assert parts == whole


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB éZ\n1_", max_size=60), st.integers(1, 9), st.integers(1, 5))
def test_long_texts_are_split_between_terms(text, cut, step):
    kept = divergence._CUT, divergence._STEP
    divergence._CUT, divergence._STEP = cut, step
    try:
        got = [t.decode() for part in divergence.terms_of(text.encode()) for t in part]
    finally:
        divergence._CUT, divergence._STEP = kept
    assert got == TERM.findall(lower(text))


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 9 * 10**12), st.integers(0, 9 * 10**12), st.integers(1, 10**9))
def test_probabilities_are_exact(n, more, vocabulary):
    got = divergence.probabilities(np.array([n], np.int64), n + more, vocabulary)
    assert int(got[0]) == 1 + 10**9 * (n + 2) // (n + more + 2 * vocabulary)


def test_columns_agree_with_numpy(spark):
    rng = random.Random(3)
    rows = [(n := rng.randrange(10**15), n + rng.randrange(10**15), rng.randrange(1, 10**7)) for _ in range(50)]
    df = spark.createDataFrame(rows, "n long, size long, vocabulary long")
    got = df.select("*", divergence.probability(F.col("n"), F.col("size"), F.col("vocabulary")).alias("p")).collect()
    assert all(r["p"] == 1 + 10**9 * (r["n"] + 2) // (r["size"] + 2 * r["vocabulary"]) for r in got)


def test_runs():
    starts, numbers = divergence.runs(np.array([0, 0, 5, 5, 5, 0, 1]))
    assert starts.tolist() == [0, 2, 5, 6] and numbers.tolist() == [0, 5, 0, 1]


@pytest.mark.parametrize("seed", [4])
def test_query_equals_its_sql_on_odd_rows(spark, tmp_path, seed):
    spark.createDataFrame(made(300, seed), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.queries()["op12_source_divergence"](spark, str(tmp_path)).collect()
    want = con.sql(queries.oracle_sql()["op12_source_divergence"]).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
