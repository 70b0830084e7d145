import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellweave.llm import queries
from cellweave.llm import suffix_tree_lm as lm


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base(rows, training):
    count = Counter()
    for doc, text in rows:
        if training(doc):
            count.update(words(text) + [None])
    n, v = sum(count.values()), len(count)
    out = []
    for doc, text in rows:
        own = words(text) + [None]
        out.append((doc, len(own), sum(count[w] > 0 for w in own), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)))
    return out


def tree_score(rows, training, text):
    """The same model, state by state, in plain Python."""
    def symbols(t):
        return [*" ".join(words(t)).encode(), 255]

    grams = Counter()
    for doc, t in rows:
        if training(doc):
            s = symbols(t)
            for i, b in enumerate(s):
                past = (s[:i][::-1] + [255] * lm.DEPTH)[: lm.DEPTH]
                for k in range(lm.DEPTH + 1):
                    grams[tuple(past[:k]), b] += 1
    by = {}
    for (c, b), n in grams.items():
        by.setdefault(c, {})[b] = n
    whole = sum(by.get((), {}).values())
    total = {c: sum(d.values()) for c, d in by.items()}
    states = {()}
    for c, d in by.items():
        if c and total[c] >= lm.SHARE * whole:
            gain = sum(n * math.log(n / total[c] / (by[c[:-1]][b] / total[c[:-1]])) for b, n in d.items())
            if gain > 0.5 * len(d) * math.log(total[c]):
                states.update(c[:k] for k in range(len(c) + 1))

    def chance(c, b):
        below = 1 / 256 if not c else chance(c[:-1], b)
        weight = 1.0 if not c else len(by[c])
        return (by.get(c, {}).get(b, 0) + weight * below) / (total.get(c, 0) + weight)

    s, out = symbols(text), 0.0
    for i, b in enumerate(s):
        past, c = (s[:i][::-1] + [255] * lm.DEPTH)[: lm.DEPTH], ()
        for k in range(1, lm.DEPTH + 1):
            if tuple(past[:k]) not in states:
                break
            c = tuple(past[:k])
        out += math.log10(chance(c, b))
    return out


def made(n):
    rng = random.Random(1)
    vocabulary = ["the", "THE", "cat", "catalogue", "é", "naïve", "x1", "of"]
    return [(i, rng.choice([" ", "\n", "\t "]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))) for i in range(n)]


def run(spark, rows, training):
    df = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id long, text string, score double, n string")
    return lm.score(df, training).collect()


def test_equals_plain_model(spark):
    rows = made(60) + [(900, None), (901, ""), (902, "  "), (903, " zzz\u0000q\x1c "), (904, "long " * 9000), (1, "the repeated id")]
    training = lambda d: d % 3 != 0
    got = run(spark, rows, F.col("doc_id") % 3 != 0)
    key = lambda r: (r[0], r[1], round(r[4], 6))
    want = sorted(base(rows, training), key=key)
    have = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key)
    assert [r[:4] for r in have] == [r[:4] for r in want]
    assert np.allclose([r[4] for r in have], [r[4] for r in want])
    texts = dict(rows[:60])
    for r in got:
        if r["doc_id"] in (0, 3, 5, 30, 59):
            assert r["score"] == pytest.approx(tree_score(rows, training, texts[r["doc_id"]]), rel=1e-5)


def test_next_symbols_sum_to_one(spark):
    df = spark.createDataFrame(made(40), "doc_id long, text string")
    tree = lm.grow(lm.counts(df).filter(F.col("kind") != lm.WORD))
    unseen = 256 - len(set(tree.symbol[tree.symbol > 0]))
    sums = (10.0 ** tree.log10[:, 1:].astype(float)).sum(1) + unseen * 10.0 ** tree.log10[:, 0].astype(float)
    assert len(tree.log10) > 10 and np.allclose(sums, 1, atol=1e-4)


def test_tree_and_words_reach_the_driver_as_columns(spark, monkeypatch):
    """Without a row object for each count, which were most of the driver's memory."""
    df = spark.createDataFrame(made(40), "doc_id long, text string")

    def refused(*_):
        raise AssertionError("row objects in the driver")

    monkeypatch.setattr(type(df), "toPandas", refused)
    assert lm.score(df, F.lit(True)).count() == 40


def test_without_training_rows_and_empty(spark):
    rows = run(spark, [(1, "ab"), (2, None)], F.lit(False))
    assert {r["doc_id"]: r["score"] for r in rows} == pytest.approx({1: 3 * math.log10(1 / 256), 2: math.log10(1 / 256)}, rel=1e-5)
    assert {r["n_known"] for r in rows} == {0} and {r["base_score"] for r in rows} == {0.0}
    assert run(spark, [], F.lit(True)) == []


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.queries()["op1_suffix_tree_lm"](spark, folder).collect()
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = {r[0]: r for r in base(texts, lambda d: zlib.crc32(str(d).encode()) % 7 != 2)}
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[r["doc_id"]][1:4]
        assert r["base_score"] == pytest.approx(want[r["doc_id"]][4])
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
    held = [r for r in rows if r["held_out"]]
    # On so little text bytes tell about as much as words; from ten times that on they tell more.
    assert sum(r["score"] for r in held) > 1.06 * sum(r["base_score"] for r in held)


def test_common_contexts_are_counted_whole(spark, monkeypatch):
    """Every context with enough symbols after it has all of them, though rare ones are cut short."""
    monkeypatch.setattr(lm, "SHARE", 2e-3)
    docs = made(60)
    data, _ = lm.symbols([text for _, text in docs])
    past = [p.tolist() for p in lm.pasts(data)]
    want = {}
    for i, s in enumerate(data.tolist()):
        for k in range(lm.DEPTH + 1):
            of = want.setdefault(tuple(p[i] for p in past[:k]), {})
            of[s] = of.get(s, 0) + 1
    got = {}
    rows = lm.counts(spark.createDataFrame(docs, "doc_id long, text string")).filter(F.col("kind") != lm.WORD).collect()
    for r in rows:
        raw = (r["key"] % (1 << 64)).to_bytes(8, "big")
        for k in range(r["kind"] + 1):
            of = got.setdefault(tuple(raw[:k]), {})
            of[raw[7]] = of.get(raw[7], 0) + r["n"]
    common = {c for c, of in want.items() if sum(of.values()) >= lm.SHARE * len(data)}
    assert common and all(got.get(c) == want[c] for c in common)
    assert any(c not in got for c in want)


def test_a_task_holds_a_bounded_number_of_counts():
    """The bound is on all kinds together; before, each kind had its own."""
    rng = np.random.default_rng(5)
    held = {kind: ([], []) for kind in (lm.WORD, *range(lm.SHORTEST, lm.DEPTH + 1))}
    expected, got = Counter(), Counter()

    def take(batches):
        for batch in batches:
            for row in batch.to_pylist():
                got[row["kind"], row["key"]] += row["n"]

    for _ in range(20):
        for kind in held:
            keys = rng.integers(0, 400 * (kind + 1), 300).astype(np.uint64)
            expected.update((kind, int(k)) for k in keys)
            lm._add(held[kind], keys)
        take(lm._handed_on(held, 1000))
        assert sum(len(a) for keys, _ in held.values() for a in keys) <= 1000
    take(lm._handed_on(held, 0))
    assert got == expected and not any(keys for keys, _ in held.values())


def test_parts_of_a_column():
    texts = ["ab", None, "", "é" * 30, "x", "y" * 9, "z"]
    for size in (1, 4, 10, 60, 1000):
        parts = list(lm._parts(pa.array(texts, pa.string()), size))
        assert [t for _, part in parts for t in part] == texts
        assert [first for first, _ in parts] == np.cumsum([0, *(len(part) for _, part in parts[:-1])]).tolist()
        assert all(len(part) == 1 or sum(len((t or "").encode()) for t in part) <= size for _, part in parts)
    assert not list(lm._parts(pa.array([], pa.string())))
