import random
import re

import pytest
from pyspark.sql import functions as F

from cellweave.llm import decontaminate


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(decontaminate.WORDS, low)


def plain(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, body in items:
            iw = words(body)
            n = min(window, len(iw))
            spans = {tuple(iw[a : a + n]) for a in range(len(iw) - n + 1)} if n else set()
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in spans:
                    hit.update(range(at, at + n))
                    if item is not None:
                        ids.add(str(item))
        out.append((doc_id, len(w), sorted(hit), sorted(ids)))
    return sorted(out, key=repr)


def run(spark, docs, items):
    d = spark.createDataFrame([(*x, 1, "n") for x in docs], "doc_id long, text string, n int, hits string")
    i = spark.createDataFrame([(*x, "p") for x in items], "item_id long, text string, passage string")
    rows = decontaminate.contamination(d, i).collect()
    return sorted([(r["doc_id"], r["n_words"], r["hits"], r["items"]) for r in rows], key=repr)


def test_random_texts(spark):
    rng = random.Random(5)
    vocabulary = ["a", "b", "C", "é", "42"]
    text = lambda n: rng.choice([" ", ", ", "--"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 14, 30]))) for i in range(14)]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)]
    docs += [(100 + i, f"{text(7)} {items[i % 14][1]} {text(9)}") for i in range(28)]
    assert run(spark, docs, items) == plain(docs, items)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    docs = [(None, None), (1, ""), (1, "!!"), (2, "x y"), (2, "x y"), (3, long), (4, "É é ǅ K k " * 4), (5, "one two three four five six seven eight nine ten")]
    items = [(1, " ".join(f"W{i}" for i in range(29_990, 30_000))), (None, "x"), (7, ""), (8, None), (9, "É é ǅ K k É é ǅ K k"), (9, "three")]
    assert run(spark, docs, items) == plain(docs, items)


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, "a b")], [(1, "")])])
def test_empty_tables(spark, docs, items):
    assert run(spark, docs, items) == plain(docs, items)


def test_native_plan(spark, given):
    df = decontaminate.contamination(given("documents"), given("benchmark").filter(F.col("item_id") < 5))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)
