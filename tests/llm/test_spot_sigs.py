import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from cellweave.llm import queries, spot_sigs

ANCHORS = set(spot_sigs.ANCHORS)
lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)


def chains(text):
    """Spot signatures as chains of words."""
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    spots = [i for i, w in enumerate(words) if w in ANCHORS]
    if not spots:
        return {tuple(words[i : i + 3]) for i in range(len(words))}
    return {(words[i], *[w for w in words[i + 1 : i + 7] if w not in ANCHORS][:2]) for i in spots}


def likeness(a, b):
    a, b = chains(a), chains(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(rows):
    """The next document of each, and the edited texts; one row per id."""
    order = sorted(rows, reverse=True)
    out = {}
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        out[doc] = (text, after, text[: len(text) - len(text) // 2] + after[: len(text) // 2])
    return out


def check(got, rows):
    want = edited(rows)
    assert len(got) == len(rows)
    for r in got:
        text, after, new = want[r["doc_id"]]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(likeness(text, new))
        assert r["near_next"] == pytest.approx(likeness(text, after))
        assert len(r["fingerprint"]) == 8 * len(chains(text)) and len(r["edited_fingerprint"]) == 8 * len(chains(new))


def test_query_equals_brute_force(spark, folder, given):
    rows = [(r["doc_id"], r["text"]) for r in given("documents").collect()]
    check(queries.queries()["op5_spot_sigs"](spark, folder).collect(), rows)


def test_odd_rows(spark):
    texts = [None, "", "the", "THE É the cat", "no anchors here", "  ", "🙂 of 🙂 the 🙂", "of the of the of the of the of the", "x " * 30_000 + "the end"]
    rows = [(i * 10**14 - 3 * 10**14, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, target string, n int")
    check(spot_sigs.edits(df).collect(), rows)
    for some in (rows[:1], rows[2:4]):
        check(spot_sigs.edits(df.filter(F.col("doc_id").isin([r[0] for r in some]))).collect(), some)
    assert spot_sigs.edits(df.limit(0)).count() == 0


def test_repeated_and_missing_ids(spark):
    rows = [(1, "the cat sat on a mat"), (1, "the cat sat on a mat"), (1, "a dog"), (2, "the bird in the tree"), (None, "the fish"), (None, None)]
    got = spot_sigs.edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 6
    alone = [r for r in got if r["doc_id"] is None and r["n_chars"]]
    assert alone[0]["edited_sha256"] == hashlib.sha256(b"the ").hexdigest() and alone[0]["near_next"] == 0


@pytest.mark.parametrize("ids", [[5], [1, 2], [-(2**63), 2**63 - 1, 0, -1], [i * 16384 for i in range(50)], [7**i for i in range(22)]])
def test_successors(spark, ids):
    got = {r[0]: r[1] for r in spot_sigs.successors(spark.createDataFrame([(i,) for i in ids], "doc_id long")).collect()}
    ordered = sorted(ids)
    assert got == {a: b for a, b in zip(ordered, ordered[1:] + ordered[:1])}


def test_classes_equal_brute_force(spark):
    rng = random.Random(2)
    word = lambda: rng.choice(["the", "of", "and", "river"] + [f"w{i}" for i in range(400)])
    made = [[word() for _ in range(rng.choice([4, 30, 120]))] for _ in range(25)]
    rows = [(i, " ".join(w)) for i, w in enumerate(made)]
    for i in range(50):
        words = list(made[i % 25])
        for _ in range(rng.choice([0, 1, 2])):
            words[rng.randrange(len(words))] = word()
        rows.append((100 + i, " ".join(words)))
    rows += [(200, None), (201, ""), (202, " ")]
    root = {d: d for d, _ in rows}
    find = lambda d: d if root[d] == d else find(root[d])
    for d, a in rows:
        for e, b in rows:
            if e < d and likeness(a, b) >= 0.8:
                x, y = sorted((find(d), find(e)))
                root[y] = x
    got = spot_sigs.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {d: find(d) for d, _ in rows}


def test_native_plan(spark, given):
    plan = spot_sigs.edits(given("documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)
