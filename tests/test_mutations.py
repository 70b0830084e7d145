import random

import pytest
from pyspark.sql import functions as F

from cellweave.operators import mutations as m
from cellweave.plans import skew
from cellweave.plans.skew import NO_HOT_KEYS, HotKeys, hot_keys
from cellweave.schema import CELL, MUTATION


def sequential(cells, ops):
    """The table after the operations, one after the other."""
    state = dict(cells)
    for r, f, q, op, value, delta, _, _ in sorted(ops, key=lambda o: (o[6], o[7])):
        if op == "put":
            state[r, f, q] = value
        elif op == "increment":
            state[r, f, q] = str(int(state.get((r, f, q), 0)) + delta)
        else:
            for k in list(state):
                whole = op == "delete_row" or (op == "delete_family" and k[1] == f)
                if k[0] == r and (whole or k == (r, f, q)):
                    del state[k]
    return state


def random_ops(seed, n, at, spread=3):
    rnd = random.Random(seed)
    ops = []
    for i in range(n):
        r, f, q = rnd.choice("AAAABC"), rnd.choice("fg"), rnd.choice(["", "x"])
        op = rnd.choices(
            ["put", "increment", "delete_cell", "delete_family", "delete_row"], [8, 12, 3, 1, 0.3]
        )[0]
        value = str(rnd.randrange(100)) if op == "put" else None
        delta = rnd.randrange(-9, 10) if op == "increment" else None
        f = None if op == "delete_row" else f
        q = None if op in ("delete_row", "delete_family") else q
        ops.append((r, f, q, op, value, delta, at(rnd.randrange(max(1, n // spread))), i))
    rnd.shuffle(ops)
    return ops


def result(df):
    rows = df.collect()
    got = {(r["row_key"], r["family"], r["qualifier"]): r["value"] for r in rows}
    assert len(got) == len(rows)
    return got


PLANS = [NO_HOT_KEYS, HotKeys(("A",), 200, 20), HotKeys(("A", "B"), 300, 2)]


@pytest.mark.parametrize("hot", PLANS, ids=["plain", "hot", "hotter"])
@pytest.mark.parametrize("seed,spread", [(1, 3), (2, 100), (3, 1)])
def test_mix_equals_one_after_the_other(spark, at, seed, spread, hot):
    ops = random_ops(seed, 300, at, spread)
    df = spark.createDataFrame(ops, MUTATION)
    assert result(m.resolve(df, hot=hot)) == sequential({}, ops)


def test_many_family_deletes_are_not_broadcast(spark, at, monkeypatch):
    monkeypatch.setattr(skew, "MAX_BROADCAST_BYTES", 0)
    ops = random_ops(8, 200, at)
    live = m.resolve(spark.createDataFrame(ops, MUTATION), hot=PLANS[1])
    assert result(live) == sequential({}, ops)


@pytest.mark.parametrize("kind", ["put", "increment"])
def test_one_kind_combines_before_the_shuffle(spark, at, kind):
    ops = [o for o in random_ops(6, 300, at) if o[3] == kind]
    live = m.resolve(spark.createDataFrame(ops, MUTATION))
    assert result(live) == sequential({}, ops)
    plan = live._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Repartition" not in plan


@pytest.mark.parametrize("hot", PLANS, ids=["plain", "hot", "hotter"])
def test_compaction_keeps_the_outcome(spark, at, hot):
    ops = random_ops(5, 300, at)
    early = [o for o in ops if o[6] < at(60)]
    late = spark.createDataFrame([o for o in ops if o[6] >= at(60)], MUTATION)
    short = m.compact(spark.createDataFrame(early, MUTATION), hot=hot)
    cells = short.filter(F.col("op").isin("put", "increment", "delete_cell"))
    assert cells.count() == cells.select("row_key", "family", "qualifier").distinct().count()
    assert result(m.resolve(short.unionByName(late), hot=hot)) == sequential({}, ops)


def test_compaction_shadows_older_puts(spark, at):
    ops = [("a", "f", "x", "delete_cell"), ("b", "f", None, "delete_family"), ("c", None, None, "delete_row")]
    history = spark.createDataFrame([(*o, None, None, at(5), i) for i, o in enumerate(ops)], MUTATION)
    older = spark.createDataFrame([(r, "f", "x", "put", "v", None, at(4), 9) for r in "abcd"], MUTATION)
    assert set(result(m.resolve(m.compact(history).unionByName(older)))) == {("d", "f", "x")}


def test_apply_to_a_table(spark, at):
    cells = {("A", "f", ""): "5", ("Z", "g", "x"): "7"}
    df = spark.createDataFrame([(*k, v, at(-1), 0) for k, v in cells.items()], CELL)
    ops = random_ops(7, 200, at)
    assert result(m.apply(df, spark.createDataFrame(ops, MUTATION))) == sequential(cells, ops)


def test_put_again_keeps_vanished_keys(spark, at):
    first = spark.createDataFrame([("a", "f", "", "1", at(1), 0), ("b", "f", "", "1", at(1), 0)], CELL)
    second = spark.createDataFrame([("a", "f", "", "2", at(2), 0)], CELL)
    assert result(m.put(first, second)) == {("a", "f", ""): "2", ("b", "f", ""): "1"}


def test_increment(spark, at):
    cells = spark.createDataFrame([("a", "f", "n", "5", at(1), 0), ("a", "f", "t", "text", at(1), 0)], CELL)
    deltas = [("a", "f", "n", "increment", None, 3, at(2), 1), ("a", "f", "n", "increment", None, -1, at(2), 2),
              ("b", "f", "n", "increment", None, 4, at(2), 3)]
    got = result(m.increment(cells, spark.createDataFrame(deltas, MUTATION)))
    assert got == {("a", "f", "n"): "7", ("a", "f", "t"): "text", ("b", "f", "n"): "4"}


@pytest.mark.parametrize("value,delta", [("text", 1), (str(2**63 - 1), 1)])
def test_increment_fails_on_text_and_overflow(spark, at, value, delta):
    cells = spark.createDataFrame([("a", "f", "n", value, at(1), 0)], CELL)
    ops = spark.createDataFrame([("a", "f", "n", "increment", None, delta, at(2), 1)], MUTATION)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|ARITHMETIC_OVERFLOW"):
        m.increment(cells, ops).collect()


@pytest.mark.parametrize("hot", [NO_HOT_KEYS, HotKeys(("a",), 3, 1)], ids=["plain", "hot"])
def test_deletes(spark, at, hot):
    cells = spark.createDataFrame(
        [(r, f, q, "v", at(1), 0) for r in "ab" for f in "fg" for q in ["", "x"]], CELL
    )
    key = spark.createDataFrame([("a", "f", "x"), ("a", "f", "x"), ("no", "f", "x")], "row_key STRING, family STRING, qualifier STRING")
    assert len(result(m.delete_rows(cells, key, hot))) == 4
    assert len(result(m.delete_cells(cells, key))) == 7
    family_hot = NO_HOT_KEYS if not hot else HotKeys(('{"row_key":"a","family":"f"}',), 2, 1)
    assert len(result(m.delete_families(cells, key, family_hot))) == 6


def test_hot_keys_finds_heavy_keys_only(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 400, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    found = hot_keys(df, "k", min_rows=100)
    assert found.keys == ("hot",) and found.rows == 400
    assert not hot_keys(df.filter("k <> 'hot'"), "k", min_rows=100)


def test_delete_families_tells_bytes_apart(spark):
    rows = [(bytes([b]), "f", "q", "1", 1, 1) for b in (0x80, 0xFF)]
    cells = spark.createDataFrame(rows, "row_key binary, family string, qualifier string, value string, ts long, seq long")
    keys = spark.createDataFrame([(b"\xff", "f")], "row_key binary, family string")
    left = m.delete_families(cells, keys).collect()
    assert [bytes(r["row_key"]) for r in left] == [b"\x80"]


def test_increment_meets_the_newest_version(spark, at):
    cells = spark.createDataFrame([("a", "f", "n", v, at(t), 0) for v, t in [("1", 1), ("5", 3), ("2", 2)]], CELL)
    deltas = spark.createDataFrame([("a", "f", "n", "increment", None, 10, at(4), 0)], MUTATION)
    assert [(r["value"], r["ts"]) for r in m.increment(cells, deltas).collect()] == [("15", at(4))]
    plan = m.increment(cells, deltas)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2


def test_five_thousand_heavy_rows(spark, at):
    """More heavy rows than a sketch names: all are cut into slices, and the driver holds none of the rest."""
    rnd = random.Random(41)
    ops = []
    for i in range(5000):
        for k in range(5):
            op, value, delta = rnd.choice([("put", "7", None), ("increment", None, 2), ("increment", None, 3), ("delete_row", None, None)])
            cell = (None, None) if op == "delete_row" else ("f", rnd.choice("xy"))
            ops.append((f"r{i}", *cell, op, value, delta, at(rnd.randrange(50)), 5 * i + k))
    ops += [(f"light{i}", "f", "x", "increment", None, 1, at(i % 7), 10**6 + i) for i in range(300)]
    df = spark.createDataFrame(ops, MUTATION)
    hot = hot_keys(df, "row_key", min_rows=4)
    assert len(hot.keys) == skew.MAX_HOT_KEYS and hot.full
    light, heavy, found = m._by_weight(df, hot)
    assert light.count() == 300 and heavy.count() == found.rows == 25_000
    assert result(m.resolve(df, hot=hot)) == sequential({}, ops)
