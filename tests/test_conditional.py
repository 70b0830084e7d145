import itertools
import random

import pytest
from pyspark.sql import functions as F

from cellweave.operators import conditional as c
from cellweave.plans.skew import NO_HOT_KEYS, HotKeys
from cellweave.schema import CELL, CHECK, cells, checks


def sequential(cells, ops):
    state, applied = dict(cells), {}
    for r, f, q, expected, changes, _, seq in sorted(ops, key=lambda o: (o[5], o[6])):
        applied[seq] = state.get((r, f, q)) == expected
        for op, family, qualifier, value in changes if applied[seq] else []:
            for k in [k for k in state if k[0] == r]:
                whole = op == "delete_row" or (op == "delete_family" and k[1] == family)
                if whole or (op == "delete_cell" and k == (r, family, qualifier)):
                    del state[k]
            if op == "put":
                state[r, family, qualifier] = value
    return state, applied


def random_checks(seed, n, at, entangled):
    rnd = random.Random(seed)
    ops = []
    for i in range(n):
        r, f, q = rnd.choice("AAAABCD"), rnd.choice("fg"), rnd.choice(["", "x"])
        kind = rnd.random()
        if entangled and kind < 0.3:
            changes = [("put", rnd.choice("fg"), rnd.choice(["", "x", "y"]), rnd.choice("abc"))]
        elif entangled and kind < 0.35:
            changes = [rnd.choice([("delete_family", f, None, None), ("delete_row", None, None, None)])]
        elif kind < 0.5:
            changes = [("delete_cell", f, q, None)]
        else:
            changes = [("put", f, q, rnd.choice("abc")), ("put", "other", "n", str(i))]
        expected = rnd.choice([None, "a", "b", "c"])
        ops.append((r, f, q, expected, changes, at(rnd.randrange(max(2, n // 4))), i))
    rnd.shuffle(ops)
    return ops


def frames(spark, at, cells, ops):
    table = [(*k, v, at(10**6), 0) for k, v in cells.items()]
    return spark.createDataFrame(table, CELL), spark.createDataFrame(ops, CHECK)


def outcome(checked):
    rows = checked.cells.collect()
    decided = checked.decided.collect()
    applied = {r["seq"]: r["applied"] for r in decided}
    assert len(applied) == len(decided)
    return {(r["row_key"], r["family"], r["qualifier"]): r["value"] for r in rows}, applied


PLANS = [NO_HOT_KEYS, HotKeys(("A",), 400, 20), HotKeys(("A", "B"), 500, 3)]
CELLS = {("A", "f", ""): "a", ("B", "g", "x"): "b", ("Z", "f", ""): "q"}


@pytest.mark.parametrize("hot", PLANS, ids=["plain", "hot", "hotter"])
def test_checks_equal_one_after_the_other(spark, at, hot):
    ops = random_checks(4, 500, at, False)
    table, checks = frames(spark, at, CELLS, ops)
    assert outcome(c.check_and_mutate(table, checks, hot)) == sequential(CELLS, ops)


@pytest.mark.parametrize("hot", [NO_HOT_KEYS, HotKeys(("A", "B"), 300, 100)], ids=["plain", "turns"])
def test_entangled_checks_equal_one_after_the_other(spark, at, hot):
    ops = random_checks(4, 400, at, True)
    table, checks = frames(spark, at, CELLS, ops)
    assert outcome(c.check_and_mutate(table, checks, hot)) == sequential(CELLS, ops)


@pytest.mark.parametrize("hot", [NO_HOT_KEYS, HotKeys(("A",), 300, 7)], ids=["plain", "hot"])
def test_a_version_counter_counts_up(spark, at, hot):
    ops = [("A", "f", "n", str(i), [("put", "f", "n", str(i + 1))], at(i), i) for i in range(300)]
    table, checks = frames(spark, at, {("A", "f", "n"): "0"}, ops)
    cells, applied = outcome(c.check_and_mutate(table, checks, hot))
    assert cells == {("A", "f", "n"): "300"} and all(applied.values())


@pytest.mark.parametrize("hot", [NO_HOT_KEYS, HotKeys(("A",), 60, 4)], ids=["plain", "hot"])
def test_row_deletes_on_a_row_with_one_checked_cell(spark, at, hot):
    ops = []
    for i in range(60):
        present = i % 3 == 2
        change = ("delete_row", None, None, None) if present else ("put", "f", "n", "v")
        ops.append(("A", "f", "n", "v" if present else None, [change], at(i), i))
    table, checks = frames(spark, at, {("A", "g", "m"): "1"}, ops)
    assert outcome(c.check_and_mutate(table, checks, hot)) == sequential({("A", "g", "m"): "1"}, ops)


def test_absent_and_empty_differ(spark, at):
    ops = [("a", "f", "", "", [("put", "f", "", "1")], at(1), 1), ("b", "f", "", None, [("put", "f", "", "1")], at(1), 2)]
    table, checks = frames(spark, at, {("b", "f", ""): ""}, ops)
    assert outcome(c.check_and_mutate(table, checks)) == ({("b", "f", ""): ""}, {1: False, 2: False})


def test_one_operation_per_row_needs_no_fold(spark, at):
    ops = [(r, "f", "", e, [("put", "f", "", "1")], at(1), i) for i, (r, e) in enumerate([("A", "a"), ("B", None), ("Z", "a")])]
    table, checks = frames(spark, at, CELLS, ops)
    single = {r["seq"]: r["applied"] for r in c.decide_single(table, checks).collect()}
    assert single == {r["seq"]: r["applied"] for r in c.decide(table, checks).collect()}
    assert single == {0: True, 1: True, 2: False}


def test_small_arrow_batches_carry_state(spark, at):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        ops = random_checks(9, 200, at, False)
        table, checks = frames(spark, at, CELLS, ops)
        for hot in (NO_HOT_KEYS, HotKeys(("A",), 100, 20)):
            assert outcome(c.check_and_mutate(table, checks, hot)) == sequential(CELLS, ops)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def turns(monkeypatch):
    """Counts the rows that are decided in turn."""
    asked, in_turn = [], c._decide_in_turn
    monkeypatch.setattr(c, "_decide_in_turn", lambda start, checks, hot: asked.extend(hot.keys) or in_turn(start, checks, hot))
    return asked


@pytest.mark.parametrize("seed", [31, 32])
def test_entangled_rows_are_decided_by_case(spark, at, monkeypatch, seed):
    asked = turns(monkeypatch)
    ops = random_checks(seed, 400, at, True)
    got = outcome(c.check_and_mutate(*frames(spark, at, CELLS, ops), hot=HotKeys(("A",), 400, 20)))
    assert got == sequential(CELLS, ops)
    assert not asked


def test_rows_with_too_many_cases_or_cells_take_turns(spark, at, monkeypatch):
    ops = random_checks(33, 200, at, True)
    want = sequential(CELLS, ops)
    for name, bound in (("MAX_CASES", 3), ("MAX_CELLS", 2)):
        with monkeypatch.context() as patch:
            asked = turns(patch)
            patch.setattr(c, name, bound)
            got = outcome(c.check_and_mutate(*frames(spark, at, CELLS, ops), hot=HotKeys(("A",), 200, 50)))
            assert got == want
            assert name == "MAX_CASES" or asked


def test_jobs_do_not_grow_with_slices(spark, at, monkeypatch):
    ops = random_checks(34, 300, at, True)
    jobs = []
    for size in (100, 10):
        spark.sparkContext.setJobGroup(f"slices-{size}", "")
        table, checks = frames(spark, at, CELLS, ops)
        c.decide(table, checks, HotKeys(("A",), 200, size)).collect()
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"slices-{size}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[1] <= jobs[0] + 8, jobs


def test_cases_cover_every_state_once():
    rnd = random.Random(35)
    names = [(b"f", b"a"), (b"f", b"b"), (b"g", b"a")]
    for _ in range(150):
        ops = [(rnd.choice(names), rnd.choice([None, b"1", b"2"]), [(*rnd.choice(names), rnd.choice([None, b"1", b"2", b"3"])) for _ in range(rnd.randrange(3))]) for _ in range(rnd.randrange(12))]
        cases = c.Cases()
        for op in ops:
            cases.step(*op)
        for values in itertools.product([None, b"1", b"2", b"x"], repeat=3):
            state = dict(zip(names, values))
            fits = [
                after
                for after, _, own in cases.groups.values()
                for had, had_not in own
                if all(state[n] == v for n, v in had.items()) and not any(state[n] in vs for n, vs in had_not.items())
            ]
            assert len(fits) == 1
            for cell, expected, after in ops:
                if state[cell] == expected:
                    state.update({(f, q): v for f, q, v in after})
            assert dict(zip(names, values)) | fits[0] == state


def test_keys_and_values_may_be_any_bytes(spark, at):
    raw = [(b"\xff", b"\x80", b"\xc3(", "1"), (b"\xfe", b"\x80", b"\xc3(", "2")]
    text = lambda name: F.col(name).cast("string")
    given = spark.createDataFrame([tuple(map(bytearray, r[:3])) + (r[3],) for r in raw], "r binary, f binary, q binary, v string")
    table = cells(given, row_key=text("r"), family=text("f"), qualifier=text("q"), value=text("q"), ts=F.lit(at(0)), seq=F.lit(0))
    change = F.array(F.struct(F.lit("put").alias("op"), text("f").alias("family"), text("q").alias("qualifier"), text("r").alias("value")))
    ops = checks(given.crossJoin(spark.range(2)), row_key=text("r"), chk_family=text("f"), chk_qualifier=text("q"), expected=text("q"), changes=change, ts=F.lit(at(1)), seq=F.col("id"))
    for hot in (NO_HOT_KEYS, HotKeys(("\ufffd",), 2, 1)):
        got = c.check_and_mutate(table, ops, hot)
        flags = sorted((bytes(r["k"]), r["seq"], r["applied"]) for r in got.decided.select(F.col("row_key").cast("binary").alias("k"), "seq", "applied").collect())
        assert flags == [(k, i, i == 0) for k in (b"\xfe", b"\xff") for i in (0, 1)]
        left = {(bytes(r["k"]), bytes(r["v"])) for r in got.cells.select(F.col("row_key").cast("binary").alias("k"), F.col("value").cast("binary").alias("v")).collect()}
        assert left == {(b"\xff", b"\xff"), (b"\xfe", b"\xfe")}
