import shutil

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from cellweave.operators.mutations import ARRIVAL_ORDER, resolve
from cellweave.plans.skew import NO_HOT_KEYS, HotKeys
from cellweave.schema import CHECK, MUTATION
from cellweave.streaming.sinks import run_with_restarts, stream_checks, stream_mutations
from cellweave.streaming.table import MutationTable
from test_conditional import CELLS, random_checks
from test_conditional import sequential as sequential_checks
from test_mutations import random_ops, result, sequential


def write_parts(spark, ops, schema, path, parts=3):
    """One file per part, each newer than the one before."""
    import os

    size = -(-len(ops) // parts)
    for i in range(parts):
        part = spark.createDataFrame(ops[i * size : (i + 1) * size], schema)
        before = set(os.listdir(path)) if os.path.exists(path) else set()
        part.coalesce(1).write.mode("append").parquet(path)
        for name in set(os.listdir(path)) - before:
            os.utime(f"{path}/{name}", (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path, at):
    ops = random_ops(11, 240, at)
    stream = write_parts(spark, ops, MUTATION, f"{tmp_path}/in")
    table = MutationTable(spark, f"{tmp_path}/t", families=["f", "g"])
    query = stream_mutations(stream, table, f"{tmp_path}/cp", lambda df: df)
    query.awaitTermination()
    want = sequential({}, ops)
    assert table.history().select("batch_id").distinct().count() == 3
    assert result(table.cells()) == want
    again = table.history().filter("batch_id = 1").drop("batch_id", "writer").collect()
    table.write(spark.createDataFrame(again, MUTATION), 1)
    assert result(table.cells()) == want


def test_compaction_and_later_batches(spark, tmp_path, at):
    ops = sorted(random_ops(12, 240, at), key=lambda o: o[6])
    table = MutationTable(spark, f"{tmp_path}/t")
    for i in range(4):
        table.write(spark.createDataFrame(ops[i * 60 : (i + 1) * 60], MUTATION), i)
        if i in (1, 2):
            horizon = F.lit(ops[(i + 1) * 60 - 30][6]).cast("timestamp")
            table.compact(i, horizon)
    assert result(table.cells()) == sequential({}, ops)
    assert result(table.cells(before=2)) == sequential({}, ops[:120])
    assert result(table.cells(before=1)) == sequential({}, ops[:60])
    rows = spark.createDataFrame([("A",), ("no",)], "row_key STRING")
    some = result(table.cells(rows_of=rows))
    assert some == {k: v for k, v in sequential({}, ops).items() if k[0] == "A"}
    with pytest.raises(ValueError, match="horizon"):
        table.compact(3)


def test_writers_do_not_replace_each_other(spark, tmp_path, at):
    """Three writers with the same batch numbers, replays and a compaction of some of them."""
    ops = random_ops(21, 300, at)
    table = MutationTable(spark, f"{tmp_path}/t")
    names = ["a=b/c", "main", "7"]
    for i, name in enumerate(names):
        for batch in range(2):
            part = [o for k, o in enumerate(ops) if k % 3 == i and k // 3 % 2 == batch]
            table.write(spark.createDataFrame(part, MUTATION), batch, writer=name)
    want = sequential({}, ops)
    assert result(table.cells()) == want
    assert {r["writer"] for r in table.history().select("writer").distinct().collect()} == set(names)
    part = [o for k, o in enumerate(ops) if k % 3 == 1 and k // 3 % 2 == 0]
    table.write(spark.createDataFrame(part, MUTATION), 0)
    assert result(table.cells()) == want
    horizon = F.lit(at(10**6)).cast("timestamp")
    table.compact({"main": 0}, horizon)
    assert result(table.cells()) == want
    table.compact({"7": 1, "a=b/c": 0}, horizon)
    assert result(table.cells()) == want
    plan = table.history()._jdf.queryExecution().executedPlan().toString()
    assert "writer#" in plan.split("PartitionFilters: [")[2].split("]")[0]
    table.compact(1, horizon)
    assert result(table.cells()) == want


def test_equal_positions_of_two_writers_have_an_order(spark, tmp_path, at):
    put = lambda v: spark.createDataFrame([("r", "f", "x", "put", v, None, at(1), 0)] * 1, MUTATION)
    for names in (("a", "b"), ("b", "a")):
        table = MutationTable(spark, f"{tmp_path}/{names[0]}")
        for name in names:
            table.write(put(name), 0, writer=name)
        assert result(table.cells()) == {("r", "f", "x"): "b"}
        table.compact(0, F.lit(at(5)).cast("timestamp"))
        assert result(table.cells()) == {("r", "f", "x"): "b"}


def test_a_moved_table_keeps_its_compactions(spark, tmp_path, at):
    ops = sorted(random_ops(22, 90, at), key=lambda o: o[6])
    table = MutationTable(spark, f"{tmp_path}/old")
    for i in range(3):
        table.write(spark.createDataFrame(ops[i * 30 : (i + 1) * 30], MUTATION), i)
    table.compact(1, F.lit(at(10**6)).cast("timestamp"))
    shutil.copytree(tmp_path / "old", tmp_path / "new")
    shutil.rmtree(tmp_path / "old")
    for batch in (0, 1):
        shutil.rmtree(tmp_path / "new" / "log" / "writer=main" / f"batch_id={batch}")
    moved = MutationTable(spark, f"{tmp_path}/new")
    assert result(moved.cells()) == sequential({}, ops)
    shutil.rmtree(tmp_path / "new" / "compacted")
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        moved.cells()


def test_mutations_without_a_time_come_first_and_stay(spark, tmp_path, at):
    rows = [("r", "f", "n", "increment", None, 5, None, 2), ("r", "f", "n", "put", "1", None, None, 1), ("r", "f", "n", "increment", None, 7, at(1), 0)]
    rows += [("s", "f", "n", "put", "old", None, None, 9), ("s", "f", "n", "put", "new", None, at(0), 0)]
    for hot in (NO_HOT_KEYS, HotKeys(("r", "s"), 5, 2)):
        assert result(resolve(spark.createDataFrame(rows, MUTATION), hot=hot)) == {("r", "f", "n"): "13", ("s", "f", "n"): "new"}
    table = MutationTable(spark, f"{tmp_path}/t")
    table.write(spark.createDataFrame(rows, MUTATION), 0)
    want = {("r", "f", "n"): "13", ("s", "f", "n"): "new"}
    assert result(table.cells()) == want
    table.compact(0, F.lit(at(5)).cast("timestamp"))
    assert result(table.cells()) == want


def test_arrival_order_compaction(spark, tmp_path, at):
    table = MutationTable(spark, f"{tmp_path}/t", ARRIVAL_ORDER)
    put = lambda v, t: spark.createDataFrame([("a", "f", "x", "put", v, None, at(t), 0)], MUTATION)
    table.write(put("late time", 9), 0)
    table.write(put("later batch", 1), 1)
    table.compact(1)
    assert result(table.cells()) == {("a", "f", "x"): "later batch"}
    table.write(put("last batch", 0), 2)
    assert result(table.cells()) == {("a", "f", "x"): "last batch"}


def test_unknown_family_stops_the_batch(spark, tmp_path, at):
    table = MutationTable(spark, f"{tmp_path}/t", families=["f"])
    with pytest.raises(Exception, match="unknown column family: h"):
        table.write(spark.createDataFrame([("a", "h", "x", "put", "1", None, at(1), 0)], MUTATION), 0)
    table.write(spark.createDataFrame([("a", None, None, "delete_row", None, None, at(1), 0)], MUTATION), 0)


def test_stream_checks_equal_batch_checks(spark, tmp_path, at):
    ops = sorted(random_checks(13, 150, at, True), key=lambda o: (o[5], o[6]))
    stream = write_parts(spark, ops, CHECK, f"{tmp_path}/in")
    table = MutationTable(spark, f"{tmp_path}/t", ARRIVAL_ORDER)
    start = [(*k, "put", v, None, at(0), 0) for k, v in CELLS.items()]
    table.write(spark.createDataFrame(start, MUTATION), -1)
    query = stream_checks(stream, table, f"{tmp_path}/cp", lambda df: df)
    query.awaitTermination()
    cells, applied = sequential_checks(CELLS, ops)
    assert result(table.cells()) == cells
    assert {r["seq"]: r["applied"] for r in table.decisions().collect()} == applied
    assert table.decisions().select("batch_id").distinct().count() == 3
    again = table.decisions().filter("batch_id = 1").drop("batch_id", "writer")
    table.write_decisions(spark.createDataFrame(again.collect(), again.schema), 1)
    assert result(table.cells()) == cells
    table.compact(1)
    assert result(table.cells()) == cells


def test_later_batches_of_checks_need_no_history(spark, tmp_path, at, monkeypatch):
    """Started again, the stream goes on from its state: the table is not read, and an idle row costs nothing."""
    ops = sorted(random_checks(17, 120, at, True), key=lambda o: (o[5], o[6]))
    table = MutationTable(spark, f"{tmp_path}/t", ARRIVAL_ORDER)
    start = [(*k, "put", v, None, at(0), 0) for k, v in CELLS.items()]
    table.write(spark.createDataFrame(start, MUTATION), -1)
    run = lambda: stream_checks(spark.readStream.schema(CHECK).parquet(f"{tmp_path}/in"), table, f"{tmp_path}/cp", lambda df: df)
    spark.createDataFrame(ops[:60], CHECK).write.parquet(f"{tmp_path}/in")
    run().awaitTermination()

    def unread(*args):
        raise AssertionError("the history was read")

    with monkeypatch.context() as patch:
        patch.setattr(MutationTable, "history", unread)
        spark.createDataFrame(ops[60:], CHECK).write.mode("append").parquet(f"{tmp_path}/in")
        query = run()
        query.awaitTermination()
    rows = {o[0] for o in ops[60:]}
    (state,) = query.lastProgress["stateOperators"]
    assert state["numRowsUpdated"] <= 20 * len(rows)
    assert result(table.cells()) == sequential_checks(CELLS, ops)[0]


def test_checks_that_name_an_unknown_family_stop_the_batch(spark, tmp_path, at):
    ops = [("a", "f", "x", None, [("put", "h", "x", "1")], at(1), 0)]
    stream = write_parts(spark, ops, CHECK, f"{tmp_path}/in", 1)
    table = MutationTable(spark, f"{tmp_path}/t", ARRIVAL_ORDER, families=["f"])
    with pytest.raises(StreamingQueryException, match="unknown column family: h"):
        stream_checks(stream, table, f"{tmp_path}/cp", lambda df: df).awaitTermination()


def test_restart_goes_on_after_a_transient_failure(spark, tmp_path, at):
    ops = random_ops(14, 90, at)
    stream = write_parts(spark, ops, MUTATION, f"{tmp_path}/in")
    table = MutationTable(spark, f"{tmp_path}/t")
    failures = []

    def flaky(batch):
        if len(failures) < 2 and table.history().select("batch_id").distinct().count() == len(failures) + 1:
            failures.append(1)
            raise TimeoutError("read timed out")
        return batch

    start = lambda: stream_mutations(stream, table, f"{tmp_path}/cp", flaky)
    assert run_with_restarts(start, lambda e: "timed out" in str(e)) == 2
    assert result(table.cells()) == sequential({}, ops)


def test_other_failures_are_raised(spark, tmp_path, at):
    stream = write_parts(spark, random_ops(15, 9, at), MUTATION, f"{tmp_path}/in")
    table = MutationTable(spark, f"{tmp_path}/t")

    def broken(batch):
        raise KeyError("broken")

    with pytest.raises(StreamingQueryException, match="broken"):
        run_with_restarts(
            lambda: stream_mutations(stream, table, f"{tmp_path}/cp", broken),
            lambda e: "timed out" in str(e),
        )
