import random

import pytest
from pyspark.sql import functions as F

from cellweave.operators.cells import scan
from cellweave.operators.lookup import bulk_get
from cellweave.operators.cells import project
from cellweave.plans.skew import HotKeys
from cellweave.schema import CELL
from cellweave.sources import tables, text


def lines(spark, path):
    return sorted(r["value"] for r in text.read_lines(spark, path).collect())


def test_pairs(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b c", 2), (None, 3)], "word STRING, cnt BIGINT")
    text.save_pairs(df, f"{tmp_path}/p", "word", "cnt")
    assert lines(spark, f"{tmp_path}/p") == ["3", "a\t1", "b c\t2"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        text.save_pairs(df, f"{tmp_path}/p", "word", "cnt")


def test_values_leave_out_empty_ones(spark, tmp_path):
    df = spark.createDataFrame([("k", "v"), ("l", ""), ("m", None)], "key STRING, value STRING")
    text.save_values(df, f"{tmp_path}/v")
    assert lines(spark, f"{tmp_path}/v") == ["v"]


def test_line_ends_and_globs(spark, tmp_path):
    (tmp_path / "a.log").write_bytes(b"x\ny\r\nz\rw")
    (tmp_path / "b.log").write_bytes(b"")
    (tmp_path / "c.txt").write_bytes(b"no")
    assert lines(spark, f"{tmp_path}/*.log") == ["w", "x", "y", "z"]


def test_preview(spark):
    assert text.preview(spark.range(100)).count() == 10


def test_create_table_twice_and_unknown_family(spark, tmp_path, at):
    cell = lambda family: spark.createDataFrame([("a", family, "", "1", at(1), 0)], CELL)
    for _ in range(2):
        tables.create_cell_table(spark, "some_cells", ["f", "g"], f"{tmp_path}/t")
    assert tables.table_families(spark, "some_cells") == ["f", "g"]
    tables.append_cells(spark, "some_cells", cell("f"))
    with pytest.raises(Exception, match="unknown column family: h"):
        tables.append_cells(spark, "some_cells", cell("h"))
    assert [r["family"] for r in tables.read_cells(spark, "some_cells").collect()] == ["f"]
    spark.sql("DROP TABLE some_cells")


def ranged(spark, at, path, ranges=8):
    """Rows of one to three cells in two families, and one row of many."""
    rnd = random.Random(9)
    rows = [(f"{rnd.randrange(10**6):06d}", f, q, "v", at(1), 0) for _ in range(600) for f in "fg" for q in rnd.sample("xyz", 1)]
    rows += [("5", "f", f"{i:04d}", "v", at(1), 0) for i in range(900)]
    df = spark.createDataFrame(rows, CELL)
    tables.write_ranged(df, path, ranges)
    return df


def opened(df):
    return metric(df, "numFiles")


def metric(df, name):
    """A count of the scan, from the plan that ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply(name).value()


def test_ranged_scans_equal_plain_ones_and_open_fewer_files(spark, at, tmp_path):
    df = ranged(spark, at, f"{tmp_path}/t")
    whole = tables.scan_ranged(spark, f"{tmp_path}/t")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, df.collect()))
    for asked in (
        {"start": "2", "stop": "21"},
        {"families": ["f"], "start": "5", "stop": "50"},
        {"columns": [("f", "x"), ("g", "y")], "stop": "3"},
        {"families": ["f"], "columns": [("g", "x")]},
        {"families": ["none"]},
        {"start": "999999zz"},
    ):
        got = tables.scan_ranged(spark, f"{tmp_path}/t", **asked)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, scan(df, **asked).collect())), asked
    family = opened(tables.scan_ranged(spark, f"{tmp_path}/t", families=["g"]))
    assert opened(tables.scan_ranged(spark, f"{tmp_path}/t", families=["g"], start="500000", stop="500900")) < family
    # The row of many cells is in more than one file.
    assert opened(tables.scan_ranged(spark, f"{tmp_path}/t", families=["f"], keys=["5"])) > 1


def test_single_keys_open_their_files_and_skip_row_groups(spark, at, tmp_path):
    df = ranged(spark, at, f"{tmp_path}/t", 2)
    there = df.filter("family = 'g'").first()["row_key"]
    got = tables.scan_ranged(spark, f"{tmp_path}/t", keys=[there, "none", "4999995"])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.filter(F.col("row_key") == there).collect()))
    absent = tables.scan_ranged(spark, f"{tmp_path}/t", families=["g"], keys=["4999995"])
    assert metric(absent, "numFiles") >= 1 and metric(absent, "numOutputRows") == 0


def test_bucketed_lookups_prune_and_split(spark, at, tmp_path):
    rows = [(str(i), "f", "x", f"v{i}", at(1), 0) for i in range(400)] + [("hot", "f", f"{i}", "h", at(1), 0) for i in range(300)]
    stored = tables.BucketedTable.write(spark.createDataFrame(rows, CELL), f"{tmp_path}/b", 32)
    assert stored.cells().count() == 700
    requests = spark.createDataFrame([(i, k) for i, k in enumerate(["7", "9", "hot", "none", None] + ["7"] * 50)], "n INT, row_key STRING")
    cells = stored.cells(requests)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert metric(cells, "numPartitions") <= 5
    rows = project(cells, {"x": ("f", "x")})
    for hot in (None, HotKeys(("7",), 51, 10)):
        got = sorted((r["n"], r["x"]) for r in bulk_get(requests, rows, hot=hot).collect())
        assert got == [(0, "v7"), (1, "v9"), (2, None), (3, None), (4, None)] + [(i, "v7") for i in range(5, 55)]
    assert tables.BucketedTable(spark, f"{tmp_path}/b").buckets == 32
    assert stored.cells(requests.limit(0)).count() == 0
