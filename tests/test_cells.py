import random
import time

import pytest
from pyspark.sql import functions as F

from cellweave.operators import cells as c
from cellweave.plans.skew import NO_HOT_KEYS, HotKeys
from cellweave.schema import CELL, cells
from cellweave.sources.tables import read_parquet, write_parquet


def versions(spark, at, rows):
    return spark.createDataFrame([(r, f, q, v, at(t), s) for r, f, q, v, t, s in rows], CELL)


def test_latest_breaks_time_ties_by_sequence(spark, at):
    df = versions(spark, at, [("a", "f", "", "1", 5, 1), ("a", "f", "", "2", 5, 2), ("a", "f", "", "3", 4, 9)])
    assert [(r["value"], r["seq"]) for r in c.latest(df).collect()] == [("2", 2)]


def test_versions_and_as_of(spark, at):
    df = versions(spark, at, [("a", "f", "q", str(t), t, 0) for t in range(5)])
    got = {r["version"]: r["value"] for r in c.last_versions(df, 2).collect()}
    assert got == {1: "4", 2: "3"}
    assert [r["value"] for r in c.as_of(df, F.lit(at(2)).cast("timestamp")).collect()] == ["2"]


def test_version_limit_reaches_the_map_side(spark, at):
    df = versions(spark, at, [("a", "f", "q", "1", 1, 0)])
    plan = c.last_versions(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_keys_compare_as_unsigned_bytes(spark, at):
    keys = ["a", "z", "\u007f", "é", "ﬀ", "😀"]
    df = versions(spark, at, [(k, "f", "", "1", 1, 0) for k in keys])
    got = {r["row_key"] for r in c.scan(df, start="\u007f", stop="ﬀ").collect()}
    assert got == {k for k in keys if b"\x7f" <= k.encode() < "ﬀ".encode()}


def test_keys_may_be_any_bytes(spark, at, tmp_path):
    """Bytes that are no UTF-8 keep their order and come back unchanged."""
    keys = [b"\x00", b"a", b"\x7f", b"\x80", b"\xc3(", b"\xff"]
    raw = spark.createDataFrame([(bytearray(k),) for k in keys], "k BINARY")
    df = cells(raw, row_key=F.col("k"), family=F.lit("f"), qualifier=F.lit(""), value=F.col("k"))
    write_parquet(df, f"{tmp_path}/t")
    found = c.scan(read_parquet(spark, f"{tmp_path}/t"), start="a").filter(F.col("row_key") < F.lit(b"\xff").cast("string"))
    rows = c.to_rows(found, hot=NO_HOT_KEYS).select(F.col("row_key").cast("binary").alias("k"))
    assert sorted(bytes(r["k"]) for r in rows.collect()) == [b"a", b"\x7f", b"\x80", b"\xc3("]


def test_scan_by_family_column_and_time(spark, at):
    df = versions(spark, at, [("a", "f", "x", "1", 1, 0), ("a", "f", "y", "2", 2, 0), ("a", "g", "x", "3", 3, 0)])
    values = lambda d: sorted(r["value"] for r in d.collect())
    assert values(c.scan(df, families=["f"])) == ["1", "2"]
    assert values(c.scan(df, columns=[("f", "y"), ("g", "x")])) == ["2", "3"]
    low, high = F.lit(at(2)).cast("timestamp"), F.lit(at(3)).cast("timestamp")
    assert values(c.scan(df, min_ts=low, max_ts=high)) == ["2"]


def test_scan_filters_reach_the_files(spark, at, tmp_path):
    df = versions(spark, at, [("a", "f", "x", "1", 1, 0), ("b", "g", "x", "2", 1, 0)])
    write_parquet(df, f"{tmp_path}/t")
    found = c.scan(read_parquet(spark, f"{tmp_path}/t"), families=["f"], start="a", stop="b")
    assert [r["value"] for r in found.collect()] == ["1"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "family#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(row_key,a), LessThan(row_key,b)" in plan


def test_rows_are_ordered_and_whole(spark, at):
    given = [("a", f, q, f + q, 1, 0) for f in "gf" for q in ["z", "", "m"]]
    (row,) = c.to_rows(versions(spark, at, given)).collect()
    got = [(x["family"], x["qualifier"]) for x in row["cells"]]
    assert got == sorted((f, q) for _, f, q, *_ in given)


def random_versions(seed, at):
    rnd = random.Random(seed)
    given, used = [], set()
    for k, n in [("a", 190), ("b", 9), ("c", 1), ("d", 150), ("é", 40)]:
        for _ in range(n):
            cell = (k, rnd.choice(["f", "", "gé"]), f"{rnd.randrange(n // 3 + 1):03d}"[rnd.randrange(3) :])
            t, s = rnd.randrange(5), rnd.randrange(1000)
            if (cell, t, s) not in used:
                used.add((cell, t, s))
                given.append((*cell, rnd.choice(["v", "", "w" * 9]), t, s))
    return given


def by_row(given, versions):
    """Rows of (family, qualifier, value, ts, seq) in order, in plain Python."""
    rows = {}
    for r, f, q, v, t, s in sorted(given, key=lambda g: (g[0].encode(), g[1].encode(), g[2].encode(), -g[4], -g[5])):
        own = rows.setdefault(r, [])
        if versions is None or sum(x[:2] == (f, q) for x in own) < versions:
            own.append((f, q, v, t, s))
    return rows


@pytest.mark.parametrize("versions", [1, 2, None])
@pytest.mark.parametrize("batch", [None, 7])
def test_heavy_rows_equal_light_rows(spark, at, versions, batch):
    given = random_versions(4, at)
    df = versions_of(spark, at, given).repartition(5)
    want = by_row(given, versions)
    for hot in (NO_HOT_KEYS, HotKeys(("a", "é"), 230, 40), HotKeys(("a", "b", "c", "d", "é", "none"), 390, 20)):
        rows = c.to_rows(df, versions=versions, batch=batch, hot=hot).collect()
        got = {}
        for r in sorted(rows, key=lambda r: r["part"] if batch else 0):
            own = got.setdefault(r["row_key"], [])
            if batch:
                assert r["part"] * batch == len(own) and len(r["cells"]) <= batch
            else:
                assert not own
            own += [tuple(x) for x in r["cells"]]
        if versions == 1:
            assert got == {k: [x[:3] for x in own] for k, own in want.items()}
        else:
            assert got == {k: [(*x[:3], at(x[3]), x[4]) for x in own] for k, own in want.items()}


versions_of = versions


def test_a_table_put_twice_has_one_version_a_cell(spark, at):
    df = versions(spark, at, [("a", "f", "q", "1", 1, 0), ("a", "f", "q", "2", 2, 0), ("a", "f", "p", "3", 1, 0)])
    for hot in (NO_HOT_KEYS, HotKeys(("a",), 3, 1)):
        (row,) = c.to_rows(df, hot=hot).collect()
        assert [tuple(x) for x in row["cells"]] == [("f", "p", "3"), ("f", "q", "2")]
        for wanted in (1, 2, None):
            (row,) = c.to_maps(c.to_rows(df, versions=wanted, hot=hot)).collect()
            assert row["families"] == {"f": {"p": "3", "q": "2"}}


def test_light_rows_cost_one_shuffle(spark, at):
    df = versions(spark, at, [("a", "f", "q", "1", 1, 0)])
    for wanted in (1, 3, None):
        plan = c.to_rows(df, versions=wanted, hot=NO_HOT_KEYS)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1


def test_maps_and_missing_cells(spark, at):
    df = versions(spark, at, [("a", "f", "", "1", 1, 0), ("a", "g", "x", "2", 1, 0)])
    m = c.to_maps(c.to_rows(df))
    look = [c.map_value(F.col("families"), f, q) for f, q in [("f", ""), ("g", "x"), ("g", "y"), ("h", "x")]]
    assert tuple(m.select(*look).collect()[0]) == ("1", "2", None, None)


def test_maps_of_a_wide_row_take_linear_time(spark):
    """30,000 cells a family: looking a family through for each of its cells took minutes."""
    n = 30_000
    each = F.expr("struct(f as family, concat('q', i div 2) as qualifier, concat('v', i) as value)")
    df = spark.range(2 * n).select(
        F.when(F.col("id") < n, "f").otherwise("g").alias("f"), (F.col("id") % n).alias("i")
    )
    cells = F.array_sort(F.collect_list(F.struct("f", "i", each.alias("cell"))))
    row = df.agg(F.transform(cells, lambda c: c["cell"]).alias("cells")).withColumn("row_key", F.lit("a"))
    began = time.monotonic()
    (got,) = c.to_maps(row).collect()
    assert time.monotonic() - began < 20
    want = {f"q{i}": f"v{2 * i}" for i in range(n // 2)}
    assert got["families"] == {"f": want, "g": want}


def test_projection_reads_only_the_named_cells(spark, at):
    df = versions(spark, at, [("a", "f", "x", "1", 1, 0), ("a", "g", "y", "2", 1, 0), ("b", "f", "z", "3", 1, 0)])
    got = [tuple(r) for r in c.project(df, {"p": ("f", "x"), "q": ("g", "y"), "r": ("g", "no")}).collect()]
    assert got == [("a", "1", "2", None)]


def test_render(spark, at):
    df = versions(spark, at, [("a", "f", "", "1", 1, 0)])
    (row,) = c.render(c.to_rows(df)).collect()
    assert row["value"] == '[{"family":"f","qualifier":"","value":"1"}]'
