import pytest

from cellweave.operators.lookup import bulk_get
from cellweave.plans import skew
from cellweave.plans.skew import NO_HOT_KEYS, HotKeys, keep_keys

REQUESTS = [(1, "a"), (2, "a"), (3, "b"), (4, "none"), (5, None), (6, "a")]
WANT = [(1, "a", "A"), (2, "a", "A"), (3, "b", "B"), (4, "none", None), (5, None, None), (6, "a", "A")]


def frames(spark):
    requests = spark.createDataFrame(REQUESTS, "n INT, row_key STRING")
    table = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "row_key STRING, v STRING")
    return requests, table


@pytest.mark.parametrize("hot", [None, NO_HOT_KEYS, HotKeys(("a", "none"), 4, 1)])
def test_every_request_has_one_answer(spark, hot):
    requests, table = frames(spark)
    got = bulk_get(requests, table, hot=hot).select("n", "row_key", "v").collect()
    assert sorted(map(tuple, got)) == WANT


def test_heavy_keys_do_not_shuffle_and_large_rows_are_not_broadcast(spark, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        requests, table = frames(spark)
        plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
        hot = HotKeys(("a",), 3, 1)
        assert "BroadcastHashJoin" in plan(bulk_get(requests, table, hot=hot))
        monkeypatch.setattr(skew, "MAX_BROADCAST_BYTES", 10)
        found = bulk_get(requests, table, hot=hot)
        assert "BroadcastHashJoin" not in plan(found)
        assert sorted(map(tuple, found.select("n", "row_key", "v").collect())) == WANT
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_keep_keys(spark, monkeypatch, limit):
    monkeypatch.setattr(skew, "MAX_BROADCAST_BYTES", limit)
    requests, table = frames(spark)
    assert sorted(r["n"] for r in keep_keys(requests, table, "row_key").collect()) == [1, 2, 3, 6]
    assert keep_keys(requests, table.limit(0), "row_key").count() == 0
