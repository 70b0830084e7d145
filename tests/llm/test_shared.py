from pathlib import Path

from cellweave.llm.shared import FREE_SHUFFLES, drop_saved, saved


def test_saved_and_dropped(spark):
    before = spark.conf.get(FREE_SHUFFLES, None)
    kept = saved(spark.range(100).repartition(3, "id"), "kept")
    other = saved(kept.groupBy((kept.id % 7).alias("k")).count(), "other")
    assert kept.count() == 100 and other.count() == 7
    assert spark.conf.get(FREE_SHUFFLES, None) == before
    folder = Path(kept.inputFiles()[0].removeprefix("file://")).parent
    drop_saved(kept)
    assert not folder.exists() and other.count() == 7


def test_an_empty_table(spark):
    none = saved(spark.range(0), "none")
    assert none.count() == 0
    drop_saved(none)


def test_a_failed_write_restores_the_setting(spark):
    before = spark.conf.get(FREE_SHUFFLES, None)
    try:
        saved(spark.range(1).selectExpr("raise_error('no') AS x"), "failed")
    except Exception as e:
        assert "no" in str(e)
    assert spark.conf.get(FREE_SHUFFLES, None) == before
