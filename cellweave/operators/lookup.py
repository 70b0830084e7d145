"""Keyed lookups: one result per request, misses included."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cellweave.plans.skew import NO_HOT_KEYS, HotKeys, hot_keys, lookup_join


def bulk_get(
    requests: DataFrame,
    table: DataFrame,
    on: str = "row_key",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Every request with the columns of its row, or NULLs where there is none.

    ``table`` has one row per key, as ``project`` makes it. A key that takes a
    large part of the requests does not shuffle. On a stream this is a
    stream-static join; the batches of a stream are weighed one by one when the
    call is made inside ``foreachBatch``.
    """
    if hot is None:
        hot = NO_HOT_KEYS if requests.isStreaming else hot_keys(requests, on)
    return lookup_join(requests, table, on, "left", hot)
