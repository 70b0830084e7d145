"""All registered queries, and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from cellweave.plans import cell_queries, mutation_queries, stream_queries, text_queries
from cellweave.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
_PARTS = [text_queries, cell_queries, mutation_queries, stream_queries]


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    return {name: _shipped(q) for part in _PARTS for name, q in part.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
