"""Cell tables: catalog tables partitioned by family, plain Parquet, and files by key range or by bucket."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.operators.cells import scan
from cellweave.schema import CELL, CELL_COLUMNS, record, require_families

FAMILIES_PROPERTY = "column.families"


def create_cell_table(
    spark: SparkSession, name: str, families: Sequence[str], location: str | None = None
) -> None:
    """Create a table of cells unless it exists; its families are fixed here.

    Each family is a partition, so a scan of one family reads no other.
    """
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in CELL.fields)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY (family){place} "
        f"TBLPROPERTIES ('{FAMILIES_PROPERTY}' = '{','.join(families)}')"
    )


def table_families(spark: SparkSession, name: str) -> list[str]:
    row = spark.sql(f"SHOW TBLPROPERTIES {name} ('{FAMILIES_PROPERTY}')").first()
    return row["value"].split(",")


def append_cells(spark: SparkSession, name: str, cell_rows: DataFrame) -> None:
    """Append cell versions; a family the table does not have fails the job."""
    checked = require_families(cell_rows, table_families(spark, name))
    columns = [c for c in CELL_COLUMNS if c != "family"] + ["family"]
    checked.select(*columns).write.insertInto(name)


def read_cells(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).select(*CELL_COLUMNS)


def write_parquet(cell_rows: DataFrame, path: str) -> None:
    """Write cells by family, in key order within each file.

    Ordered files give tight minima and maxima, so that a key range skips most
    row groups; the sort is local and adds no shuffle.
    """
    ordered = cell_rows.select(*CELL_COLUMNS).sortWithinPartitions("family", "row_key", "qualifier")
    ordered.write.partitionBy("family").parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CELL).parquet(path).select(*CELL_COLUMNS)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """A whole table as it is stored."""
    return spark.read.parquet(path)


_RANGED = T.StructType([*CELL, *record(range=T.IntegerType())])
_BOUNDS = record(
    family=T.StringType(), range=T.IntegerType(), low=T.StringType(), high=T.StringType()
)
_BUCKETED = T.StructType([*CELL, *record(bucket=T.IntegerType())])


def write_ranged(cell_rows: DataFrame, path: str, ranges: int | None = None) -> None:
    """Write cells by family and key range, one file or more to each, with the bounds of each beside them.

    A row of many cells spans several ranges. Files carry Bloom filters on the row key.
    """
    keys = ["family", "row_key", "qualifier"]
    dealt = cell_rows.select(*CELL_COLUMNS)
    dealt = dealt.repartitionByRange(ranges, *keys) if ranges else dealt.repartitionByRange(*keys)
    placed = dealt.withColumn("range", F.spark_partition_id()).sortWithinPartitions(*keys)
    written = placed.write.partitionBy("family", "range").option(
        "parquet.bloom.filter.enabled#row_key", "true"
    )
    written.parquet(f"{path}/data")
    stored = cell_rows.sparkSession.read.schema(_RANGED).parquet(f"{path}/data")
    bounds = stored.groupBy("family", "range").agg(
        F.min("row_key").alias("low"), F.max("row_key").alias("high")
    )
    bounds.coalesce(1).write.parquet(f"{path}/bounds")


def scan_ranged(
    spark: SparkSession,
    path: str,
    families: Sequence[str] | None = None,
    columns: Sequence[tuple[str, str]] | None = None,
    start: str | None = None,
    stop: str | None = None,
    keys: Sequence[str] | None = None,
    min_ts: Column | None = None,
    max_ts: Column | None = None,
) -> DataFrame:
    """``cells.scan`` over a ranged table; also for single ``keys``.

    Only files whose bounds meet the scan are opened. Ranges follow the keys, so
    those that meet it are consecutive, and of each family the first and the last suffice.
    """
    met = spark.read.schema(_BOUNDS).parquet(f"{path}/bounds")
    asked = set(families) if families is not None else None
    if columns is not None:
        named = {family for family, _ in columns}
        asked = named if asked is None else asked & named
    if asked is not None:
        met = met.filter(F.col("family").isin(list(asked)))
    if start is not None:
        met = met.filter(F.col("high") >= start)
    if stop is not None:
        met = met.filter(F.col("low") < stop)
    if keys is not None:
        between = [(F.col("low") <= k) & (F.col("high") >= k) for k in keys]
        met = met.filter(reduce(lambda a, b: a | b, between, F.lit(False)))
    spans = met.groupBy("family").agg(F.min("range").alias("first"), F.max("range").alias("last"))
    opened = F.lit(False)
    for span in spans.collect():  # one for each family
        inside = F.col("range").between(span["first"], span["last"])
        opened = opened | ((F.col("family") == span["family"]) & inside)
    stored = spark.read.schema(_RANGED).parquet(f"{path}/data").filter(opened)
    if keys is not None:
        stored = stored.filter(F.col("row_key").isin(list(keys)))
    found = scan(stored, families, columns, start, stop, min_ts, max_ts)
    return found.select(*CELL_COLUMNS)


class BucketedTable:
    """Cells in folders by a hash of the row key, so that lookups open only the buckets of their keys."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        sizes = spark.read.schema("buckets INT").parquet(f"{path}/size")
        self.buckets = sizes.first()["buckets"]

    @classmethod
    def write(cls, cell_rows: DataFrame, path: str, buckets: int) -> BucketedTable:
        """Buckets of one heavy row are written by several tasks."""
        spark = cell_rows.sparkSession
        placed = cell_rows.select(*CELL_COLUMNS, _bucket(F.col("row_key"), buckets).alias("bucket"))
        placed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{path}/data")
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(f"{path}/size")
        return cls(spark, path)

    def cells(self, rows_of: DataFrame | None = None, on: str = "row_key") -> DataFrame:
        """All cells, or those in the buckets of the keys that ``rows_of`` holds; there are no more of them than buckets."""
        stored = self.spark.read.schema(_BUCKETED).parquet(f"{self.path}/data")
        if rows_of is not None:
            asked = rows_of.select(_bucket(F.col(on), self.buckets).alias("bucket")).distinct()
            numbers = [r["bucket"] for r in asked.collect()]
            stored = stored.filter(F.col("bucket").isin(numbers))
        return stored.select(*CELL_COLUMNS)


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
