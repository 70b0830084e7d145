"""Queries that read cells: versions, scans, rows, maps and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators.cells import (
    as_of,
    last_versions,
    latest,
    map_rows,
    map_value,
    project,
    render,
    scan,
    to_maps,
    to_rows,
)
from cellweave.operators.lookup import bulk_get
from cellweave.plans.inputs import customer_cells, event_puts, scratch, table, weighed
from cellweave.schema import cells
from cellweave.sources.tables import read_parquet, read_raw, scan_ranged, write_parquet, write_ranged

CUSTOMER_COLUMNS = {
    "name": ("general", "name"),
    "segment": ("general", "segment"),
    "nation": ("geo", "nation"),
}


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(event_puts(table(spark, sf_dir, "events")))


def _number(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns, F.col("value").cast("double").alias("value"))


def _stored_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "customers")
    write_parquet(customer_cells(spark, sf_dir), path)
    return read_parquet(spark, path)


def _as_text(cell_array: str = "cells") -> Column:
    each = F.transform(
        cell_array, lambda c: F.concat(c["family"], F.lit(":"), c["qualifier"], F.lit("="), c["value"])
    )
    return F.array_join(each, ";")


def latest_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _number(latest(_versions(spark, sf_dir)), "row_key", "qualifier")


def cell_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _number(last_versions(_versions(spark, sf_dir), 3), "row_key", "qualifier", "version")


def cells_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    middle = F.lit("2024-01-15").cast("timestamp")
    return _number(as_of(_versions(spark, sf_dir), middle), "row_key", "qualifier")


def scan_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key range of one family, as rows, from cells stored by family."""
    found = scan(_stored_customers(spark, sf_dir), families=["general"], start="10", stop="20")
    return to_rows(found).select("row_key", _as_text().alias("cells"))


def scan_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key range from files clustered by key, of which only those that meet it are opened."""
    path = scratch(spark, "ranged")
    write_ranged(customer_cells(spark, sf_dir), path, 16)
    found = scan_ranged(spark, path, families=["general", "geo"], start="10", stop="105")
    return to_rows(found).select("row_key", _as_text().alias("cells"))


def scan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single rows of a table by ranges."""
    path = scratch(spark, "ranged")
    write_ranged(customer_cells(spark, sf_dir), path, 16)
    found = scan_ranged(spark, path, keys=["7", "42", "11", "none"])
    return to_rows(found).select("row_key", _as_text().alias("cells"))


def scan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table as rows of ordered cells."""
    return to_rows(customer_cells(spark, sf_dir)).select("row_key", _as_text().alias("cells"))


def _times(cell_array: str = "cells") -> Column:
    each = F.transform(
        cell_array,
        lambda c: F.concat(c["qualifier"], F.lit("="), c["value"], F.lit("@"), c["seq"].cast("string")),
    )
    return F.array_join(each, ";")


def _wide_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as cells with many versions: a row a user, and all views and clicks in one heavy row."""
    events = table(spark, sf_dir, "events")
    busy = F.col("event_type").isin("view", "click")
    return cells(
        events,
        row_key=F.when(busy, F.lit("busy")).otherwise(F.col("user_id").cast("string")),
        family=F.when(busy, F.col("event_type")).otherwise(F.lit("events")),
        qualifier=F.when(busy, F.col("user_id").cast("string")).otherwise(F.col("event_type")),
        value=F.get_json_object("props", "$.k"),
        ts=F.col("ts").cast("timestamp"),
        seq=F.col("event_id"),
    )


def scan_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with the two newest versions of every cell, the heavy row put together from ranges."""
    found = _wide_events(spark, sf_dir)
    rows = to_rows(found, versions=2, hot=weighed(found, "row_key"))
    return rows.select("row_key", _times().alias("cells"))


def scan_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest view of a table with many versions, as rows and as maps."""
    found = _wide_events(spark, sf_dir)
    rows = to_rows(found, hot=weighed(found, "row_key"))
    maps = to_maps(rows).select(F.col("row_key").alias("_row"), F.map_keys("families").alias("families"))
    joined = rows.join(maps, F.col("row_key") == F.col("_row"))
    families = F.array_join(F.array_sort("families"), ",")
    return joined.select("row_key", _as_text().alias("cells"), families.alias("families"))


def scan_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of every row in parts of a hundred cells."""
    found = _wide_events(spark, sf_dir)
    rows = to_rows(found, versions=None, batch=100, hot=weighed(found, "row_key"))
    return rows.select("row_key", "part", _times().alias("cells"))


def scan_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan of two named columns in different families."""
    found = scan(
        _stored_customers(spark, sf_dir), columns=[("general", "segment"), ("geo", "nation")]
    )
    return to_rows(found).select("row_key", _as_text().alias("cells"))


def scan_row_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan with a row function: cell count and total value length of each row."""
    total = F.aggregate("cells", F.lit(0), lambda n, c: n + F.length(c["value"]))
    rows = to_rows(customer_cells(spark, sf_dir))
    return map_rows(
        rows, F.col("row_key"), F.size("cells").alias("n_cells"), total.alias("value_length")
    )


def row_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested maps and lookups in them; a column that is not there gives NULL."""
    maps = to_maps(to_rows(customer_cells(spark, sf_dir)))
    families = F.col("families")
    return maps.select(
        "row_key",
        map_value(families, "general", "name").alias("name"),
        map_value(families, "geo", "nation").alias("nation"),
        map_value(families, "geo", "street").alias("street"),
        F.size("families").alias("n_families"),
    )


def cell_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project(customer_cells(spark, sf_dir), CUSTOMER_COLUMNS)


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table as it is."""
    path = scratch(spark, "raw")
    write_parquet(customer_cells(spark, sf_dir), path)
    return read_raw(spark, path).select("row_key", F.col("family").cast("string"), "qualifier", "value")


def rendered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and row as strings."""
    return render(to_rows(customer_cells(spark, sf_dir))).select("row_key", "value")


def get_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders look up twice their customer's key; about half of them find nothing."""
    requests = table(spark, sf_dir, "orders").select(
        "o_orderkey", (F.col("o_custkey") * 2).cast("string").alias("row_key")
    )
    customers = project(customer_cells(spark, sf_dir), CUSTOMER_COLUMNS)
    return bulk_get(requests, customers).select("o_orderkey", "row_key", *CUSTOMER_COLUMNS)


def get_hot_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookups where one key takes the requests of a whole order status."""
    key = F.when(F.col("o_orderstatus") == "F", F.lit(1)).otherwise(F.col("o_custkey"))
    requests = table(spark, sf_dir, "orders").select(
        "o_orderkey", key.cast("string").alias("row_key")
    )
    customers = project(customer_cells(spark, sf_dir), CUSTOMER_COLUMNS)
    found = bulk_get(requests, customers, hot=weighed(requests, "row_key"))
    return found.select("o_orderkey", "row_key", *CUSTOMER_COLUMNS)


QUERIES = {
    "latest_cells": latest_cells,
    "cell_versions3": cell_versions,
    "cells_as_of": cells_as_of,
    "scan_range": scan_range,
    "scan_ranges": scan_ranges,
    "scan_keys": scan_keys,
    "scan_rows": scan_rows,
    "scan_versions": scan_versions,
    "scan_latest": scan_latest,
    "scan_parts": scan_parts,
    "scan_columns": scan_columns,
    "scan_row_function": scan_row_function,
    "row_maps": row_maps,
    "cell_projection": cell_projection,
    "raw_table": raw_table,
    "rendered_rows": rendered_rows,
    "bulk_get": get_customers,
    "bulk_get_hot": get_hot_customer,
}

_LATEST = """
    SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS qualifier,
           arg_max(value, (ts, event_id)) AS value
    FROM events {0} GROUP BY user_id, event_type"""

_CELLS = """
    SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'general' AS family, 'name' AS qualifier,
           c_name AS value FROM customer WHERE c_name IS NOT NULL
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'general', 'segment', c_mktsegment
    FROM customer WHERE c_mktsegment IS NOT NULL
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'geo', 'nation', CAST(c_nationkey AS VARCHAR)
    FROM customer WHERE c_nationkey IS NOT NULL"""


def _rows(where: str = "true") -> str:
    return f"""
    SELECT row_key, string_agg(family || ':' || qualifier || '=' || value, ';'
                               ORDER BY family, qualifier) AS cells
    FROM ({_CELLS}) WHERE {where} GROUP BY row_key"""


# Versions of the wide events: n counts those of a cell from the newest, place all of a row.
_WIDE = """
    SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY family, qualifier, n) AS place
    FROM (SELECT *, row_number() OVER (PARTITION BY row_key, family, qualifier ORDER BY ts DESC, seq DESC) AS n
          FROM (SELECT CASE WHEN busy THEN 'busy' ELSE CAST(user_id AS VARCHAR) END AS row_key,
                       CASE WHEN busy THEN event_type ELSE 'events' END AS family,
                       CASE WHEN busy THEN CAST(user_id AS VARCHAR) ELSE event_type END AS qualifier,
                       json_extract_string(props, '$.k') AS value, ts, event_id AS seq
                FROM (SELECT *, event_type IN ('view', 'click') AS busy FROM events)))"""
_VERSION = "string_agg(qualifier || '=' || value || '@' || seq, ';' ORDER BY place) AS cells"


def _get(key: str) -> str:
    return f"""
    SELECT o_orderkey, row_key, c_name AS name, c_mktsegment AS segment,
           CAST(c_nationkey AS VARCHAR) AS nation
    FROM (SELECT o_orderkey, CAST({key} AS VARCHAR) AS row_key FROM orders)
    LEFT JOIN customer ON row_key = CAST(c_custkey AS VARCHAR)"""


ORACLES = {
    "latest_cells": _LATEST.format(""),
    "cell_versions3": """
    SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS qualifier,
           CAST(version AS INTEGER) AS version, value
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                       ORDER BY ts DESC, event_id DESC) AS version FROM events)
    WHERE version <= 3""",
    "cells_as_of": _LATEST.format("WHERE ts <= TIMESTAMP '2024-01-15'"),
    "scan_range": _rows("family = 'general' AND row_key >= '10' AND row_key < '20'"),
    "scan_ranges": _rows("row_key >= '10' AND row_key < '105'"),
    "scan_keys": _rows("row_key IN ('7', '42', '11', 'none')"),
    "scan_rows": _rows(),
    "scan_versions": f"SELECT row_key, {_VERSION} FROM ({_WIDE}) WHERE n <= 2 GROUP BY row_key",
    "scan_latest": f"""
    SELECT row_key, string_agg(family || ':' || qualifier || '=' || value, ';' ORDER BY place) AS cells,
           array_to_string(list_sort(list(DISTINCT family)), ',') AS families
    FROM ({_WIDE}) WHERE n = 1 GROUP BY row_key""",
    "scan_parts": f"""
    SELECT row_key, (place - 1) // 100 AS part, {_VERSION} FROM ({_WIDE}) GROUP BY row_key, part""",
    "scan_columns": _rows("qualifier IN ('segment', 'nation')"),
    "scan_row_function": f"""
    SELECT row_key, CAST(count(*) AS INTEGER) AS n_cells,
           CAST(sum(length(value)) AS INTEGER) AS value_length
    FROM ({_CELLS}) GROUP BY row_key""",
    "row_maps": """
    SELECT CAST(c_custkey AS VARCHAR) AS row_key, c_name AS name,
           CAST(c_nationkey AS VARCHAR) AS nation, CAST(NULL AS VARCHAR) AS street,
           CAST(2 AS INTEGER) AS n_families
    FROM customer""",
    "cell_projection": """
    SELECT CAST(c_custkey AS VARCHAR) AS row_key, c_name AS name, c_mktsegment AS segment,
           CAST(c_nationkey AS VARCHAR) AS nation FROM customer""",
    "raw_table": _CELLS,
    "rendered_rows": f"""
    SELECT row_key, CAST(to_json(list({{'family': family, 'qualifier': qualifier, 'value': value}}
                                 ORDER BY family, qualifier)) AS VARCHAR) AS value
    FROM ({_CELLS}) GROUP BY row_key""",
    "bulk_get": _get("2 * o_custkey"),
    "bulk_get_hot": _get("CASE WHEN o_orderstatus = 'F' THEN 1 ELSE o_custkey END"),
}
