"""Queries that change cells: put, increment, delete, mixes and conditional operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators.conditional import check_and_mutate, decide, decide_single
from cellweave.operators.mutations import (
    apply,
    compact,
    delete_cells,
    delete_families,
    delete_rows,
    increment,
    put,
    resolve,
)
from cellweave.plans.inputs import (
    customer_cells,
    event_checks,
    event_deltas,
    event_mix,
    event_puts,
    event_tombstones,
    table,
    weighed,
)
from cellweave.schema import (
    CELL,
    DELETE_CELL,
    PUT,
    cells,
    checks,
    delete_change,
    mutations,
    put_change,
    puts_from_wide,
)

CELL_TEXT = ["row_key", "family", "qualifier", "value"]


def _no_cells(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CELL)


def _hot_rows(kind: Column) -> Column:
    """Row keys where all views and clicks fall on one row."""
    return F.when(kind.isin("view", "click"), F.lit("busy")).otherwise(
        F.col("user_id").cast("string")
    )


def bulk_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders put their status and date into their customer's row, last order first."""
    placed = F.col("o_orderdate").cast("timestamp")
    puts = puts_from_wide(
        table(spark, sf_dir, "orders"),
        row_key=F.col("o_custkey"),
        values={
            ("general", "segment"): F.col("o_orderpriority"),
            ("orders", "last"): F.col("o_orderkey"),
        },
        ts=placed,
        seq=F.col("o_orderkey"),
    )
    return put(customer_cells(spark, sf_dir), cells(puts)).select(*CELL_TEXT)


def bulk_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that start from each user's largest event number."""
    events = table(spark, sf_dir, "events")
    start = cells(
        events.groupBy("user_id").agg(F.max("event_id").alias("value")),
        row_key=F.col("user_id"),
        family=F.lit("events"),
        qualifier=F.lit("view"),
        value=F.col("value"),
    )
    return increment(start, event_deltas(events)).select(
        "row_key", "qualifier", F.col("value").cast("long").alias("value")
    )


def bulk_delete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an urgent order lose their row."""
    urgent = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    keys = urgent.select(F.col("o_custkey").cast("string").alias("row_key"))
    return delete_rows(customer_cells(spark, sf_dir), keys).select(*CELL_TEXT)


def bulk_delete_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers who ordered lose their segment."""
    doomed = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("row_key"),
        F.lit("general").alias("family"),
        F.lit("segment").alias("qualifier"),
    )
    return delete_cells(customer_cells(spark, sf_dir), doomed).select(*CELL_TEXT)


def bulk_delete_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers who ordered lose the family that depends on their order's status."""
    family = F.when(F.col("o_orderstatus") == "F", "geo").otherwise("general")
    doomed = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("row_key"), family.alias("family")
    )
    return delete_families(customer_cells(spark, sf_dir), doomed).select(*CELL_TEXT)


def tombstone_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = resolve(event_tombstones(table(spark, sf_dir, "events")))
    return live.select("row_key", "qualifier", F.col("value").cast("double").alias("value"))


def mixed_mutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    ops = event_mix(table(spark, sf_dir, "events"))
    live = apply(_no_cells(spark), ops)
    return live.select("row_key", F.col("value").cast("long").alias("score"))


def mixed_hot_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same mix on one counter for most events, cut into slices of time."""
    events = table(spark, sf_dir, "events").withColumn("user_id", _hot_rows(F.col("event_type")))
    ops = event_mix(events)
    live = resolve(ops, hot=weighed(ops, "row_key"))
    return live.select("row_key", F.col("value").cast("long").alias("score"))


def compacted_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history compacted with its deletes, then the later half applied to it."""
    ops = event_tombstones(table(spark, sf_dir, "events"))
    late = F.col("ts") >= F.lit("2024-01-15").cast("timestamp")
    live = resolve(compact(ops.filter(~late)).unionByName(ops.filter(late)))
    return live.select("row_key", "qualifier", F.col("value").cast("double").alias("value"))


def check_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's cells after check-and-put and check-and-delete of all events."""
    ops = event_checks(table(spark, sf_dir, "events"))
    return check_and_mutate(_no_cells(spark), ops).cells.select(*CELL_TEXT)


def check_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which operations applied."""
    ops = event_checks(table(spark, sf_dir, "events"))
    return decide(_no_cells(spark), ops).select(F.col("seq").alias("event_id"), "applied")


def check_hot_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events on one row: its operations are decided slice by slice."""
    ops = event_checks(table(spark, sf_dir, "events"), row_key=F.lit("all"))
    decided = decide(_no_cells(spark), ops, hot=weighed(ops, "row_key"))
    return decided.select(F.col("seq").alias("event_id"), "applied")


def check_entangled_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events on one row whose two checked cells change each other, or go with the row."""
    kind = F.col("event_type")
    state = ("door", "state")
    on_state = kind.isin("signup", "click", "error")
    ops = checks(
        table(spark, sf_dir, "events"),
        row_key=F.lit("all"),
        chk_family=F.lit("door"),
        chk_qualifier=F.when(on_state, "state").otherwise("gate"),
        expected=F.when(kind == "view", "open").when(kind == "click", "view").when(kind == "purchase", "shut").when(kind == "error", "purchase"),
        changes=F.when(kind == "signup", F.array(put_change(*state, kind), put_change("door", "gate", F.lit("open"))))
        .when(kind == "click", F.array(put_change("door", "gate", F.lit("shut")), put_change("door", "last", F.col("event_id"))))
        .when(kind == "error", F.array(delete_change()))
        .otherwise(F.array(put_change(*state, kind))),
        ts=F.col("ts"),
        seq=F.col("event_id"),
    )
    decided = decide(_no_cells(spark), ops, hot=weighed(ops, "row_key"))
    return decided.select(F.col("seq").alias("event_id"), "applied")


def check_and_put_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One check-and-put per customer: those of one segment get a new one."""
    ops = checks(
        table(spark, sf_dir, "customer"),
        row_key=F.col("c_custkey"),
        chk_family=F.lit("general"),
        chk_qualifier=F.lit("segment"),
        expected=F.lit("BUILDING"),
        changes=F.array(put_change("general", "segment", F.col("c_name"))),
        ts=F.timestamp_millis(F.lit(1)),
        seq=F.col("c_custkey"),
    )
    decided = decide_single(customer_cells(spark, sf_dir), ops)
    return decided.select("row_key", "applied")


def check_and_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of nation 7 lose their whole row; others keep it."""
    ops = checks(
        table(spark, sf_dir, "customer"),
        row_key=F.col("c_custkey"),
        chk_family=F.lit("geo"),
        chk_qualifier=F.lit("nation"),
        expected=F.lit("7"),
        changes=F.array(delete_change()),
        ts=F.timestamp_millis(F.lit(1)),
        seq=F.col("c_custkey"),
    )
    return check_and_mutate(customer_cells(spark, sf_dir), ops).cells.select(*CELL_TEXT)


QUERIES = {
    "bulk_put": bulk_put,
    "bulk_increment": bulk_increment,
    "bulk_delete_rows": bulk_delete_rows,
    "bulk_delete_cells": bulk_delete_cells,
    "bulk_delete_families": bulk_delete_families,
    "tombstone_delete": tombstone_delete,
    "mixed_mutations": mixed_mutations,
    "mixed_hot_row": mixed_hot_row,
    "compacted_history": compacted_history,
    "cas_funnel": check_funnel,
    "cas_decisions": check_decisions,
    "cas_hotkey": check_hot_row,
    "cas_entangled_hot": check_entangled_row,
    "check_and_put": check_and_put_single,
    "check_and_delete": check_and_delete,
}

_CUSTOMERS = """
    SELECT CAST(c_custkey AS VARCHAR) AS row_key, 'general' AS family, 'name' AS qualifier,
           c_name AS value FROM customer
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'general', 'segment', c_mktsegment FROM customer
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'geo', 'nation', CAST(c_nationkey AS VARCHAR)
    FROM customer"""

TOMBSTONES = """
    WITH cut AS (
      SELECT user_id, max((ts, event_id)) AS at FROM events
      WHERE event_type = 'error' GROUP BY user_id)
    SELECT CAST(e.user_id AS VARCHAR) AS row_key, e.event_type AS qualifier,
           arg_max(e.value, (e.ts, e.event_id)) AS value
    FROM events e LEFT JOIN cut c ON e.user_id = c.user_id
    WHERE e.event_type <> 'error' AND (c.at IS NULL OR (e.ts, e.event_id) > c.at)
    GROUP BY e.user_id, e.event_type"""


def mix_sql(row_key: str) -> str:
    return f"""
    WITH ops AS (SELECT {row_key} AS row_key, event_type AS kind, ts, event_id FROM events),
    cut AS (
      SELECT row_key, max((ts, event_id)) AS at, arg_max(kind, (ts, event_id)) AS kind FROM ops
      WHERE kind IN ('signup', 'error') GROUP BY row_key),
    added AS (
      SELECT o.row_key, count(*) AS n FROM ops o LEFT JOIN cut c ON o.row_key = c.row_key
      WHERE o.kind NOT IN ('signup', 'error') AND (c.at IS NULL OR (o.ts, o.event_id) > c.at)
      GROUP BY o.row_key)
    SELECT coalesce(c.row_key, a.row_key) AS row_key,
           CAST(CASE WHEN c.kind = 'signup' THEN 100 ELSE 0 END + coalesce(a.n, 0) AS BIGINT) AS score
    FROM cut c FULL JOIN added a ON c.row_key = a.row_key
    WHERE c.kind = 'signup' OR a.n IS NOT NULL"""


def funnel_sql(row_key: str) -> str:
    """Per row: the final state, the last step and the events that applied."""
    return f"""
    SELECT row_key, r.state AS state, r.last AS last, r.ids AS ids FROM (
      SELECT row_key, list_reduce(
        list({{'kind': event_type, 'id': event_id, 'state': NULL::VARCHAR, 'last': NULL::BIGINT,
              'ids': []::BIGINT[]}} ORDER BY ts, event_id),
        lambda a, x: CASE
          WHEN x.kind = 'error' AND a.state = 'purchase' THEN
            {{'kind': x.kind, 'id': x.id, 'state': NULL::VARCHAR, 'last': a.last,
             'ids': list_append(a.ids, x.id)}}
          WHEN x.kind <> 'error' AND a.state IS NOT DISTINCT FROM
               CASE x.kind WHEN 'view' THEN 'signup' WHEN 'click' THEN 'view'
                           WHEN 'purchase' THEN 'click' END THEN
            {{'kind': x.kind, 'id': x.id, 'state': x.kind, 'last': x.id,
             'ids': list_append(a.ids, x.id)}}
          ELSE a END,
        {{'kind': '', 'id': -1::BIGINT, 'state': NULL::VARCHAR, 'last': NULL::BIGINT,
         'ids': []::BIGINT[]}}) AS r
      FROM (SELECT {row_key} AS row_key, event_type, event_id, ts FROM events)
      GROUP BY row_key)"""


FUNNEL_CELLS = f"""
    WITH rows AS ({funnel_sql("CAST(user_id AS VARCHAR)")})
    SELECT row_key, 'funnel' AS family, 'state' AS qualifier, state AS value
    FROM rows WHERE state IS NOT NULL
    UNION ALL SELECT row_key, 'funnel', 'last', CAST(last AS VARCHAR)
    FROM rows WHERE last IS NOT NULL"""


def _decisions(row_key: str) -> str:
    return f"""
    WITH hits AS (SELECT unnest(ids) AS event_id FROM ({funnel_sql(row_key)}))
    SELECT e.event_id, h.event_id IS NOT NULL AS applied
    FROM events e LEFT JOIN hits h ON e.event_id = h.event_id"""


_ORDERED = "SELECT CAST(o_custkey AS VARCHAR) FROM orders"

ORACLES = {
    "bulk_put": f"""
    WITH placed AS (
      SELECT CAST(o_custkey AS VARCHAR) AS row_key, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority,
             CAST(arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS VARCHAR) AS last
      FROM orders GROUP BY o_custkey)
    SELECT * FROM ({_CUSTOMERS})
    WHERE NOT (qualifier = 'segment' AND row_key IN (SELECT row_key FROM placed))
    UNION ALL SELECT row_key, 'general', 'segment', priority FROM placed
    UNION ALL SELECT row_key, 'orders', 'last', last FROM placed""",
    "bulk_increment": """
    WITH added AS (
      SELECT user_id, event_type, sum(CAST(floor(value) AS BIGINT)) AS d FROM events
      GROUP BY user_id, event_type),
    start AS (SELECT user_id, 'view' AS event_type, max(event_id) AS v FROM events GROUP BY user_id)
    SELECT CAST(coalesce(a.user_id, s.user_id) AS VARCHAR) AS row_key,
           coalesce(a.event_type, s.event_type) AS qualifier,
           CAST(coalesce(a.d, 0) + coalesce(s.v, 0) AS BIGINT) AS value
    FROM added a FULL JOIN start s ON a.user_id = s.user_id AND a.event_type = s.event_type""",
    "bulk_delete_rows": f"""
    SELECT * FROM ({_CUSTOMERS})
    WHERE row_key NOT IN ({_ORDERED} WHERE o_orderpriority = '1-URGENT')""",
    "bulk_delete_cells": f"""
    SELECT * FROM ({_CUSTOMERS})
    WHERE NOT (family = 'general' AND qualifier = 'segment' AND row_key IN ({_ORDERED}))""",
    "bulk_delete_families": f"""
    SELECT * FROM ({_CUSTOMERS})
    WHERE NOT (family = 'geo' AND row_key IN ({_ORDERED} WHERE o_orderstatus = 'F'))
      AND NOT (family = 'general' AND row_key IN ({_ORDERED} WHERE o_orderstatus <> 'F'))""",
    "tombstone_delete": TOMBSTONES,
    "mixed_mutations": mix_sql("CAST(user_id AS VARCHAR)"),
    "mixed_hot_row": mix_sql(
        "CASE WHEN event_type IN ('view', 'click') THEN 'busy' ELSE CAST(user_id AS VARCHAR) END"
    ),
    "compacted_history": TOMBSTONES,
    "cas_funnel": FUNNEL_CELLS,
    "cas_decisions": _decisions("CAST(user_id AS VARCHAR)"),
    "cas_hotkey": _decisions("'all'"),
    "cas_entangled_hot": """
    WITH folded AS (
      SELECT list_reduce(
        list({'kind': event_type, 'id': event_id, 'state': NULL::VARCHAR, 'gate': NULL::VARCHAR, 'ids': []::BIGINT[]} ORDER BY ts, event_id),
        lambda a, x: CASE
          WHEN x.kind = 'signup' AND a.state IS NULL THEN
            {'kind': x.kind, 'id': x.id, 'state': 'signup', 'gate': 'open', 'ids': list_append(a.ids, x.id)}
          WHEN x.kind = 'view' AND a.gate = 'open' OR x.kind = 'purchase' AND a.gate = 'shut' THEN
            {'kind': x.kind, 'id': x.id, 'state': x.kind, 'gate': a.gate, 'ids': list_append(a.ids, x.id)}
          WHEN x.kind = 'click' AND a.state = 'view' THEN
            {'kind': x.kind, 'id': x.id, 'state': a.state, 'gate': 'shut', 'ids': list_append(a.ids, x.id)}
          WHEN x.kind = 'error' AND a.state = 'purchase' THEN
            {'kind': x.kind, 'id': x.id, 'state': NULL::VARCHAR, 'gate': NULL::VARCHAR, 'ids': list_append(a.ids, x.id)}
          ELSE a END,
        {'kind': '', 'id': -1::BIGINT, 'state': NULL::VARCHAR, 'gate': NULL::VARCHAR, 'ids': []::BIGINT[]}) AS r
      FROM events),
    hits AS (SELECT unnest(r.ids) AS event_id FROM folded)
    SELECT e.event_id, h.event_id IS NOT NULL AS applied FROM events e LEFT JOIN hits h ON e.event_id = h.event_id""",
    "check_and_put": """
    SELECT CAST(c_custkey AS VARCHAR) AS row_key, c_mktsegment = 'BUILDING' AS applied
    FROM customer""",
    "check_and_delete": f"""
    SELECT * FROM ({_CUSTOMERS})
    WHERE row_key NOT IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_nationkey = 7)""",
}
