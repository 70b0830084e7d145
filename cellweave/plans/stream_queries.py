"""Queries that run streams and partition functions to their end."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.operators.lookup import bulk_get
from cellweave.operators.mutations import ARRIVAL_ORDER
from cellweave.operators.cells import project
from cellweave.operators.partitions import foreach, foreach_partition, map_partitions
from cellweave.plans.cell_queries import CUSTOMER_COLUMNS
from cellweave.plans.cell_queries import ORACLES as CELL_ORACLES
from cellweave.plans.inputs import (
    arriving_events,
    customer_cells,
    event_checks,
    event_deltas,
    event_mix,
    event_puts,
    event_tombstones,
    message_lines,
    scratch,
    table,
)
from cellweave.plans.mutation_queries import FUNNEL_CELLS, TOMBSTONES, mix_sql
from cellweave.plans.mutation_queries import ORACLES as MUTATION_ORACLES
from cellweave.plans.skew import spread
from cellweave.plans.text_queries import ORACLES as TEXT_ORACLES
from cellweave.plans.text_queries import TRACKED
from cellweave.schema import DELETE_ROW, INCREMENT, PUT
from cellweave.session import qualified
from cellweave.sources.events import message_puts, parse_messages, read_stream, sample, tracked
from cellweave.sources.outbox import Outbox, Staged
from cellweave.sources.tables import BucketedTable
from cellweave.streaming.sinks import (
    run_with_restarts,
    stream_checks,
    stream_foreach_partition,
    stream_get,
    stream_mutations,
)
from cellweave.streaming.table import MutationTable

CELL_TEXT = ["row_key", "family", "qualifier", "value"]


def _stream_of(spark, sf_dir, to_ops, compact_after=None) -> MutationTable:
    """Run the events as a stream of mutations into a new table."""
    folder = scratch(spark, "stream")
    stored = MutationTable(spark, f"{folder}/table")

    def start(stream: DataFrame):
        return stream_mutations(stream, stored, f"{folder}/checkpoint", to_ops)

    arriving_events(spark, sf_dir, folder, start)
    if compact_after is not None:
        stored.compact(compact_after, F.lit("2024-01-10").cast("timestamp"))
    return stored


def stream_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = _stream_of(spark, sf_dir, event_puts).cells()
    return live.select("row_key", "qualifier", F.col("value").cast("double").alias("value"))


def stream_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = _stream_of(spark, sf_dir, event_deltas).cells()
    return live.select("row_key", "qualifier", F.col("value").cast("long").alias("value"))


def stream_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    live = _stream_of(spark, sf_dir, event_tombstones).cells()
    return live.select("row_key", "qualifier", F.col("value").cast("double").alias("value"))


def stream_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Puts, deletes and increments; the first two batches are compacted."""
    live = _stream_of(spark, sf_dir, event_mix, compact_after=1).cells()
    return live.select("row_key", F.col("value").cast("long").alias("score"))


def stream_two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table that a batch job and two streams at a time write: resets, deletes, and additions."""
    folder = scratch(spark, "stream")
    stored = MutationTable(spark, f"{folder}/table")
    ops = event_mix(table(spark, sf_dir, "events"))
    stored.write(ops.filter(F.col("op") == PUT), 0, writer="load")

    def only(op: str):
        return lambda batch: event_mix(batch).filter(F.col("op") == op)

    def start(stream: DataFrame):
        queries = [
            stream_mutations(stream, stored, f"{folder}/checkpoint-{op}", only(op), writer=op)
            for op in (DELETE_ROW, INCREMENT)
        ]
        queries[0].awaitTermination()
        return queries[1]

    arriving_events(spark, sf_dir, folder, start)
    # Batches 0 and 1 of both streams and of the load are folded; the rest is read as it came.
    stored.compact({"load": 0, DELETE_ROW: 1, INCREMENT: 1}, F.lit("2024-01-10").cast("timestamp"))
    return stored.cells().select("row_key", F.col("value").cast("long").alias("score"))


def _checked(spark: SparkSession, sf_dir: str) -> MutationTable:
    """Run the events as a stream of conditional operations into a new table."""
    folder = scratch(spark, "stream")
    stored = MutationTable(spark, f"{folder}/table", ARRIVAL_ORDER)

    def start(stream: DataFrame):
        return stream_checks(stream, stored, f"{folder}/checkpoint", event_checks)

    arriving_events(spark, sf_dir, folder, start)
    return stored


def stream_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).cells().select(*CELL_TEXT)


def stream_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which operations of the stream applied."""
    decided = _checked(spark, sf_dir).decisions()
    return decided.select(F.col("seq").alias("event_id"), "applied")


def stream_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events look up ten times their user's key in a table by buckets; most find nothing."""
    folder = scratch(spark, "stream")
    customers = BucketedTable.write(customer_cells(spark, sf_dir), f"{folder}/customers", 16)

    def rows(requests: DataFrame) -> DataFrame:
        asked = requests.select("row_key").distinct()
        return project(customers.cells(requests).join(asked, "row_key", "left_semi"), CUSTOMER_COLUMNS)

    def start(stream: DataFrame):
        requests = stream.select("event_id", (F.col("user_id") * 10).cast("string").alias("row_key"))
        return stream_get(requests, rows, f"{folder}/answers", f"{folder}/checkpoint")

    arriving_events(spark, sf_dir, folder, start)
    return spark.read.parquet(f"{folder}/answers").select("event_id", "row_key", *CUSTOMER_COLUMNS)


def stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup as a streaming DataFrame."""
    folder = scratch(spark, "stream")
    customers = project(customer_cells(spark, sf_dir), CUSTOMER_COLUMNS)

    def start(stream: DataFrame):
        requests = stream.select("event_id", (F.col("user_id") * 10).cast("string").alias("row_key"))
        return _to_parquet(bulk_get(requests, customers), folder)

    arriving_events(spark, sf_dir, folder, start)
    return spark.read.parquet(f"{folder}/out").select("event_id", "row_key", *CUSTOMER_COLUMNS)


def _to_parquet(stream: DataFrame, folder: str):
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )


def _message_stream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    spread(message_lines(spark, sf_dir)).write.text(f"{folder}/source")
    return read_stream(spark, f"{folder}/source")


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON message files, parsed and stored as rows; transient failures restart."""
    folder = scratch(spark, "ingest")
    stored = MutationTable(spark, f"{folder}/table", families=["general", "hashtags"])
    puts = message_puts(parse_messages(_message_stream(spark, sf_dir, folder)))
    run_with_restarts(
        lambda: stream_mutations(puts, stored, f"{folder}/checkpoint"),
        is_transient=lambda error: "timed out" in str(error),
        max_restarts=3,
    )
    return stored.cells().select(*CELL_TEXT, F.unix_millis("ts").alias("ts_ms"))


def stream_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "stream")
    keep = tracked(TRACKED, text="m.text", lang="m.lang")
    messages = parse_messages(_message_stream(spark, sf_dir, folder), keep=keep)
    _to_parquet(messages.select("row_key", "lang", "country"), folder).awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def stream_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(spark, "stream")
    messages = parse_messages(_message_stream(spark, sf_dir, folder))
    _to_parquet(sample(messages, 0.25, "row_key").select("row_key", "lang"), folder).awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@contextmanager
def _json_decoder() -> Iterator[json.JSONDecoder]:
    yield json.JSONDecoder()


def _sum_props(batches: Iterator[pd.DataFrame], decoder: json.JSONDecoder) -> Iterator[pd.DataFrame]:
    """Per Arrow batch, the sum of ``k`` of each user: small output, whatever the skew."""
    for batch in batches:
        k = [decoder.decode(props)["k"] for props in batch["props"]]
        sums = batch[["user_id"]].assign(k=k).groupby("user_id", as_index=False)["k"].sum()
        yield sums


def partition_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partition function with a decoder; its partial sums meet in an aggregation."""
    events = spread(table(spark, sf_dir, "events").select("user_id", "props"))
    partial = map_partitions(events, _json_decoder, _sum_props, "user_id BIGINT, k BIGINT")
    return partial.groupBy("user_id").agg(F.sum("k").alias("k"))


def stream_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same partition function on a stream."""
    folder = scratch(spark, "stream")

    def start(stream: DataFrame):
        events = stream.select("user_id", "props")
        partial = map_partitions(events, _json_decoder, _sum_props, "user_id BIGINT, k BIGINT")
        return _to_parquet(partial, folder)

    arriving_events(spark, sf_dir, folder, start)
    return spark.read.parquet(f"{folder}/out").groupBy("user_id").agg(F.sum("k").alias("k"))


def _write_part(batches: Iterator[pa.RecordBatch], staged: Staged) -> list[str]:
    """The rows of a partition as one file."""
    writer = None
    for batch in batches:
        if writer is None:
            writer = pq.ParquetWriter(staged.new(), batch.schema, filesystem=staged.system)
        writer.write_batch(batch)
    if writer is not None:
        writer.close()
    return staged.receipt()


def partition_foreach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each partition writes its events through a file system handle."""
    outbox = Outbox(qualified(spark, scratch(spark, "parts")))
    events = spread(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"))
    foreach_partition(events, outbox, _write_part, outbox.commit, outbox.abort)
    return spark.read.parquet(outbox.sent).drop("batch_id")


def stream_foreach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitions of every micro-batch write their events."""
    folder = scratch(spark, "stream")
    outbox = Outbox(qualified(spark, f"{folder}/parts"))

    def start(stream: DataFrame):
        events = stream.select("event_id", "user_id", "event_type")
        return stream_foreach_partition(
            events, outbox, _write_part, f"{folder}/checkpoint", outbox.commit, outbox.abort
        )

    arriving_events(spark, sf_dir, folder, start)
    return spark.read.parquet(outbox.sent).drop("batch_id")


class _Lines(Outbox):
    """Opens as a file for lines of text."""

    @contextmanager
    def __call__(self) -> Iterator[tuple[Staged, Any]]:
        with super().__call__() as staged, staged.system.open_output_stream(staged.new()) as stream:
            yield staged, stream


def _write_line(record: dict, opened: tuple[Staged, Any]) -> None:
    opened[1].write(json.dumps(record).encode() + b"\n")


def _finished(opened: tuple[Staged, Any]) -> list[str]:
    return opened[0].receipt()


def record_foreach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record is written as a JSON line through its partition's file."""
    outbox = _Lines(qualified(spark, scratch(spark, "lines")), ".jsonl")
    events = spread(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"))
    foreach(events, outbox, _write_line, _finished, outbox.commit, outbox.abort)
    schema = "event_id BIGINT, user_id BIGINT, event_type STRING"
    return spark.read.schema(schema).json(outbox.sent).drop("batch_id")


QUERIES = {
    "stream_put": stream_put,
    "stream_increment": stream_increment,
    "stream_delete": stream_delete,
    "stream_mixed": stream_mixed,
    "stream_two_writers": stream_two_writers,
    "stream_check": stream_check,
    "stream_decisions": stream_decisions,
    "stream_get": stream_lookup,
    "stream_join": stream_join,
    "stream_ingest": stream_ingest,
    "stream_track": stream_track,
    "stream_sample": stream_sample,
    "stream_map": stream_map,
    "stream_foreach": stream_foreach,
    "partition_map": partition_map,
    "partition_foreach": partition_foreach,
    "record_foreach": record_foreach,
}

_LOOKUP = """
    SELECT event_id, CAST(user_id * 10 AS VARCHAR) AS row_key, c_name AS name,
           c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation
    FROM events LEFT JOIN customer ON user_id * 10 = c_custkey"""
_PROPS = """
    SELECT user_id, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k
    FROM events GROUP BY user_id"""
_EVENTS = "SELECT event_id, user_id, event_type FROM events"

ORACLES = {
    "stream_put": CELL_ORACLES["latest_cells"],
    "stream_increment": """
    SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS qualifier,
           CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS value
    FROM events GROUP BY user_id, event_type""",
    "stream_delete": TOMBSTONES,
    "stream_mixed": mix_sql("CAST(user_id AS VARCHAR)"),
    "stream_two_writers": mix_sql("CAST(user_id AS VARCHAR)"),
    "stream_check": FUNNEL_CELLS,
    "stream_decisions": MUTATION_ORACLES["cas_decisions"],
    "stream_get": _LOOKUP,
    "stream_join": _LOOKUP,
    "stream_ingest": TEXT_ORACLES["ingest_messages"],
    "stream_track": TEXT_ORACLES["ingest_tracked"],
    "stream_sample": f"""
    SELECT CAST(doc_id AS VARCHAR) AS row_key, lang FROM documents
    WHERE doc_id IN ({TEXT_ORACLES["stable_sample"]}) AND lang <> 'de'""",
    "stream_map": _PROPS,
    "stream_foreach": _EVENTS,
    "partition_map": _PROPS,
    "partition_foreach": _EVENTS,
    "record_foreach": _EVENTS,
}
