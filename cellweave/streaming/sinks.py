"""Micro-batch forms of the table operators.

Each function starts a query that hands every micro-batch to the batch
operator. ``to_ops`` maps the records of a batch to mutations (or conditional
operations), as column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from cellweave.operators.lookup import bulk_get
from cellweave.operators.partitions import Commit, Resource, register_action
from cellweave.schema import checks, mutations
from cellweave.streaming.keyed import decide_stream, first_cells, keyed_state
from cellweave.streaming.table import MAIN, MutationTable

ToOps = Callable[[DataFrame], DataFrame]


def each_batch(
    stream: DataFrame,
    action: Callable[[DataFrame, int], None],
    checkpoint: str,
    **trigger: Any,
) -> StreamingQuery:
    """Run ``action`` on every micro-batch; by default on all that is there, then stop."""
    writer = stream.writeStream.foreachBatch(action).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stream_mutations(
    stream: DataFrame,
    table: MutationTable,
    checkpoint: str,
    to_ops: ToOps = mutations,
    writer: str = MAIN,
    **trigger: Any,
) -> StreamingQuery:
    """Put, increment, delete or any mix: append each batch to the table's history.

    A batch costs one pass without a shuffle. Reading the table puts the
    mutations in order. Streams that share a table need a ``writer`` name each.
    """

    def action(batch: DataFrame, batch_id: int) -> None:
        table.write(to_ops(batch), batch_id, writer)

    return each_batch(stream, action, checkpoint, **trigger)


def stream_checks(
    stream: DataFrame,
    table: MutationTable,
    checkpoint: str,
    to_checks: ToOps = checks,
    **trigger: Any,
) -> StreamingQuery:
    """Check-and-put and check-and-delete against the table as earlier batches left it.

    The table must use ``ARRIVAL_ORDER``, and no one else may write to it: once
    the stream has begun, its state is what operations are checked against. Each
    batch leaves its decisions, and the mutations that applied. A batch that
    runs again starts from the state before it, and decides the same.
    """
    spark = stream.sparkSession
    cells = first_cells(spark, checkpoint, lambda: table.cells())
    decided = decide_stream(to_checks(stream), cells)

    with keyed_state(spark):
        return each_batch(decided, table.write_decisions, checkpoint, **trigger)


def stream_get(
    stream: DataFrame,
    table: DataFrame | Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    on: str = "row_key",
    **trigger: Any,
) -> StreamingQuery:
    """Look up each batch and store the answers in a folder of its own.

    ``table`` may be a function that gives the rows a batch of requests needs, such as
    those in its buckets of a ``BucketedTable``, so that a batch does not read all.
    """

    def action(batch: DataFrame, batch_id: int) -> None:
        requests = batch.persist()
        try:
            rows = table(requests) if callable(table) else table
            answers = bulk_get(requests, rows, on)
            answers.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            requests.unpersist()

    return each_batch(stream, action, checkpoint, **trigger)


def stream_foreach_partition(
    stream: DataFrame,
    resource: Resource,
    fn: Callable[[Iterator[pa.RecordBatch], Any], Any],
    checkpoint: str,
    commit: Commit,
    abort: Commit | None = None,
    **trigger: Any,
) -> StreamingQuery:
    """Run an action on the partitions of every micro-batch with an open resource.

    ``commit`` gets the receipts that ``fn`` returned and the number of the
    batch. A batch may run again, after a failure or in another session; its
    number is then the same, and ``commit`` has to replace what it did before.
    """
    name = register_action(stream.sparkSession, resource, fn, commit, abort)
    writer = stream.writeStream.format(name).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def run_with_restarts(
    start: Callable[[], StreamingQuery],
    is_transient: Callable[[StreamingQueryException], bool],
    max_restarts: int | None = None,
) -> int:
    """Run a query to its end, and start it again after each transient failure.

    The query goes on from its checkpoint. Returns the number of restarts.
    """
    restarts = 0
    while True:
        try:
            start().awaitTermination()
            return restarts
        except StreamingQueryException as error:
            if not is_transient(error) or restarts == max_restarts:
                raise
            restarts += 1
