"""User functions that share one resource per partition.

A resource is a context manager factory, such as a function that opens a
connection. It is opened in the task, and closed when the task has consumed or
dropped all output, also after an error. The functions work on streams too.

An action may run more than once: a task is lost, or a batch of a stream runs again.
With ``commit`` it has two steps. In the tasks it only prepares, and returns a
receipt; ``commit`` gets the receipts of the tasks that counted, one each,
once all have ended, and makes their work visible.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import AbstractContextManager, contextmanager
from dataclasses import dataclass
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)

import cellweave

Resource = Callable[[], AbstractContextManager[Any]]
# Gets the receipts and the number of the stream's batch, None outside of a stream.
Commit = Callable[[list, int | None], None]


def map_partitions(
    df: DataFrame,
    resource: Resource,
    fn: Callable[[Iterator[pd.DataFrame], Any], Iterable[pd.DataFrame]],
    schema: str,
) -> DataFrame:
    """Map the Arrow batches of each partition with an open resource."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with resource() as opened:
            yield from fn(batches, opened)

    return df.mapInPandas(run, schema)


def foreach_partition(
    df: DataFrame,
    resource: Resource,
    fn: Callable[[Iterator[pa.RecordBatch], Any], Any],
    commit: Commit | None = None,
    abort: Commit | None = None,
) -> None:
    """Run an action on the Arrow batches of each partition with an open resource.

    Without ``commit``, ``fn`` must be idempotent per partition, as a lost task
    runs again. With it, what ``fn`` returns are the receipts; ``abort`` gets those
    there are when the job fails.
    """
    if commit is None:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            with resource() as opened:
                fn(batches, opened)
            yield from ()

        df.mapInArrow(run, "done BOOLEAN").write.format("noop").mode("overwrite").save()
    else:
        df.write.format(register_action(df.sparkSession, resource, fn, commit, abort)).mode("append").save()


def foreach(
    df: DataFrame,
    resource: Resource,
    fn: Callable[[dict, Any], None],
    receipt: Callable[[Any], Any] | None = None,
    commit: Commit | None = None,
    abort: Commit | None = None,
) -> None:
    """Run an action on each record, as a dict, with its partition's resource.

    ``receipt`` makes the receipt for ``commit`` from the resource, after the last record.
    """

    def each(batches: Iterator[pa.RecordBatch], opened: Any) -> Any:
        for batch in batches:
            for record in batch.to_pylist():
                fn(record, opened)
        return receipt(opened) if receipt else None

    foreach_partition(df, resource, each, commit, abort)


@dataclass
class _Receipt(WriterCommitMessage):
    value: Any


def register_action(
    spark: SparkSession, resource: Resource, fn: Callable, commit: Commit, abort: Commit | None = None
) -> str:
    """The name of a sink, for batches and streams, that runs an action in two steps."""
    name = f"action_{uuid.uuid4().hex}"

    class Write:
        def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
            with resource() as opened:
                receipt = fn(iterator, opened)
            return _Receipt(receipt)

        def commit(self, messages: list, batchId: int | None = None) -> None:
            commit([m.value for m in messages if m is not None], batchId)

        def abort(self, messages: list, batchId: int | None = None) -> None:
            if abort is not None:
                abort([m.value for m in messages if m is not None], batchId)

    class BatchWriter(Write, DataSourceArrowWriter):
        pass

    class StreamWriter(Write, DataSourceStreamArrowWriter):
        pass

    class Action(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite):
            return BatchWriter()

        def streamWriter(self, schema, overwrite):
            return StreamWriter()

    with _by_value(resource, fn, commit, abort):
        spark.dataSource.register(Action)
        # The name is looked up in the session that is active, which need not be this one.
        active = SparkSession.getActiveSession()
        if active is not None:
            active.dataSource.register(Action)
    return name


@contextmanager
def _by_value(*given: Any) -> Iterator[None]:
    """What is pickled here takes this package and the modules of ``given`` along: the worker that commits knows neither."""
    names = {getattr(x, "__module__", None) or type(x).__module__ for x in given if x is not None}
    modules = [cellweave, *(sys.modules[n] for n in names if n in sys.modules and n.partition(".")[0] != "cellweave")]
    for module in modules:
        cloudpickle.register_pickle_by_value(module)
    try:
        yield
    finally:
        for module in modules:
            cloudpickle.unregister_pickle_by_value(module)
