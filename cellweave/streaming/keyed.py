"""Conditional operations on a stream, decided by keyed state.

Each row key has a state of its own: the cells its operations may meet. A batch
reads and changes the states of the rows it touches, so it costs as much as it
holds, however long the history and however large the table. The state starts
from the cells that the table holds when the query first runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cellweave.operators.cells import to_rows
from cellweave.schema import CELL, CHECK, CHECK_COLUMNS, DELETE_CELL, DELETE_ROW, PUT, record

DECIDED = T.StructType([*CHECK, *record(applied=T.BooleanType())])
_NAME = record(family=T.StringType(), qualifier=T.StringType())
_VALUE = record(value=T.StringType())
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _row_state() -> StatefulProcessor:
    """A processor that goes to workers by value: the one that reads its schemas does not know this package."""

    class RowState(StatefulProcessor):
        """The cells of one row, and the decisions on its operations.

        A batch's operations on one row are put in order in memory; a source with a
        limit per trigger bounds them. Cells are read when an operation first asks
        for them, and written once a batch.
        """

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.cells = handle.getMapState("cells", _NAME, _VALUE)

        def handleInitialState(self, key, initialState, timerValues) -> None:
            for cell in initialState.cells:  # structs arrive as dicts
                self.cells.updateValue((cell["family"], cell["qualifier"]), (cell["value"],))

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            seen: dict[tuple, str | None] = {}
            dirty: set[tuple] = set()
            decided = []
            for op in sorted(rows, key=lambda r: (r.ts, r.seq)):
                checked = (op.chk_family, op.chk_qualifier)
                applied = self._value(seen, checked) == op.expected
                if applied:
                    for change in op.changes:
                        kind, family = change["op"], change["family"]
                        if kind in (PUT, DELETE_CELL):
                            names = [(family, change["qualifier"])]
                        else:
                            names = [n for n in self._present(seen) if kind == DELETE_ROW or n[0] == family]
                        for name in names:
                            seen[name] = change["value"] if kind == PUT else None
                            dirty.add(name)
                decided.append(Row(**op.asDict(), applied=applied))
            for name in dirty:
                if seen[name] is not None:
                    self.cells.updateValue(name, (seen[name],))
                elif self.cells.containsKey(name):
                    self.cells.removeKey(name)
            return iter(decided)

        def _value(self, seen: dict, name: tuple) -> str | None:
            if name not in seen:
                seen[name] = self.cells.getValue(name)[0] if self.cells.containsKey(name) else None
            return seen[name]

        def _present(self, seen: dict) -> set[tuple]:
            stored = {(k[0], k[1]) for k in self.cells.keys()}
            return {n for n in stored | set(seen) if self._value(seen, n) is not None}

    return RowState()


def decide_stream(checks: DataFrame, cells: DataFrame) -> DataFrame:
    """Each operation of a stream with ``applied``.

    An operation sees what the batches before have left, and in its batch the
    operations before it on its row in ``(ts, seq)`` order. ``cells`` is where the
    first batch starts from.
    """
    start = to_rows(cells).groupBy("row_key")
    return (
        checks.select(*CHECK_COLUMNS)
        .groupBy("row_key")
        .transformWithState(_row_state(), DECIDED, "Append", "None", start)
    )


def first_cells(spark: SparkSession, checkpoint: str, cells: Callable[[], DataFrame]) -> DataFrame:
    """``cells`` while no batch has been committed, and none after: later batches start from the state."""
    try:
        begun = not spark.read.text(f"{checkpoint}/commits").isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        begun = False
    return spark.createDataFrame([], CELL) if begun else cells()


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start here keep their state where keyed state can be kept."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
