"""A table kept as Parquet mutations, one folder per writer and micro-batch.

Reading resolves the mutations. A batch that runs again overwrites its own
folder, so nothing counts twice. ``compact`` shortens the history.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.operators.conditional import applied_mutations
from cellweave.operators.mutations import EVENT_ORDER, compact, resolve, weigh
from cellweave.plans.skew import keep_keys
from cellweave.schema import CHECK, CHECK_COLUMNS, MUTATION, MUTATION_COLUMNS, record, require_families

_AT = record(writer=T.StringType(), batch_id=T.LongType())
_LOGGED = T.StructType([*MUTATION, *_AT])
_DECIDED = T.StructType([*CHECK, *record(applied=T.BooleanType()), *_AT])
_DONE = record(upto=T.MapType(T.StringType(), T.LongType()), folder=T.StringType())
MAIN = "main"


def _require_changed_families(allowed: Sequence[str]) -> Column:
    """The changes of an operation; one that names an unknown family fails the job."""
    odd = F.filter(
        F.filter("changes", lambda c: c["family"].isNotNull()), lambda c: ~c["family"].isin(list(allowed))
    )
    message = F.concat(F.lit("unknown column family: "), F.get(odd, 0)["family"])
    return F.when(F.size(odd) > 0, F.raise_error(message).cast(CHECK["changes"].dataType)).otherwise(
        F.col("changes")
    )


class MutationTable:
    """A table that batch jobs and streams write, each under a name of its own.

    ``order`` is the total order that mutations take effect in.
    ``EVENT_ORDER`` goes by the mutations' own times, so late files do no harm.
    ``ARRIVAL_ORDER`` goes by batch first, which conditional operations need.
    Of mutations that are equal in it, the one of the later writer by name wins. A NULL
    time comes before all others.

    All that the table holds is found by paths relative to it, so its folder may be moved.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        order: Sequence[str] = EVENT_ORDER,
        families: Sequence[str] | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.order = (*order, "writer")
        self.families = families

    def write(self, ops: DataFrame, batch_id: int, writer: str = MAIN) -> None:
        """Store one batch of a writer; the same batch again takes its place, other writers' batches stay."""
        if self.families is not None:
            ops = require_families(ops, self.families)
        self._store(ops.select(*MUTATION_COLUMNS), "log", batch_id, writer)

    def write_decisions(self, decided: DataFrame, batch_id: int, writer: str = MAIN) -> None:
        """Store one batch of conditional operations, of which those that applied are mutations."""
        if self.families is not None:
            decided = decided.withColumn("changes", _require_changed_families(self.families))
        self._store(decided.select(*CHECK_COLUMNS, "applied"), "decisions", batch_id, writer)

    def _store(self, rows: DataFrame, folder: str, batch_id: int, writer: str) -> None:
        """One job, committed as a whole: only the folder of this writer and batch is replaced."""
        at = {"writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("long")}
        keyed = rows.withColumns(at).write.partitionBy("writer", "batch_id").mode("overwrite")
        keyed.option("partitionOverwriteMode", "dynamic").parquet(f"{self.path}/{folder}")

    def decisions(self) -> DataFrame:
        """The conditional operations of all batches with ``applied``, ``writer`` and ``batch_id``."""
        return self._read("decisions", _DECIDED)

    def history(self, before: int | None = None) -> DataFrame:
        """Mutations of all batches, or of each writer's before a batch.

        Batches that a compaction covers are read from it.
        """
        log = self._read("log", _LOGGED).unionByName(
            applied_mutations(self.decisions(), *_AT.fieldNames())
        )
        done = self._compacted(before)
        if done is not None:
            log = log.filter(~_covered(done["upto"]))
        if before is not None:
            log = log.filter(F.col("batch_id") < before)
        if done is None:
            return log
        # A compaction that is named but gone is an error, not an empty table.
        compacted = self.spark.read.schema(_LOGGED).parquet(f"{self.path}/{done['folder']}")
        return compacted.unionByName(log)

    def cells(self, before: int | None = None, rows_of: DataFrame | None = None) -> DataFrame:
        """The live cells; with ``rows_of``, only those of the row keys it holds."""
        ops = self.history(before)
        kinds, hot = weigh(ops)
        if rows_of is not None:
            ops = keep_keys(ops, rows_of, "row_key")
        return resolve(ops, self.order, hot, kinds)

    def compact(self, upto: int | Mapping[str, int], horizon: Column | None = None) -> None:
        """Fold batches to at most one mutation per cell: every writer's up to a number, or some writers' up to theirs.

        In event order, only mutations before ``horizon`` are folded, a time
        that no later mutation may precede; deletes stay, so that a put which
        breaks that rule is still shadowed. In arrival order nothing may come
        before a folded batch, and no horizon is needed. Each compaction has a
        folder of its own; the entry that makes readers use it is written last.
        """
        by_event = self.order[0] != "batch_id"
        if by_event and horizon is None:
            raise ValueError("a table in event order needs a horizon")
        ops = self.history()
        if not isinstance(upto, Mapping):
            names = ops.select("writer").distinct().collect()
            upto = {r["writer"]: upto for r in names}
        before = self._compacted(None)
        if before is not None:
            # What an earlier compaction covers is part of this one.
            upto = {w: max(upto.get(w, n), n) for w, n in before["upto"].items()} | {
                w: n for w, n in upto.items() if w not in before["upto"]
            }
        ops = ops.filter(_covered(upto))
        if by_event:
            settled = F.col("ts").isNull() | (F.col("ts") < horizon)
            folded = compact(ops.filter(settled), self.order)
            at = F.lit(min(upto.values(), default=0)).cast("long")
            short = folded.withColumn("batch_id", at).unionByName(ops.filter(~settled), allowMissingColumns=True)
        else:
            short = compact(ops, self.order)
        folder = f"compacted/{uuid.uuid4().hex}"
        short.select(*_LOGGED.fieldNames()).write.parquet(f"{self.path}/{folder}")
        entry = self.spark.createDataFrame([(upto, folder)], _DONE)
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/compactions")

    def _compacted(self, before: int | None):
        """The compaction that covers most, of those that cover only batches before one."""
        done = self._read("compactions", _DONE)
        numbers = F.map_values("upto")
        if before is not None:
            done = done.filter(F.forall(numbers, lambda n: n < before))
        covers = F.aggregate(numbers, F.lit(0).cast("long"), lambda total, n: total + n + 1)
        return done.orderBy(covers.desc(), "folder").first()

    def _read(self, folder: str, schema: T.StructType) -> DataFrame:
        """A folder of the table; nothing has been written to it where it is missing."""
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)


def _covered(upto: Mapping[str, int]) -> Column:
    """True for the batches of a compaction; made of folder names only, so that others are not opened."""
    held = F.lit(False)
    for writer, number in upto.items():
        held = held | ((F.col("writer") == writer) & (F.col("batch_id") <= number))
    return held
