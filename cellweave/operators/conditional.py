"""Check-and-put and check-and-delete.

An operation sees the effect of the operations before it on its row, in
``(ts, seq)`` order, so deciding which ones apply is a fold over each row's
operations. The fold streams sorted Arrow batches and keeps only the row's
checked cells. What the applied operations do is then an ordinary mutation.

A row that takes a large part of all operations is cut into slices of the
order. Where its checked cells do not depend on each other, every slice is
folded at once for all values its cell may have on entry, and a short chain
over the slices finds the value each one really starts from. Where they do
depend on each other, a slice is folded for all cases of entry values that its
operations tell apart, and a chain over the slices picks the case of each. Only rows
with more checked cells, or slices with more cases, than a bound take turns slice by slice.

Keys and values are compared as bytes, and need not be text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.operators.mutations import ARRIVAL_ORDER, apply
from cellweave.plans.skew import NO_HOT_KEYS, HotKeys, hot_keys, order_slices, with_slice
from cellweave.schema import (
    CELL,
    CELL_KEY,
    CHECK,
    CHECK_COLUMNS,
    DELETE_CELL,
    DELETE_FAMILY,
    DELETE_ROW,
    MUTATION,
    PUT,
    conform,
    mutations,
    record,
)
from cellweave.session import scratch_path

CHECKED_CELL = ["row_key", "chk_family", "chk_qualifier"]

# What the folds read: operations (rank 1) after the cells they start from
# (rank 0, the present value in ``expected``).
_FOLD = T.StructType([*record(_rank=T.IntegerType(), slice=T.LongType()), *CHECK])
_SLICED = T.StructType([*CHECK, *record(slice=T.LongType())])
_DECIDED = T.StructType([*CHECK, *record(applied=T.BooleanType())])
_ENTRIES = record(
    row_key=T.StringType(),
    chk_family=T.StringType(),
    chk_qualifier=T.StringType(),
    slice=T.LongType(),
    _rank=T.IntegerType(),
    entry=T.StringType(),
    exit=T.StringType(),
)
_OUT_ROWS = 50_000

# Entangled rows with more checked cells, or with more cases in a slice, are decided in turn.
MAX_CELLS = 64
MAX_CASES = 4_096
_NAMED = [("family", T.StringType()), ("qualifier", T.StringType())]
_ASSIGNED = record(**dict(_NAMED), value=T.StringType())
_CONDITION = record(**dict(_NAMED), equal=T.BooleanType(), value=T.StringType())
_CASES = record(
    row_key=T.StringType(),
    slice=T.LongType(),
    number=T.IntegerType(),
    conditions=T.ArrayType(_CONDITION),
    after=T.ArrayType(_ASSIGNED),
)
_OPENING = record(
    row_key=T.StringType(),
    slice=T.LongType(),
    chk_family=T.StringType(),
    chk_qualifier=T.StringType(),
    expected=T.StringType(),
)


# As the folds see them.
_PUT, _DELETE_CELL, _DELETE_ROW = (op.encode() for op in (PUT, DELETE_CELL, DELETE_ROW))


class Checked(NamedTuple):
    """The operations with their ``applied`` flag, and the table after them."""

    decided: DataFrame
    cells: DataFrame


def check_and_mutate(
    cell_rows: DataFrame, checks: DataFrame, hot: HotKeys | None = None
) -> Checked:
    """Run conditional operations against the latest view of a table.

    The operations come after all that the table holds, whatever its times.
    Both results run the fold; write ``decided`` first where both are needed.
    """
    if hot is None:
        # Weighed once, on the inputs: what applies is no heavier than what was asked.
        hot = hot_keys(cell_rows.select("row_key").unionByName(checks.select("row_key")), "row_key")
    decided = decide(cell_rows, checks, hot)
    ops = applied_mutations(decided).withColumn("batch_id", F.lit(0).cast("long"))
    return Checked(decided, apply(cell_rows, ops, ARRIVAL_ORDER, hot))


def applied_mutations(decided: DataFrame, *more: str) -> DataFrame:
    """The mutations of the operations whose check held, with ``more`` columns of theirs."""
    changes = decided.filter("applied").select("row_key", "ts", "seq", *more, F.inline("changes"))
    if not more:
        return mutations(changes)
    kept = T.StructType([*MUTATION, *[changes.schema[name] for name in more]])
    return conform(changes, kept)


def decide_single(cell_rows: DataFrame, checks: DataFrame) -> DataFrame:
    """``decide`` for at most one operation per row: a plain join, no fold."""
    present = _present(cell_rows)
    joined = checks.join(present, CHECKED_CELL, "left")
    return joined.withColumn("applied", F.col("_value").eqNullSafe(F.col("expected"))).select(
        *CHECK_COLUMNS, "applied"
    )


def decide(cell_rows: DataFrame, checks: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Each operation with ``applied``: whether its check held when its turn came."""
    checks = checks.select(*CHECK_COLUMNS)
    if hot is None:
        hot = hot_keys(checks, "row_key")
    start = _start_cells(cell_rows, checks)
    if not hot:
        return _fold(start, checks, ["row_key"])

    def of(keys: HotKeys) -> tuple[DataFrame, DataFrame, HotKeys]:
        hit = keys.hit(F.col("row_key"))
        return start.filter(hit), checks.filter(hit), keys

    entangled = hot.only(_entangled_rows(checks.filter(hot.hit(F.col("row_key")))))
    apart = hot.without(entangled.keys)
    light = ~hot.hit(F.col("row_key"))
    decided = _fold(start.filter(light), checks.filter(light), ["row_key"])
    if apart:
        decided = decided.unionByName(_decide_by_slice(*of(apart)))
    narrow = entangled.only(_narrow_rows(start.filter(entangled.hit(F.col("row_key"))))) if entangled else entangled
    wide = entangled.without(narrow.keys)
    if narrow:
        by_case, rest = _decide_by_case(*of(narrow))
        wide = entangled.only([*wide.keys, *rest])
        decided = decided.unionByName(by_case)
    if wide:
        decided = decided.unionByName(_decide_in_turn(*of(wide)))
    return decided


def _present(cell_rows: DataFrame) -> DataFrame:
    return cell_rows.select(
        "row_key",
        F.col("family").alias("chk_family"),
        F.col("qualifier").alias("chk_qualifier"),
        F.col("value").alias("_value"),
    )


def _start_cells(cell_rows: DataFrame, checks: DataFrame) -> DataFrame:
    """Every checked cell once, with its present value or NULL in ``expected``."""
    checked = checks.select(*CHECKED_CELL).distinct()
    return checked.join(_present(cell_rows), CHECKED_CELL, "left").select(
        *CHECKED_CELL, F.col("_value").alias("expected")
    )


def _fold(start: DataFrame, checks: DataFrame, keys: Sequence[str]) -> DataFrame:
    records = conform(start, _FOLD, _rank=F.lit(0)).unionByName(
        conform(checks, _FOLD, _rank=F.lit(1))
    )
    ordered = records.repartition(*keys).sortWithinPartitions(*keys, "_rank", "ts", "seq")
    return ordered.mapInArrow(_run_checks(list(keys)), _DECIDED)


def _run_checks(keys: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Fold each group's operations; ``state`` holds the group's checked cells only."""
    names = [*keys, "_rank", "chk_family", "chk_qualifier", "expected"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state = None, {}
        for batch in batches:
            changes_of = _changes_by_row(batch.column("changes"))
            records = zip(*[_plain(batch.column(n)) for n in names])
            applied = []
            for row, (*key, rank, family, qualifier, expected) in enumerate(records):
                if key != group:
                    group, state = key, {}
                if rank == 0:
                    state[family, qualifier] = expected
                    applied.append(None)
                    continue
                holds = state[family, qualifier] == expected
                applied.append(holds)
                if holds:
                    _change(state, changes_of(row))
            flags = pa.array(applied, pa.bool_())
            columns = [batch.column(n) for n in CHECK_COLUMNS] + [flags]
            out = pa.RecordBatch.from_arrays(columns, [*CHECK_COLUMNS, "applied"])
            yield out.filter(flags.is_valid())

    return run


def _plain(values: pa.Array) -> list:
    """Python values by way of NumPy, which is several times faster than ``to_pylist``; text as its bytes."""
    if pa.types.is_string(values.type):
        values = values.view(pa.binary())
    return values.to_numpy(zero_copy_only=False).tolist()


def _text(values: list[bytes | None]) -> pa.Array:
    """A text column from bytes, which need not be UTF-8."""
    return pa.array(values, pa.binary()).view(pa.string())


def _changes_by_row(changes: pa.ListArray) -> Callable[[int], list[tuple]]:
    """The changes of a row as tuples, from columns that are converted once per batch."""
    each = list(zip(*[_plain(values) for values in changes.values.flatten()]))
    offsets = _plain(changes.offsets)
    return lambda row: each[offsets[row] : offsets[row + 1]]


def _change(state: dict, changes: list[tuple]) -> None:
    for op, family, qualifier, value in changes:
        if op in (_PUT, _DELETE_CELL):
            if (family, qualifier) in state:
                state[family, qualifier] = value if op == _PUT else None
        else:
            for cell in state:
                if op == _DELETE_ROW or cell[0] == family:
                    state[cell] = None


def _entangled_rows(heavy: DataFrame) -> list[str]:
    """Heavy rows where an operation may change a checked cell other than its own.

    There are at most as many as heavy keys, which are bounded.
    """
    checked = heavy.select(*CHECKED_CELL).distinct()
    several = checked.groupBy("row_key").count().filter("count > 1").select("row_key")
    changed = heavy.select(*CHECKED_CELL, F.inline("changes"))
    wide = F.col("op").isin(DELETE_ROW, DELETE_FAMILY)
    own = (F.col("family") == F.col("chk_family")) & (F.col("qualifier") == F.col("chk_qualifier"))
    by_wide = changed.filter(wide).select("row_key").distinct().join(several, "row_key", "left_semi")
    by_cell = (
        changed.filter(~wide & ~own)
        .select(*CELL_KEY)
        .distinct()
        .join(checked.toDF(*CELL_KEY), CELL_KEY, "left_semi")
        .select("row_key")
    )
    return [r["row_key"] for r in by_wide.union(by_cell).distinct().collect()]


def _narrow_rows(start: DataFrame) -> list[str]:
    """Heavy rows with few checked cells."""
    counts = start.groupBy("row_key").count().filter(F.col("count") <= MAX_CELLS)
    return [r["row_key"] for r in counts.collect()]


def _decide_by_case(
    start: DataFrame, checks: DataFrame, hot: HotKeys
) -> tuple[DataFrame, list[str]]:
    """Decisions on entangled rows with few checked cells, and the rows that have too many cases.

    As many jobs for any number of slices: all slices are folded at once for all their cases,
    one pass over the cases finds the state that each slice starts from, and all are folded again from there.
    """
    spark = checks.sparkSession
    folder = scratch_path(spark, "cases")
    sliced = with_slice(checks, order_slices(checks, hot))
    sliced.write.parquet(f"{folder}/ops")
    sliced = spark.read.schema(sliced.schema).parquet(f"{folder}/ops")
    # Heavy rows are few and so are their cells, so this is small.
    named = F.struct(F.col("chk_family").alias("family"), F.col("chk_qualifier").alias("qualifier"))
    cells = start.groupBy("row_key").agg(F.collect_set(named).alias("_cells"))
    by_slice = ["row_key", "slice"]
    cases = (
        sliced.join(F.broadcast(cells), "row_key")
        .select(*by_slice, "ts", "seq", "chk_family", "chk_qualifier", "expected", _assignments().alias("after"))
        .repartition(*by_slice)
        .sortWithinPartitions(*by_slice, "ts", "seq")
        .mapInArrow(_fold_cases, _CASES)
    )
    cases.write.parquet(f"{folder}/cases")
    cases = spark.read.schema(_CASES).parquet(f"{folder}/cases")
    rest = [r["row_key"] for r in cases.filter("number < 0").select("row_key").distinct().collect()]
    kept = ~F.col("row_key").isin(rest) if rest else F.lit(True)
    first = F.struct("chk_family", "chk_qualifier", F.col("expected").alias("value"))
    assigned = F.collect_list(first).cast(_CASES["after"].dataType)
    begin = start.groupBy("row_key").agg(assigned.alias("after"))
    begin = conform(begin, _CASES, slice=F.lit(-1), number=F.lit(0))
    opening = (
        cases.unionByName(begin)
        .filter(kept)
        .repartition("row_key")
        .sortWithinPartitions(*by_slice, "number")
        .mapInArrow(_chain_cases, _OPENING)
    )
    return _fold(opening, sliced.filter(kept), by_slice), rest


def _assignments() -> Column:
    """What an operation does to the checked cells of its row, once it applies: cells and their values, NULL for absent."""
    cells = F.col("_cells")

    def each(change: Column) -> Column:
        hit = F.filter(
            cells,
            lambda c: F.when(change["op"] == DELETE_ROW, True)
            .when(change["op"] == DELETE_FAMILY, c["family"] == change["family"])
            .otherwise((c["family"] == change["family"]) & (c["qualifier"] == change["qualifier"])),
        )
        value = F.when(change["op"] == PUT, change["value"])
        return F.transform(hit, lambda c: F.struct(c["family"], c["qualifier"], value.alias("value")))

    return F.flatten(F.transform("changes", each))


def _fold_cases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row and slice, the cases of entry values that its operations tell apart, and what each ends in."""
    group, cases = None, None
    names = ["row_key", "slice", "chk_family", "chk_qualifier", "expected"]
    for batch in batches:
        after_of = _changes_by_row(batch.column("after"))
        for row, (*key, family, qualifier, expected) in enumerate(
            zip(*[_plain(batch.column(n)) for n in names])
        ):
            if key != group:
                if cases is not None:
                    yield cases.emit(group)
                group, cases = key, Cases()
            cases.step((family, qualifier), expected, after_of(row))
    if cases is not None:
        yield cases.emit(group)


class Cases:
    """All that a run of operations may do, by the values that cells have before it.

    ``groups`` holds, for each state that some case has led to, that state and the cases. A state
    is what is known of the cells by now: their values, or for a cell never told, the values it has not.
    A case is what the cells had on entry: their values, or the values they had not.
    """

    def __init__(self) -> None:
        self.groups: dict = {}
        self.count = 1
        self._join({}, {}, [({}, {})])

    def _join(self, values: dict, others: dict, cases: list) -> None:
        key = (frozenset(values.items()), frozenset(others.items()))
        self.groups.setdefault(key, (values, others, []))[2].extend(cases)

    def step(self, cell: tuple, expected: bytes | None, after: list[tuple]) -> None:
        if self.count > MAX_CASES:
            return
        if not any(self._may_apply(v, o, cell, expected) for v, o, _ in self.groups.values()):
            return
        before, self.groups = self.groups, {}
        for values, others, cases in before.values():
            if not self._may_apply(values, others, cell, expected):
                self._join(values, others, cases)
                continue
            if cell not in values:
                # Cases where the cell has another value stay apart; in the rest it is now known.
                denied = others.get(cell, frozenset()) | {expected}
                self._join(values, others | {cell: denied}, [(e, o | {cell: denied}) for e, o in cases])
                values, others = values | {cell: expected}, {c: x for c, x in others.items() if c != cell}
                cases = [(e | {cell: expected}, {c: x for c, x in o.items() if c != cell}) for e, o in cases]
            changed = {(family, qualifier): value for family, qualifier, value in after}
            unknown = {c: x for c, x in others.items() if c not in changed}
            self._join(values | changed, unknown, cases)
        self.count = sum(len(cases) for *_, cases in self.groups.values())

    @staticmethod
    def _may_apply(values: dict, others: dict, cell: tuple, expected: bytes | None) -> bool:
        if cell in values:
            return values[cell] == expected
        return expected not in others.get(cell, ())

    def emit(self, group: list) -> pa.RecordBatch:
        if self.count > MAX_CASES:
            rows = [(-1, [], [])]
        else:
            found = [(case, values) for values, _, cases in self.groups.values() for case in cases]
            rows = [
                (
                    number,
                    [(*c, True, v) for c, v in had.items()] + [(*c, False, v) for c, vs in had_not.items() for v in vs],
                    [(*c, v) for c, v in values.items()],
                )
                for number, ((had, had_not), values) in enumerate(found)
            ]
        numbers, conditions, after = zip(*rows)
        columns = [
            _text([group[0]] * len(rows)),
            pa.array([group[1]] * len(rows), pa.int64()),
            pa.array(numbers, pa.int32()),
            _structs(conditions, ["family", "qualifier", "equal", "value"]),
            _structs(after, ["family", "qualifier", "value"]),
        ]
        return pa.RecordBatch.from_arrays(columns, _CASES.fieldNames())


def _structs(lists: Sequence[list[tuple]], names: list[str]) -> pa.Array:
    flat = [item for items in lists for item in items]
    fields = [
        pa.array([item[i] for item in flat], pa.bool_()) if name == "equal" else _text([item[i] for item in flat])
        for i, name in enumerate(names)
    ]
    offsets = [0]
    for items in lists:
        offsets.append(offsets[-1] + len(items))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, names))


def _chain_cases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk each row's slices in order; give every slice the values of the checked cells that it starts from."""
    row, state, before, at = None, {}, {}, None
    for batch in batches:
        conditions_of, after_of = (_changes_by_row(batch.column(n)) for n in ("conditions", "after"))
        rows = []
        for i, (key, number) in enumerate(zip(*[_plain(batch.column(n)) for n in ("row_key", "slice")])):
            if number < 0:
                row, state, at = key, {(f, q): v for f, q, v in after_of(i)}, None
                continue
            if number != at:
                # The case that is met changes the state for the slices after this one.
                at, before = number, dict(state)
                rows.extend((row, number, *cell, value) for cell, value in before.items())
            if all((before[f, q] == value) == equal for f, q, equal, value in conditions_of(i)):
                state.update({(f, q): v for f, q, v in after_of(i)})
        yield _batch(rows, _OPENING)


def _decide_in_turn(start: DataFrame, checks: DataFrame, hot: HotKeys) -> DataFrame:
    """Fold the slices of entangled rows one after the other.

    No task holds more of a row than one slice. Each turn starts from cells
    that the turn before has written to the shared folder.
    """
    spark = checks.sparkSession
    folder = scratch_path(spark, "checks")
    sliced = with_slice(checks, order_slices(checks, hot))
    sliced.repartition("slice", "row_key").write.partitionBy("slice").parquet(f"{folder}/ops")
    ops = spark.read.schema(_SLICED).parquet(f"{folder}/ops")
    turns = sorted(r["slice"] for r in ops.select("slice").distinct().collect())
    cells = start.filter(F.col("expected").isNotNull()).select(
        *[F.col(old).alias(new) for old, new in zip(CHECKED_CELL, CELL_KEY)],
        F.col("expected").alias("value"),
    )
    checked = start.select(*CHECKED_CELL).toDF(*CELL_KEY)
    for turn in turns:
        now = ops.filter(F.col("slice") == turn)
        out = f"{folder}/decided/slice={turn}"
        _fold(_start_cells(cells, now), now, ["row_key"]).write.parquet(out)
        changes = applied_mutations(spark.read.schema(_DECIDED).parquet(out))
        changes = changes.withColumn("batch_id", F.lit(0).cast("long"))
        after = apply(conform(cells, CELL), changes, ARRIVAL_ORDER, NO_HOT_KEYS)
        kept = after.join(checked, CELL_KEY, "left_semi")
        kept.write.parquet(f"{folder}/cells/slice={turn}")
        cells = spark.read.schema(CELL).parquet(f"{folder}/cells/slice={turn}")
    return spark.read.schema(_DECIDED).parquet(f"{folder}/decided").select(*_DECIDED.names)


def _decide_by_slice(start: DataFrame, checks: DataFrame, hot: HotKeys) -> DataFrame:
    by_slice = [*CHECKED_CELL, "slice"]
    sliced = with_slice(checks, order_slices(checks, hot))
    steps = (
        sliced.select(*by_slice, "ts", "seq", "expected", *_effect_on_own_cell())
        .repartition(*by_slice)
        .sortWithinPartitions(*by_slice, "ts", "seq")
        .mapInArrow(_fold_all_entries, _ENTRIES)
    )
    ordered = _reachable(steps, start).repartition(*CHECKED_CELL).sortWithinPartitions(
        *by_slice, "_rank"
    )
    entries = ordered.mapInArrow(_chain_slices, _ENTRIES)
    opening = entries.select(*by_slice, F.col("entry").alias("expected"))
    return _fold(opening, sliced, by_slice)


def _effect_on_own_cell() -> list[Column]:
    """Whether an operation changes the cell it checks, and to what; NULL is absent."""

    def covers(change: Column) -> Column:
        in_family = change["family"] == F.col("chk_family")
        in_cell = in_family & (change["qualifier"] == F.col("chk_qualifier"))
        return (
            F.when(change["op"] == DELETE_ROW, True)
            .when(change["op"] == DELETE_FAMILY, in_family)
            .otherwise(in_cell)
        )

    hits = F.filter("changes", covers)
    return [(F.size(hits) > 0).alias("touches"), F.get(hits, 0)["value"].alias("exit")]


def _reachable(steps: DataFrame, start: DataFrame) -> DataFrame:
    """Steps whose entry is a start value or the exit of some slice, after the start cells.

    The rest can never be taken, and without them the chain is short.
    """
    begin = conform(start, _ENTRIES, slice=F.lit(-1), _rank=F.lit(0), exit=F.col("expected"))
    values = steps.filter("_rank = 1").unionByName(begin).select(*CHECKED_CELL, "exit").distinct()
    s, v = steps.alias("s"), values.alias("v")
    same_cell = [F.col(f"s.{c}") == F.col(f"v.{c}") for c in CHECKED_CELL]
    taken = s.filter("_rank = 1").join(
        v, [*same_cell, F.col("s.entry").eqNullSafe(F.col("v.exit"))], "left_semi"
    )
    return steps.filter("_rank = 0").unionByName(taken).unionByName(begin)


def _fold_all_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per cell and slice, the exit value of every entry value that the slice changes.

    ``ends`` groups entry values by the value they have reached; a value that no
    operation expected yet stands for itself. Each group opens with a row of rank 0.
    """
    group, ends, seen = None, {}, set()
    names = [*CHECKED_CELL, "slice", "touches", "expected", "exit"]
    for batch in batches:
        for *key, touches, expected, value in zip(*[_plain(batch.column(n)) for n in names]):
            if key != group:
                yield from _emit_steps(group, ends)
                group, ends, seen = key, {}, set()
            if not touches:
                continue
            moved = ends.pop(expected, [])
            if expected not in seen:
                seen.add(expected)
                moved.append(expected)
            there = ends.get(value, [])
            large, small = (there, moved) if len(there) > len(moved) else (moved, there)
            large.extend(small)
            if large:
                ends[value] = large
    yield from _emit_steps(group, ends)


def _emit_steps(group: list | None, ends: dict) -> Iterator[pa.RecordBatch]:
    if group is None:
        return
    rows = [(*group, 0, None, None)]
    for value, entries in ends.items():
        rows.extend((*group, 1, entry, value) for entry in entries if entry != value)
        if len(rows) >= _OUT_ROWS:
            yield _entry_batch(rows)
            rows = []
    if rows:
        yield _entry_batch(rows)


def _chain_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk each cell's slices in order; give every slice the value it starts from."""
    group, state, opened = None, None, None
    names = [*CHECKED_CELL, "slice", "_rank", "entry", "exit"]
    for batch in batches:
        rows = []
        for *key, number, rank, entry, value in zip(*[_plain(batch.column(n)) for n in names]):
            if key != group:
                group, state, opened = key, None, None
            if number < 0:
                state = value
            elif rank == 0:
                opened = state
                rows.append((*key, number, 0, opened, None))
            elif entry == opened:
                state = value
        yield _entry_batch(rows)


def _entry_batch(rows: list[tuple]) -> pa.RecordBatch:
    return _batch(rows, _ENTRIES)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    kinds = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32()}
    arrays = [
        _text(list(c)) if f.dataType == T.StringType() else pa.array(list(c), kinds[f.dataType])
        for c, f in zip(columns, schema.fields)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema.fieldNames())
