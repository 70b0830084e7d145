"""Applying mutations: put, increment, delete and ordered mixes of them."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.operators.cells import latest
from cellweave.plans.skew import (
    HotKeys,
    broadcast_if_small,
    heavy,
    heavy_rows,
    hot_keys,
    lookup_join,
    order_slices,
    top_keys,
    with_slice,
)
from cellweave.schema import (
    CELL_COLUMNS,
    CELL_KEY,
    DELETE_CELL,
    DELETE_FAMILY,
    DELETE_ROW,
    INCREMENT,
    MUTATION_COLUMNS,
    PUT,
    as_puts,
)
from cellweave.session import scratch_path

EVENT_ORDER = ("ts", "seq")
# Mutations of a later batch win over earlier batches, whatever their time.
ARRIVAL_ORDER = ("batch_id", "ts", "seq")


def put(cell_rows: DataFrame, puts: DataFrame) -> DataFrame:
    """Upsert: the newest of the present and the put versions of each cell."""
    return latest(
        cell_rows.select(*CELL_COLUMNS).unionByName(puts.select(*CELL_COLUMNS))
    )


def increment(cell_rows: DataFrame, deltas: DataFrame) -> DataFrame:
    """Add deltas to counters; a missing counter starts at 0.

    Deltas are summed in each task first, so a counter that takes most of them
    costs one row per task, and then meet the present cells one to one. A cell
    that takes no delta keeps its text, number or not. Overflow, and a delta to
    a value that is no number, fail the job. Of a present cell with several
    versions the newest counts; choosing it adds no shuffle.
    """
    totals = deltas.groupBy(*CELL_KEY).agg(
        F.sum("delta").alias("_added"), F.max(F.struct("ts", "seq")).alias("_at")
    )
    before = latest(cell_rows).select(*CELL_KEY, "value", F.struct("ts", "seq").alias("_was"))
    joined = before.join(totals, CELL_KEY, "full_outer")
    start = F.coalesce(F.col("value").cast("long"), F.lit(0).cast("long"))
    grown = (start + F.col("_added")).cast("string")
    value = F.when(F.col("_added").isNull(), F.col("value")).otherwise(grown)
    at = F.greatest("_was", "_at")
    return joined.select(*CELL_KEY, value.alias("value"), at["ts"].alias("ts"), at["seq"].alias("seq"))


def delete_rows(cell_rows: DataFrame, keys: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Drop all cells of the given row keys, whatever their time."""
    if hot is None:
        hot = hot_keys(cell_rows, "row_key")
    doomed = keys.select("row_key").distinct()
    return lookup_join(cell_rows, doomed, "row_key", "left_anti", hot).select(*cell_rows.columns)


def delete_cells(cell_rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Drop single cells; there is one present cell per key, so no key is heavy."""
    doomed = keys.select(*CELL_KEY).distinct()
    return cell_rows.join(doomed, CELL_KEY, "left_anti").select(*cell_rows.columns)


def delete_families(cell_rows: DataFrame, keys: DataFrame, hot: HotKeys | None = None) -> DataFrame:
    """Drop whole families of rows; keys may be any bytes."""
    row_family = F.concat(F.hex("row_key"), F.lit(":"), F.hex("family")).alias("_row_family")
    tagged = cell_rows.select("*", row_family)
    doomed = keys.select(row_family).distinct()
    if hot is None:
        hot = hot_keys(tagged, "_row_family")
    return lookup_join(tagged, doomed, "_row_family", "left_anti", hot).select(*cell_rows.columns)


def apply(
    cell_rows: DataFrame,
    ops: DataFrame,
    order: Sequence[str] = EVENT_ORDER,
    hot: HotKeys | None = None,
) -> DataFrame:
    """The table after a mixed batch of puts, deletes and increments."""
    base = as_puts(cell_rows)
    if "batch_id" in order:
        base = base.withColumn("batch_id", F.lit(-1).cast("long"))
    return resolve(base.unionByName(ops.select(*base.columns)), order, hot)


def weigh(ops: DataFrame) -> tuple[frozenset[str], HotKeys]:
    """The kinds of mutation there are, and the heavy rows; one pass over two columns."""
    facts = ops.agg(F.collect_set("op").alias("kinds"), top_keys("row_key").alias("top")).first()
    return frozenset(facts["kinds"]), heavy(facts["top"])


def resolve(
    ops: DataFrame,
    order: Sequence[str] = EVENT_ORDER,
    hot: HotKeys | None = None,
    kinds: Collection[str] | None = None,
) -> DataFrame:
    """Live cells after all mutations of a history, in the given total order.

    A history of puts alone, or of increments alone, needs no order between
    tasks and combines before its shuffle. ``hot`` and ``kinds`` are found by
    ``weigh`` unless the caller knows them.
    """
    if hot is None:
        kinds, hot = weigh(ops)
    if kinds is not None and set(kinds) in ({PUT}, {INCREMENT}):
        return _combined(ops, F.struct(*order), set(kinds) == {PUT})
    last = compact(ops, order, hot, tombstones=False)
    value = F.when(F.col("op") == INCREMENT, F.col("delta").cast("string")).otherwise(
        F.col("value")
    )
    return last.select(*CELL_KEY, value.alias("value"), "ts", "seq")


def _combined(ops: DataFrame, at: Column, puts: bool) -> DataFrame:
    value = F.max_by("value", at) if puts else F.sum("delta").cast("string")
    cells = ops.groupBy(*CELL_KEY).agg(value.alias("value"), F.max(at).alias("_at"))
    return cells.select(
        *CELL_KEY, "value", F.col("_at.ts").alias("ts"), F.col("_at.seq").alias("seq")
    )


def compact(
    ops: DataFrame,
    order: Sequence[str] = EVENT_ORDER,
    hot: HotKeys | None = None,
    tombstones: bool = True,
) -> DataFrame:
    """A shorter history with the same outcome: at most one mutation per cell.

    A cell's last put or delete is a reset; increments after it add to it. With
    ``tombstones`` the deletes stay, so that an older put that comes late is
    still shadowed. ``order`` holds ``ts, seq``; what stands before them orders
    batches, what stands after them breaks ties.
    """
    ops = ops.select(*dict.fromkeys([*MUTATION_COLUMNS, *order]))
    if hot is None:
        hot = hot_keys(ops, "row_key")
    if hot:
        light, heavy, hot = _by_weight(ops, hot)
        out = _compact_rows(light, order).unionByName(_compact_hot_rows(heavy, order, hot))
    else:
        out = _compact_rows(ops, order)
    if tombstones:
        return out.unionByName(_wide_tombstones(ops, order))
    return out.filter(F.col("op") != DELETE_CELL)


def _by_weight(ops: DataFrame, hot: HotKeys) -> tuple[DataFrame, DataFrame, HotKeys]:
    """Mutations of light rows, those of heavy rows, and how many the latter are.

    Where the sketch has named as many heavy rows as it can, there may be more:
    then they are counted, and kept as a table that the driver never sees.
    """
    if not hot.full:
        is_heavy = hot.hit(F.col("row_key"))
        return ops.filter(~is_heavy), ops.filter(is_heavy), hot
    path = scratch_path(ops.sparkSession, "heavy-rows")
    counted = heavy_rows(ops, "row_key", hot.min_rows)
    counted.write.parquet(path)
    table = ops.sparkSession.read.schema(counted.schema).parquet(path)
    total = table.agg(F.sum("rows")).first()[0] or 0
    named = broadcast_if_small(table.select("row_key"))
    light, heavy = (ops.join(named, "row_key", how).select(*ops.columns) for how in ("left_anti", "left_semi"))
    return light, heavy, HotKeys(hot.keys, total, hot.min_rows)


def _compact_rows(ops: DataFrame, order: Sequence[str]) -> DataFrame:
    """One shuffle, by row key.

    The windows over cell, family and row all fit that partitioning, and the
    finest comes first so that its sort serves the coarser ones.
    """
    at = F.struct(*order)
    marked = _mark_resets(ops.repartition("row_key"), at, CELL_KEY)
    for name, op, keys in (
        ("_family_cut", DELETE_FAMILY, ["row_key", "family"]),
        ("_row_cut", DELETE_ROW, ["row_key"]),
    ):
        cut = F.max(F.when(F.col("op") == op, at)).over(Window.partitionBy(*keys))
        marked = marked.withColumn(name, cut)
    return _sum_after_reset(_after_cuts(marked, at), order, CELL_KEY)


def _compact_hot_rows(ops: DataFrame, order: Sequence[str], hot: HotKeys) -> DataFrame:
    """Heavy rows in two steps: one mutation per cell and slice, then one per cell.

    Slices follow the mutation order, so the compacted slices are again a
    history, with at most one mutation per slice for any cell.
    """
    at = F.struct(*order)
    row_cuts = ops.filter(F.col("op") == DELETE_ROW).groupBy("row_key").agg(
        F.max(at).alias("_row_cut")
    )
    family_cuts = ops.filter(F.col("op") == DELETE_FAMILY).groupBy("row_key", "family").agg(
        F.max(at).alias("_family_cut")
    )
    by_slice = [*CELL_KEY, *order[: order.index("ts")], "slice"]
    sliced = with_slice(ops, order_slices(ops, hot))
    # Cuts are measured; where they are many, the repartition below leaves
    # the adaptive planner free to split a skewed join.
    joined = sliced.join(broadcast_if_small(row_cuts), "row_key", "left").join(
        broadcast_if_small(family_cuts), ["row_key", "family"], "left"
    )
    alive = _after_cuts(joined, at).repartition(*by_slice)
    per_slice = _sum_after_reset(_mark_resets(alive, at, by_slice), order, by_slice)
    marked = _mark_resets(per_slice.drop("slice"), at, CELL_KEY)
    return _sum_after_reset(marked, order, CELL_KEY)


def _mark_resets(ops: DataFrame, at: Column, keys: Sequence[str]) -> DataFrame:
    reset = F.when(F.col("op").isin(PUT, DELETE_CELL), at)
    return ops.withColumn("_reset", F.max(reset).over(Window.partitionBy(*keys)))


def _after_cuts(ops: DataFrame, at: Column) -> DataFrame:
    """Cell mutations that no row or family delete comes after."""
    cut = F.greatest("_row_cut", "_family_cut")
    narrow = F.col("op").isin(PUT, DELETE_CELL, INCREMENT)
    return ops.filter(narrow & (cut.isNull() | (at > cut)))


def _sum_after_reset(ops: DataFrame, order: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Fold each group to one mutation, given the group's last reset in ``_reset``.

    The window that marked the reset has clustered the rows by ``keys``, so the
    aggregation adds no shuffle.
    """
    at = F.struct(*order)
    adds = F.col("op") == INCREMENT
    folded = (
        ops.filter(F.col("_reset").isNull() | (at >= F.col("_reset")))
        .groupBy(*keys)
        .agg(
            F.max_by("op", F.when(~adds, at)).alias("_op"),
            F.max_by("value", F.when(~adds, at)).alias("_base"),
            F.sum(F.when(adds, F.col("delta"))).alias("_added"),
            F.max(at).alias("_at"),
        )
    )
    has_base = F.col("_op").isNotNull()
    has_sum = F.col("_added").isNotNull()
    total = F.coalesce(F.col("_base").cast("long"), F.lit(0).cast("long")) + F.col("_added")
    op = F.when(~has_base, F.lit(INCREMENT)).when(has_sum, F.lit(PUT)).otherwise(F.col("_op"))
    value = F.when(has_base & has_sum, total.cast("string")).otherwise(F.col("_base"))
    return folded.select(
        *CELL_KEY,
        op.alias("op"),
        value.alias("value"),
        F.when(~has_base, F.col("_added")).alias("delta"),
        *[F.col(f"_at.{name}").alias(name) for name in order],
        *[name for name in keys if name not in CELL_KEY and name not in order],
    )


def _wide_tombstones(ops: DataFrame, order: Sequence[str]) -> DataFrame:
    """The last row delete of each row and the last family delete of each family."""
    return (
        ops.filter(F.col("op").isin(DELETE_ROW, DELETE_FAMILY))
        .groupBy("row_key", "family", "op")
        .agg(F.max(F.struct(*order)).alias("_at"))
        .select(
            "row_key",
            "family",
            F.lit(None).cast("string").alias("qualifier"),
            "op",
            F.lit(None).cast("string").alias("value"),
            F.lit(None).cast("long").alias("delta"),
            *[F.col(f"_at.{name}").alias(name) for name in order],
        )
    )
