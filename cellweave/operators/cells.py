"""Reading cells: versions, scans, rows, maps and wide projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.plans.skew import HotKeys, hot_keys
from cellweave.schema import CELL_KEY
from cellweave.session import scratch_path


def position() -> Column:
    """The total order of mutations and versions."""
    return F.struct("ts", "seq")


def latest(versions: DataFrame) -> DataFrame:
    """The newest version of each cell; versions combine before the shuffle."""
    return (
        versions.groupBy(*CELL_KEY)
        .agg(
            F.max_by("value", position()).alias("value"),
            F.max(position()).alias("_at"),
        )
        .select(*CELL_KEY, "value", F.col("_at.ts").alias("ts"), F.col("_at.seq").alias("seq"))
    )


def last_versions(versions: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` versions of each cell, numbered from 1 in ``version``.

    The rank limit is applied on the map side too, so a cell with many versions
    sends at most ``n`` rows per task.
    """
    newest = Window.partitionBy(*CELL_KEY).orderBy(F.desc("ts"), F.desc("seq"))
    return versions.withColumn("version", F.row_number().over(newest)).filter(
        F.col("version") <= n
    )


def as_of(versions: DataFrame, ts: Column) -> DataFrame:
    """The table as it was at ``ts``, inclusive."""
    return latest(versions.filter(F.col("ts") <= ts))


def scan(
    cell_rows: DataFrame,
    families: Sequence[str] | None = None,
    columns: Sequence[tuple[str, str]] | None = None,
    start: str | None = None,
    stop: str | None = None,
    min_ts: Column | None = None,
    max_ts: Column | None = None,
) -> DataFrame:
    """Restrict a scan; every condition is a plain filter that reaches Parquet.

    Row keys compare as unsigned bytes; ``start`` is inclusive and ``stop``
    exclusive, as is ``max_ts``.
    """
    out = cell_rows
    if start is not None:
        out = out.filter(F.col("row_key") >= start)
    if stop is not None:
        out = out.filter(F.col("row_key") < stop)
    if families is not None:
        out = out.filter(F.col("family").isin(list(families)))
    if columns is not None:
        out = out.filter(_any_of(columns))
    if min_ts is not None:
        out = out.filter(F.col("ts") >= min_ts)
    if max_ts is not None:
        out = out.filter(F.col("ts") < max_ts)
    return out


def to_rows(
    cell_rows: DataFrame,
    versions: int | None = 1,
    batch: int | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """One ``(row_key, cells)`` per row, cells ordered by family and qualifier.

    Of each cell the newest ``versions`` are handed out, newest first; None
    takes all there are. Cells are (family, qualifier, value) where one version
    is asked for, and carry ``ts`` and ``seq`` otherwise.

    With ``batch`` a row comes as ``(row_key, part, cells)`` with ``batch`` cells
    in every part but its last, numbered in key order.

    A heavy row is cut into consecutive ranges of its cells, each put in order
    by a task of its own, and the ranges are strung together; the records are
    the same as those of a light row. Without ``batch`` a row is one value and
    has to fit into a task.
    """
    if hot is None:
        hot = hot_keys(cell_rows, "row_key")
    light = cell_rows.filter(~hot.hit(F.col("row_key"))) if hot else cell_rows
    rows = _light_rows(light, versions)
    if batch:
        last = F.floor((F.size("cells") - 1) / F.lit(batch)).cast("int")
        cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("cells", i * batch + 1, batch))
        rows = rows.select("row_key", F.posexplode(cut).alias("part", "cells")).withColumn(
            "part", F.col("part").cast("long")
        )
    if not hot:
        return rows
    heavy = _heavy_rows(cell_rows.filter(hot.hit(F.col("row_key"))), versions, batch, hot)
    return rows.unionByName(heavy)


def _ranked() -> Column:
    """A version with its place: by family and qualifier, and the newest first."""
    return F.struct(
        "family",
        "qualifier",
        F.bitwise_not(F.unix_micros("ts")).alias("_older"),
        F.bitwise_not("seq").alias("_earlier"),
        "value",
        "ts",
        "seq",
    )


def _shown(cell: Column, versions: int | None) -> Column:
    names = ["family", "qualifier", "value"] + ([] if versions == 1 else ["ts", "seq"])
    return F.struct(*[cell[name].alias(name) for name in names])


def _light_rows(cell_rows: DataFrame, versions: int | None) -> DataFrame:
    """Rows by one shuffle; versions are chosen in the sorted row, which is no larger than a light row may be."""
    rows = cell_rows.groupBy("row_key").agg(F.array_sort(F.collect_list(_ranked())).alias("_all"))
    if versions is None:
        kept = F.col("_all")
    else:

        def is_new(cell: Column, i: Column) -> Column:
            before = F.get("_all", i - versions)
            same = (before["family"] == cell["family"]) & (before["qualifier"] == cell["qualifier"])
            return F.when(i < versions, True).otherwise(~same)

        kept = F.filter("_all", is_new)
    return rows.select("row_key", F.transform(kept, lambda c: _shown(c, versions)).alias("cells"))


def _heavy_rows(
    cell_rows: DataFrame, versions: int | None, batch: int | None, hot: HotKeys
) -> DataFrame:
    """Heavy rows from ranges of their cells.

    Versions combine in each task before they travel. The ranges are written to
    the shared folder, so that their bounds are drawn once.
    """
    if versions == 1:
        chosen = latest(cell_rows)
    elif versions is None:
        chosen = cell_rows
    else:
        chosen = last_versions(cell_rows, versions)
    spark = cell_rows.sparkSession
    ranges = max(2, 2 * -(-hot.rows // hot.min_rows))
    place = ["row_key", "family", "qualifier", F.desc("ts"), F.desc("seq")]
    sliced = (
        chosen.select(*CELL_KEY, "value", "ts", "seq")
        .repartitionByRange(ranges, *place)
        .withColumn("slice", F.spark_partition_id())
    )
    path = scratch_path(spark, "row-ranges")
    sliced.write.parquet(path)
    stored = spark.read.schema(sliced.schema).parquet(path)
    runs = stored.groupBy("row_key", "slice").agg(F.array_sort(F.collect_list(_ranked())).alias("_all"))
    runs = runs.select(
        "row_key", "slice", F.transform("_all", lambda c: _shown(c, versions)).alias("cells")
    )
    if not batch:
        return _strung(runs, ["row_key"])
    before = Window.partitionBy("row_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("row_key", "slice").agg(F.count("*").alias("n"))
    offsets = sizes.select(
        "row_key", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset")
    )
    # A range holds the end of one row and the start of the next, so there are no more
    # offsets than ranges and heavy rows together.
    placed = runs.join(F.broadcast(offsets), ["row_key", "slice"])
    end = F.col("_offset") + F.size("cells") - 1
    parts = F.sequence(F.floor(F.col("_offset") / batch), F.floor(end / batch))

    def piece(part: Column) -> Column:
        first = F.greatest(part * batch - F.col("_offset"), F.lit(0))
        stop = (part + 1) * batch - F.col("_offset")
        cells = F.slice("cells", (first + 1).cast("int"), F.least(stop - first, F.lit(batch)).cast("int"))
        return F.struct(part.alias("part"), cells.alias("cells"))

    cut = placed.select("row_key", "slice", F.inline(F.transform(parts, piece)))
    return _strung(cut, ["row_key", "part"])


def _strung(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Runs of cells one after the other, in the order of their slices."""
    in_order = F.array_sort(F.collect_list(F.struct("slice", "cells")))
    whole = F.flatten(F.transform(F.col("_runs"), lambda r: r["cells"]))
    return runs.groupBy(*keys).agg(in_order.alias("_runs")).select(*keys, whole.alias("cells"))


def to_maps(rows: DataFrame) -> DataFrame:
    """Rows as ``MAP<family, MAP<qualifier, value>>`` in column ``families``.

    Of a cell with several versions the first in ``cells`` counts, which is the newest.
    """

    def is_newest(cell: Column, i: Column) -> Column:
        before = F.get("cells", i - 1)
        same = before["family"].eqNullSafe(cell["family"])
        return (i == 0) | F.when(same, before["qualifier"] != cell["qualifier"]).otherwise(True)

    def one_family(family: Column) -> Column:
        entries = F.transform(
            F.filter("_newest", lambda c: c["family"] == family),
            lambda c: F.struct(c["qualifier"], c["value"]),
        )
        return F.struct(family, F.map_from_entries(entries))

    # Each cell is compared with the one before it in the whole row, so a row costs no more than
    # its cells times its families.
    rows = rows.select(*_keys(rows), F.filter("cells", is_newest).alias("_newest"))
    names = F.array_distinct(F.transform("_newest", lambda c: c["family"]))
    nested = F.map_from_entries(F.transform(names, one_family))
    return rows.select(*_keys(rows), nested.alias("families"))


def _keys(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c in ("row_key", "part")]


def map_value(families: Column, family: str, qualifier: str) -> Column:
    """A cell of a nested map; NULL when the family or the qualifier is missing."""
    return F.try_element_at(F.try_element_at(families, F.lit(family)), F.lit(qualifier))


def map_rows(rows: DataFrame, *columns: Column) -> DataFrame:
    """A scan with a row function: ``columns`` are expressions over row_key and cells."""
    return rows.select(*columns)


def project(cell_rows: DataFrame, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One wide record per row key with the named cells of the latest view.

    Only the requested cells are read and shuffled; rows that have none of them
    do not appear.
    """
    wanted = cell_rows.filter(_any_of(list(columns.values())))
    picks = [
        F.max(F.when(_is_cell(family, qualifier), F.col("value"))).alias(name)
        for name, (family, qualifier) in columns.items()
    ]
    return wanted.groupBy("row_key").agg(*picks)


def render(rows: DataFrame) -> DataFrame:
    """Key and row as strings, the row as a JSON array of its cells."""
    return rows.select(*_keys(rows), F.to_json("cells").alias("value"))


def _is_cell(family: str, qualifier: str) -> Column:
    return (F.col("family") == family) & (F.col("qualifier") == qualifier)


def _any_of(columns: Sequence[tuple[str, str]]) -> Column:
    """True for the listed cells, written so that both columns can be pushed down."""
    families: dict[str, list[str]] = {}
    for family, qualifier in columns:
        families.setdefault(family, []).append(qualifier)
    match = F.lit(False)
    for family, qualifiers in families.items():
        match = match | ((F.col("family") == family) & F.col("qualifier").isin(qualifiers))
    return match
