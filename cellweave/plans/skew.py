"""Find heavy keys and cut their work into ordered slices.

One key may hold a large part of all rows. Aggregates with a map side need no
care, but ordered work (last reset, conditional operations) and keyed joins do.
The helpers below look at the data once, through mergeable sketches, and hand
back facts of bounded size: at most ``MAX_HOT_KEYS`` keys and ``MAX_SLICES`` cut
points. The facts only choose a plan; results do not depend on them.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# A key with fewer rows than this is never worth a second stage.
HOT_ROWS = 1_000_000
# Keys past this rank hold at most 1/MAX_HOT_KEYS of the rows each.
MAX_HOT_KEYS = 1_000
TRACKED_KEYS = 50_000
MAX_SLICES = 4_096
# A broadcast has this many bytes at most, measured before it is planned.
MAX_BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class HotKeys:
    """Heavy values of one key column and the rows they hold together."""

    keys: tuple = ()
    rows: int = 0
    min_rows: int = HOT_ROWS

    def __bool__(self) -> bool:
        return bool(self.keys)

    @property
    def full(self) -> bool:
        """There may be more heavy values than these."""
        return len(self.keys) >= MAX_HOT_KEYS

    def hit(self, key: Column) -> Column:
        """True for rows of a heavy key; never NULL."""
        return F.coalesce(key.isin(list(self.keys)), F.lit(False))

    def only(self, keys: Collection) -> HotKeys:
        wanted = set(keys)
        return HotKeys(tuple(k for k in self.keys if k in wanted), self.rows, self.min_rows)

    def without(self, keys: Collection) -> HotKeys:
        return self.only(set(self.keys) - set(keys))


NO_HOT_KEYS = HotKeys()


def top_keys(key: str) -> Column:
    """An aggregate that sketches the most frequent values of ``key``."""
    return F.expr(f"approx_top_k(`{key}`, {MAX_HOT_KEYS}, {TRACKED_KEYS})")


def heavy(top: list[Row] | None, min_rows: int = HOT_ROWS) -> HotKeys:
    """The heavy keys in a result of ``top_keys``."""
    found = [(r["item"], r["count"]) for r in top or [] if r["count"] >= min_rows]
    found = [(item, n) for item, n in found if item is not None]
    if not found:
        return NO_HOT_KEYS
    return HotKeys(tuple(item for item, _ in found), sum(n for _, n in found), min_rows)


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> HotKeys:
    """Heavy values of ``key`` by a frequent-items sketch; one column is read."""
    return heavy(df.agg(top_keys(key).alias("top")).first()["top"], min_rows)


def heavy_rows(df: DataFrame, key: str, min_rows: int) -> DataFrame:
    """All heavy values of ``key`` with their rows, as a table: counted exactly, however many there are."""
    return df.groupBy(key).agg(F.count("*").alias("rows")).filter(F.col("rows") >= min_rows)


@dataclass(frozen=True)
class Slices:
    """Cut points of the mutation order ``(ts, seq)``.

    ``ts_cuts`` are microseconds. ``tied`` are instants that fill a slice by
    themselves; those are cut further by ``seq_cuts``.
    """

    ts_cuts: list[float] = field(default_factory=list)
    tied: list[int] = field(default_factory=list)
    seq_cuts: list[float] = field(default_factory=list)


def order_slices(ops: DataFrame, hot: HotKeys) -> Slices:
    """Cut points that give each slice about ``hot.min_rows`` of the rows in ``ops``.

    All rows of ``ops`` together fill a slice, so one key within a slice holds
    at most that many, whatever its own distribution over time.
    """
    parts = min(MAX_SLICES, max(2, -(-hot.rows // hot.min_rows)))
    shares = [i / parts for i in range(1, parts)]
    micros = F.unix_micros("ts")
    cuts = ops.agg(F.percentile_approx(micros, shares, 10 * parts)).first()[0] or []
    tied = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})
    seq_cuts: list[int] = []
    if tied:
        same = ops.filter(micros.isin(tied))
        seq_cuts = same.agg(F.percentile_approx("seq", shares, 10 * parts)).first()[0] or []
    instants = set(cuts) | set(tied) | {t + 1 for t in tied}
    return Slices(
        [float(c) for c in sorted(instants)], tied, [float(c) for c in sorted(set(seq_cuts))]
    )


def with_slice(df: DataFrame, slices: Slices) -> DataFrame:
    """Add ``slice``, a number that grows with ``(ts, seq)``; binary search, JVM side.

    A NULL time comes first, as it does in that order.
    """
    micros = F.coalesce(F.unix_micros("ts").cast("double"), F.lit(float("-inf")))
    out = _bucket(df, micros, slices.ts_cuts, "_ts_slice")
    if not slices.tied:
        return out.withColumn("slice", F.col("_ts_slice").cast("long")).drop("_ts_slice")
    out = _bucket(out, F.col("seq"), slices.seq_cuts, "_seq_slice")
    within = F.when(F.unix_micros("ts").isin(slices.tied), F.col("_seq_slice")).otherwise(0)
    number = F.col("_ts_slice") * (2 * MAX_SLICES) + within
    return out.withColumn("slice", number.cast("long")).drop("_ts_slice", "_seq_slice")


def _bucket(df: DataFrame, value: Column, cuts: list[float], name: str) -> DataFrame:
    if not cuts:
        return df.withColumn(name, F.lit(0.0))
    splits = [float("-inf"), *cuts, float("inf")]
    source = f"{name}_of"
    bucketizer = Bucketizer(
        splits=splits, inputCol=source, outputCol=name, handleInvalid="keep"
    )
    return bucketizer.transform(df.withColumn(source, value.cast("double"))).drop(source)


def spread(scan: DataFrame) -> DataFrame:
    """Deal rows out evenly when a scan has fewer splits than the cluster has cores.

    A large input has many splits and passes through untouched, so this shuffle
    only happens where the data is small or sits in a few files. Meant for plain
    scans: asking a plan with a shuffle for its partitions would run it.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str,
    hot: HotKeys,
) -> DataFrame:
    """Join ``left`` to ``right``, which has at most one row per ``on``.

    Rows of heavy keys meet a broadcast of their right rows and never shuffle;
    all others take the ordinary shuffle join. Right rows too large to
    broadcast stay in the shuffle join, where the adaptive planner splits
    skewed partitions.
    """
    hot = _broadcastable(right, on, hot)
    if not hot:
        return left.join(right, on, how)
    key = F.col(on)
    cold = left.filter(~hot.hit(key)).join(right.filter(~hot.hit(key)), on, how)
    heavy = left.filter(hot.hit(key)).join(
        F.broadcast(right.filter(hot.hit(key))), on, how
    )
    return cold.unionByName(heavy)


def _broadcastable(right: DataFrame, on: str, hot: HotKeys) -> HotKeys:
    """The heavy keys whose right rows fit the broadcast budget together, heaviest first."""
    if not hot:
        return hot
    width = F.octet_length(F.to_json(F.struct("*"))).cast("long")
    measured = right.filter(hot.hit(F.col(on))).select(on, width.alias("width"))
    sizes = {r[on]: r["size"] for r in measured.groupBy(on).agg(F.sum("width").alias("size")).collect()}
    fitting, total = [], 0
    for key in hot.keys:
        if total + sizes.get(key, 0) <= MAX_BROADCAST_BYTES:
            total += sizes.get(key, 0)
            fitting.append(key)
    return hot.only(fitting)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df``, marked for broadcast when it measures small; this runs it once."""
    width = F.octet_length(F.to_json(F.struct("*"))).cast("long")
    size = df.select(width.alias("width")).agg(F.sum("width")).first()[0] or 0
    return F.broadcast(df) if size <= MAX_BROADCAST_BYTES else df


def keep_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose key is among ``keys``; few keys are broadcast, many are not."""
    wanted = broadcast_if_small(keys.select(on).distinct())
    return df.join(wanted, on, "left_semi")
