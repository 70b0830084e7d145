"""Links between nodes that share buckets, and the classes that links form; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellweave.llm.shared import saved
from cellweave.plans.skew import broadcast_if_small


Judge = Callable[[DataFrame], DataFrame]
# Pairs and a similarity, to what parts a node from its leader.
Apart = Callable[[DataFrame, float], DataFrame]


# Nodes of a bucket that meet in one cell of a join, at most about, on either side.
CELL = 256
# Buckets of more nodes than this are searched by what parts their nodes from the leader, where that is known.
DENSE = 8


def linked(
    rows: DataFrame,
    judge: Judge,
    similarity: float,
    sizes: DataFrame,
    finer: Callable[[DataFrame], DataFrame] | None = None,
    likely: Callable[[DataFrame], DataFrame] | None = None,
    apart: Apart | None = None,
) -> DataFrame:
    """Pairs (``node``, ``leader``) that connect similar nodes among distinct ``rows`` (``node``, ``bucket``), found in turns.

    ``judge`` adds ``overlap``, the exact Jaccard similarity, to pairs; ``sizes`` has the ``size`` of each ``node``'s
    bag. In the first turn all nodes of a bucket are
    judged against one of them, which is one pair a node: the node that meets
    most others over all buckets, such as the text that a group was copied from.
    Those below ``similarity`` go on without it; ``finer`` may deal such nodes
    (a table of ``node``) into buckets in which less similar nodes rarely meet. They are
    judged against one leader a bucket, then 4, then 16 and so on, until no bucket has two nodes
    left. At last all nodes of a bucket of ``rows`` that the links so far leave unconnected are
    judged, but for those that exact bounds part, so the links connect all that similar pairs within buckets connect.
    What the turns have connected is returned as pairs of each node and its component's least, not judged themselves.

    With ``apart`` there is one turn in finer buckets, of those pairs that ``likely`` keeps, and large buckets are not
    searched pair by pair, see ``_sharing``. ``apart`` gives ``node``, ``leader``, ``element``, ``place``, ``gap``
    and ``indexed`` for pairs, of elements that two nodes or more have beside one leader.
    """
    found, rest, near = _turn(_ranked(rows), judge, similarity, 1)
    near = saved(near, "link-near")
    leaders_each = 4
    if finer is not None and not rest.isEmpty():
        rest, leaders_each = _ranked(saved(finer(rest.select("node").distinct()), "link-finer")), 1
    further = judge if likely is None else lambda pairs: judge(likely(pairs))
    while not rest.isEmpty():
        links, rest, _ = _turn(rest, further, similarity, leaders_each)
        found = found.unionByName(links)
        leaders_each *= 4
        if apart is not None:
            break
    root = components(found)
    pairs = saved(_unconnected(near, root, sizes, similarity, apart), "link-unconnected")
    judged = saved(judge(pairs), "link-pairs")
    found = root.withColumnRenamed("root", "leader")
    return found.unionByName(judged.filter(F.col("overlap") >= similarity).select("node", "leader"))


def _unconnected(near: DataFrame, root: DataFrame, sizes: DataFrame, similarity: float, apart: Apart | None) -> DataFrame:
    """Pairs of nodes that share a bucket of ``near`` (``bucket``, ``node``, ``lead``, ``near``) and no ``root``, and may be similar.

    One less the similarity is a metric, so two nodes whose similarities (``near``) to their bucket's leader are further apart
    are not similar; nor are bags whose sizes differ too much. Large buckets are cut into cells.
    """
    rows = near.join(broadcast_if_small(root), "node", "left").withColumn("root", F.coalesce("root", "node"))
    rows = saved(rows.join(sizes, "node"), "link-roots")
    roots = rows.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    buckets = roots.groupBy("bucket").agg(
        F.sum("n").alias("all"), F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("roots")
    )
    # Each pair has a node outside of the bucket's largest group.
    cells = lambda n: F.ceil(n / CELL).cast("int")
    buckets = buckets.filter("roots > 1").select(
        "bucket",
        F.col("most.root").alias("main"),
        cells(F.col("all") - F.col("most.n")).alias("outer_cells"),
        cells(F.col("all")).alias("cells"),
        F.col("all").alias("nodes"),
    )
    if apart is None:
        return _in_cells(saved(rows.join(broadcast_if_small(buckets), "bucket"), "link-open"), similarity)
    buckets = buckets.withColumn("dense", F.col("nodes") > DENSE).drop("nodes")
    rows = saved(rows.join(broadcast_if_small(buckets), "bucket"), "link-open")
    pairs = _in_cells(rows.filter("NOT dense"), similarity)
    members = saved(rows.filter("dense").select("lead", "node", "root", "size").distinct(), "link-dense")
    return pairs if members.isEmpty() else pairs.unionByName(_sharing(members, similarity, apart)).distinct()


def _sharing(members: DataFrame, similarity: float, apart: Apart) -> DataFrame:
    """Pairs of nodes of one ``lead`` and no one ``root`` that may be similar, of ``members`` (``lead``, ``node``, ``root``, ``size``).

    What parts a node's bag from its leader's are the elements that one of them has and the other lacks; ``gap`` is their number.
    Bags x, y have as many elements apart as their gaps have together, less twice those that both gaps hold. They are similar if that
    is at most r * (size x + size y), r = (1 - similarity) / (1 + similarity); leaders' own links have one root, so one of a pair
    is further than that from the leader, and both gaps hold at least c = (gap x + gap y - r * (size x + size y)) / 2 > 0 elements in common.
    The first of them, in an order of all elements, has at least c - 1 behind it in either gap. So nodes meet
    where an element is near the front of both gaps (``place``), and copies with edits of their own don't meet at all.
    """
    r = (1 - similarity) / (1 + similarity)
    roots = members.groupBy("lead", "root").agg(F.count("*").alias("n"))
    main = roots.groupBy("lead").agg(F.max(F.struct("n", "root"))["root"].alias("main"))
    members = members.join(broadcast_if_small(main), "lead").withColumn("outer", F.col("root") != F.col("main")).drop("main")
    fronts = apart(members.filter("node != lead").select("node", F.col("lead").alias("leader")), similarity)
    fronts = fronts.withColumnRenamed("leader", "lead").join(broadcast_if_small(members), ["lead", "node"])
    fronts = saved(fronts, "link-fronts")
    less = fronts.filter("indexed").select(
        "lead", "element", *(F.col(c).alias(f"_{c}") for c in ("node", "root", "size", "place", "gap", "outer"))
    )
    common = (F.col("gap") + F.col("_gap") - r * (F.col("size") + F.col("_size"))) / 2 - 1e-6
    may_be = (
        (F.col("root") != F.col("_root"))
        & (F.col("gap") >= F.col("_gap"))
        & (F.least("size", "_size") >= similarity * F.greatest("size", "_size") - 1e-9)
        & (F.least(F.col("gap") - F.col("place"), F.col("_gap") - F.col("_place")) >= common)
    )
    # Each pair has a node outside of the largest group.
    both = fronts.join(less.filter("_outer"), ["lead", "element"]).filter(may_be).unionByName(
        fronts.filter("outer").join(less.filter("NOT _outer"), ["lead", "element"]).filter(may_be)
    )
    return both.select(F.least("node", "_node").alias("node"), F.greatest("node", "_node").alias("leader")).distinct()


def _in_cells(rows: DataFrame, similarity: float) -> DataFrame:
    """Pairs of nodes that share a bucket of ``rows`` and no ``root``, and may be similar by their ``near`` and ``size``."""
    own = F.xxhash64("node", F.lit(1))
    one = rows.filter("root != main").select(
        "bucket", "node", "root", "near", "size",
        F.pmod(own, "outer_cells").cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("j"),
    )
    other = rows.select(
        "bucket",
        F.col("node").alias("leader"),
        F.col("root").alias("_root"),
        F.col("near").alias("_near"),
        F.col("size").alias("_size"),
        (F.col("root") != F.col("main")).alias("_outer"),
        F.explode(F.sequence(F.lit(0), F.col("outer_cells") - 1)).alias("i"),
        F.pmod(own, "cells").cast("int").alias("j"),
    )
    both = one.join(other, ["bucket", "i", "j"]).filter(
        (F.col("root") != F.col("_root"))
        & (~F.col("_outer") | (F.col("node") < F.col("leader")))
        & (F.abs(F.col("near") - F.col("_near")) <= 1 - similarity + 1e-9)
        & (F.least("size", "_size") >= similarity * F.greatest("size", "_size") - 1e-9)
    )
    return both.select(F.least("node", "leader").alias("node"), F.greatest("node", "leader").alias("leader")).distinct()


def _ranked(rows: DataFrame) -> DataFrame:
    """The rows of buckets with two nodes or more, with ``degree``: how many its node meets over all buckets."""
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    rows = saved(rows.join(sizes, "bucket"), "link-rows")
    degrees = rows.groupBy("node").agg(F.sum("size").alias("degree"))
    return saved(rows.drop("size").join(degrees, "node"), "link-rows")


def _turn(rows: DataFrame, judge: Judge, similarity: float, leaders_each: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The links to leaders, the rows of nodes that neither lead nor found one in a bucket, and how ``near`` all are to leaders."""
    share = F.pmod(F.xxhash64("node"), F.lit(leaders_each))
    leaders = rows.groupBy("bucket", share.alias("share")).agg(F.max(F.struct("degree", "node")).alias("top"))
    leaders = saved(leaders.select("bucket", F.col("top.node").alias("leader")), "link-leaders")
    met = saved(rows.join(leaders, "bucket").filter("node != leader"), "link-met")
    judged = saved(judge(met.select("node", "leader").distinct()), "link-pairs")
    links = judged.filter(F.col("overlap") >= similarity).select("node", "leader")
    settled = met.join(broadcast_if_small(links), ["node", "leader"], "left_semi").select("bucket", "node")
    settled = saved(settled.unionByName(leaders.withColumnRenamed("leader", "node")).distinct(), "link-settled")
    rest = rows.join(broadcast_if_small(settled), ["bucket", "node"], "left_anti")
    many = rest.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1").drop("size")
    near = met.join(judged, ["node", "leader"]).select("bucket", "node", F.col("leader").alias("lead"), F.col("overlap").alias("near"))
    own = leaders.select("bucket", F.col("leader").alias("node"), F.col("leader").alias("lead"), F.lit(1.0).alias("near"))
    near = near.unionByName(own)
    return links, saved(rest.join(broadcast_if_small(many), "bucket", "left_semi"), "link-rows"), near


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for links (``node``, ``leader``).

    Large and small star operations in turns: nodes move to the least neighbour of
    their neighbours, which halves the height of a component's tree. Every round is a table.
    """
    edges = saved(links.select(F.greatest("node", "leader").alias("u"), F.least("node", "leader").alias("v")).distinct(), "stars")
    while not _are_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # One row an edge, some of them equal.
        large = saved(large.filter("u != v"), "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v")))
        edges = saved(small.filter("u != v").distinct(), "stars")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether each ``u`` of distinct ``edges`` (``u`` > ``v``) has one edge only, so its ``v`` is the least of all it is connected to."""
    ends = edges.select("u", F.lit(1).alias("up")).union(edges.select("v", F.lit(0)))
    more = ends.groupBy("u").agg(F.sum("up").alias("up"), F.count("*").alias("n")).filter("up > 0 AND n > 1")
    return more.agg(F.count("*")).first()[0] == 0


def class_ids(rows: DataFrame, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` (``doc_id``, ``node``) with ``class_id``.

    ``nodes`` has the ``least`` id of each node. A class is a node with all that links
    connect to it; its id is the least of their ids.
    """
    root = components(links)
    members = nodes.join(broadcast_if_small(root), "node", "left").withColumn("root", F.coalesce("root", "node"))
    # Only nodes with links share a root.
    joined = root.select("root").distinct()
    many = members.join(broadcast_if_small(joined), "root", "left_semi").groupBy("root").agg(F.min("least").alias("shared"))
    of_node = members.join(broadcast_if_small(many), "root", "left").select(
        "node", F.coalesce("shared", "least").alias("class_id")
    )
    return rows.join(saved(of_node, "classes"), "node").select("doc_id", "node", "class_id")
