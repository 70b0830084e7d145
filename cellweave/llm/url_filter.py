"""URL verdicts from rules and from a path-template tree per host.

Paths become templates: per host and level, a segment that varies (digits,
long hex, or many children with few urls each) turns into ``*``. Sibling
branches with the same children and a like share of blocked urls are merged and
share their counts. A template is rejected by its share of blocked urls among
those that a rule decides, smoothed towards the share of the same path template
over all hosts, and that towards the share over all urls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.shared import lower_ascii, saved, unused
from cellweave.plans.skew import broadcast_if_small

# Segments below this depth count as one tail; the tree is no deeper.
DEPTH = 6
# A node whose children are at least this many, with under FEW urls each, is variable.
MIN_CHILDREN, FEW = 20, 3.0
# Weight of the wider share when a share is smoothed; confidence of the merge test.
PRIOR, DELTA = 4.0, 0.05
VARIABLE = r"^([0-9]+|[0-9a-f-]{12,}|.*[0-9]{3,}.*)(\.[a-z0-9]{1,5})?$"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without one."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest of ``rules`` (verdict, ``host/path``) that fits, as struct(verdict, rule); NULL if none does."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url", threshold: float = 0.5) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict``, ``template`` and ``block_share`` to ``pages``.

    ``rules`` is a short list; it decides where it fits, and labels the urls that
    the tree learns from. Columns of these names in ``pages`` are replaced. A NULL
    url, or one without ``://``, has an empty host, path and template. Equal urls
    get equal verdicts; without any labels the share is 0 and all are allowed.
    """
    made = ("host", "path", "rule", "verdict", "template", "block_share")
    own = [F.col(f"`{c}`") for c in pages.columns if c not in made]
    fit = unused("_rule", pages)
    rows = pages.select(
        *own, host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path")
    ).withColumn(fit, rule_of(F.col("host"), F.col("path"), rules))
    paths = saved(
        rows.groupBy("host", "path", fit).agg(F.count("*").alias("n")).select(
            "host", "path", "n", F.col(f"{fit}.verdict").alias("label")
        ),
        "url-paths",
    )
    placed = saved(_templates(paths), "url-templates")
    scored = _merged(placed).select("_key", "block_share")
    decided = placed.join(broadcast_if_small(scored), "_key").select("host", "path", "template", "block_share")
    by_method = F.when(F.col("block_share") >= threshold, "block").otherwise("allow")
    return rows.join(decided, ["host", "path"]).select(
        *own,
        "host",
        "path",
        F.col(f"{fit}.rule").alias("rule"),
        F.coalesce(F.col(f"{fit}.verdict"), by_method).alias("verdict"),
        "template",
        "block_share",
    )


def _templates(paths: DataFrame) -> DataFrame:
    """Add ``template`` to paths, level by level down the tree of each host."""
    parts = F.slice(F.split("path", "/", DEPTH + 2), 2, DEPTH + 1)
    plain = F.transform(parts, lambda s: F.when(s.rlike(VARIABLE), F.lit("*")).otherwise(s))
    out = paths.withColumn("_parts", plain).withColumn("template", F.lit(""))
    for level in range(DEPTH + 1):
        part = F.get("_parts", F.lit(level))
        here = out.filter(part.isNotNull() & (part != "*")).groupBy("host", "template", part.alias("_part"))
        nodes = here.agg(F.sum("n").alias("n")).groupBy("host", "template").agg(
            F.count("*").alias("_children"), F.sum("n").alias("_n")
        )
        wild = nodes.filter((F.col("_children") >= MIN_CHILDREN) & (F.col("_n") < FEW * F.col("_children")))
        wild = broadcast_if_small(wild.select("host", "template", F.lit(True).alias("_wild")))
        step = F.when(F.col("_wild"), F.lit("*")).otherwise(part)
        template = F.when(part.isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), step))
        out = out.join(wild, ["host", "template"], "left").withColumn("template", template).drop("_wild")
        out = saved(out, "url-level")
    parent = F.regexp_extract("template", r"^(.*)/[^/]*$", 1)
    last = F.regexp_extract("template", r"([^/]*)$", 1)
    return out.drop("_parts").withColumns({"_parent": parent, "_last": last}).withColumn(
        "_key", F.xxhash64("host", "template")
    )


def _merged(placed: DataFrame) -> DataFrame:
    """One row per template with the block share that it gets alone or through its merged siblings."""
    labelled, blocked = F.col("label").isNotNull(), F.coalesce(F.col("label") == "block", F.lit(False))
    counted = [
        F.sum(F.when(labelled, F.col("n")).otherwise(0)).alias("labelled"),
        F.sum(F.when(blocked, F.col("n")).otherwise(0)).alias("blocked"),
    ]
    leaves = placed.groupBy("_key", "host", "template", "_parent", "_last").agg(*counted)
    # A branch is a parent template; like branches hang from one node and have the same children.
    branches = leaves.groupBy("host", "_parent").agg(
        F.sum("labelled").alias("_l"),
        F.sum("blocked").alias("_b"),
        F.sum(F.xxhash64("_last").bitwiseAND(0xFFFFFFFF)).alias("_shape"),
    )
    above = F.regexp_extract("_parent", r"^(.*)/[^/]*$", 1)
    groups = branches.groupBy("host", above.alias("_above"), "_shape").agg(
        F.sum("_l").alias("_gl"), F.sum("_b").alias("_gb")
    )
    gap = F.abs(F.col("_b") / F.col("_l") - F.col("_gb") / F.col("_gl"))
    bound = F.sqrt(F.log(F.lit(2 / DELTA)) / (2 * F.col("_l")))
    alike = (F.col("_l") > 0) & (gap <= bound)
    # Only labelled branches that pass the test pool their counts; a branch without labels shows no likeness.
    passed = branches.withColumn("_above", above).join(groups, ["host", "_above", "_shape"]).filter(alike)
    pooled = passed.groupBy("host", "_above", "_shape").agg(F.sum("_l").alias("_pl"), F.sum("_b").alias("_pb"))
    pool = passed.join(pooled, ["host", "_above", "_shape"]).select("host", "_parent", "_pl", "_pb")
    total = leaves.agg(F.sum("labelled").alias("_tl"), F.sum("blocked").alias("_tb"))
    general = leaves.groupBy("template").agg(F.sum("labelled").alias("_al"), F.sum("blocked").alias("_ab"))
    wide = general.join(F.broadcast(total), how="inner").select(
        "template", _smooth("_ab", "_al", F.coalesce(F.try_divide("_tb", "_tl"), F.lit(0.0))).alias("_wide")
    )
    with_pool = leaves.join(pool, ["host", "_parent"], "left")
    # A leaf without labels of its own takes those of its merged branches.
    blocked_n = F.when(F.col("labelled") > 0, F.col("blocked")).otherwise(F.coalesce("_pb", F.lit(0)))
    labelled_n = F.when(F.col("labelled") > 0, F.col("labelled")).otherwise(F.coalesce("_pl", F.lit(0)))
    return with_pool.join(wide, "template").withColumn(
        "block_share", (blocked_n + PRIOR * F.col("_wide")) / (labelled_n + PRIOR)
    )


def _smooth(hits: str, n: str, prior: Column) -> Column:
    return (F.col(hits) + PRIOR * prior) / (F.col(n) + PRIOR)
