"""Secret scans over a ledger of content-addressed blobs.

Every version of every file is named by the digest of its content. The ledger
holds what each (blob, rule, version) gave, nothing found included. A scan reads
only the blobs with pairs that the ledger lacks, each from one of its paths, and
joins the findings back to all paths that hold the blob.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.shared import saved, unused
from cellweave.plans.skew import broadcast_if_small

ENTRY = "blob binary, rule string, version int, spans array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A pattern whose leftmost, non-overlapping matches count if group ``group`` has ``least`` characters.

    ``hints``: lower-case strings of which a text must hold one; only saves time.
    A changed rule takes a new ``version``, and is then scanned anew.
    """

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False
    hints: tuple[str, ...] = ()
    version: int = 1


# The base kinds, in the order in which equal starts are listed.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
        any_case=True,
        hints=("passw", "secret", "token", "api"),
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, hints=("akia",)),
    Rule("hex", r"[0-9a-f]+", least=24),
)
# Kinds that come on top of the base ones.
MORE = (
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]+", least=40, hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]+", least=15, hints=("xox",)),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=30, hints=("eyj",)),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("private key-----",)),
)
RULES = BASE + MORE


def finder(rule: Rule) -> Callable[[str], list[tuple[int, int]]]:
    """A function from a text to the spans (code points, end exclusive) that ``rule`` finds."""
    pattern = rule.pattern
    if rule.group == 0 and re.fullmatch(r"\[[^]]+\]\+", pattern):
        # A run of one class is found whole, so its length can be asked for in the pattern.
        pattern = f"{pattern[:-1]}{{{rule.least},}}"
    found = re.compile(pattern, re.ASCII | (re.IGNORECASE if rule.any_case else 0)).finditer
    group, least = rule.group, rule.least
    return lambda text: [m.span() for m in found(text) if m.end(group) - m.start(group) >= least]


def blob_of(content: Column) -> Column:
    """The name of a content; NULL counts as empty."""
    return F.unhex(F.sha2(F.encode(F.coalesce(content.cast("string"), F.lit("")), "UTF-8"), 256))


def scan_new(files: DataFrame, rules: Sequence[Rule] = RULES, ledger: DataFrame | None = None) -> DataFrame:
    """Ledger entries that ``files`` (``path`` of any orderable type, ``content``) still need.

    Only texts are read of which some rule is unseen. Files without a path are
    scanned like others. Ledger rows of other rules or versions do not matter.
    """
    known = {(r.name, r.version): r for r in rules}
    names = F.array(*(F.lit(f"{n}@{v}") for n, v in known))
    seen = F.concat_ws("@", "rule", "version")
    picked = files.select("path", blob_of(F.col("content")).alias("blob"))
    # One path stands for a blob; equal paths with equal contents are dropped below.
    wanted = picked.groupBy("blob").agg(F.min("path").alias("path"))
    todo = names
    if ledger is not None:
        done = ledger.groupBy("blob").agg(F.collect_set(seen).alias("_seen"))
        wanted = wanted.join(done, "blob", "left")
        todo = F.array_except(names, F.coalesce("_seen", F.array().cast("array<string>")))
    wanted = wanted.withColumn("todo", todo).filter(F.size("todo") > 0)
    wanted = saved(wanted.select("blob", "path", "todo"), "secret-todo")
    texts = files.select("path", F.coalesce(F.col("content").cast("string"), F.lit("")).alias("content"))
    unseen = texts.join(broadcast_if_small(wanted.select("path", "blob", "todo")), texts["path"].eqNullSafe(wanted["path"]))
    # Several versions may share a path: each blob is read from the row that holds it.
    unseen = unseen.filter(blob_of(F.col("content")) == F.col("blob")).select("blob", "todo", "content")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = {f"{n}@{v}": (n, v, finder(r), r.hints) for (n, v), r in known.items()}
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                out = []
                for blob, todo, text in zip(part["blob"], part["todo"].to_pylist(), part["content"]):
                    text, blob = text.as_py(), blob.as_py()
                    low = text.lower()
                    for key in todo:
                        name, version, find, hints = tools[key]
                        may = not hints or any(h in low for h in hints)
                        spans = [{"start": a, "end": b} for a, b in find(text)] if may else []
                        out.append((blob, name, version, spans))
                columns = list(zip(*out)) if out else [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, _ENTRY_TYPES)], names=["blob", "rule", "version", "spans"]
                )

    entries = unseen.mapInArrow(scan, ENTRY)
    # Rows that repeat path and content would enter twice.
    return entries.dropDuplicates(["blob", "rule", "version"])


_ENTRY_TYPES = [
    pa.binary(),
    pa.string(),
    pa.int32(),
    pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
]


def findings(files: DataFrame, ledger: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``path``, ``blob`` and ``spans`` for every row of ``files``: structs of rule, start and end in order.

    Spans are ordered by start, then by the order of ``rules``, then by end.
    """
    rows = files.select("path", blob_of(F.col("content")).alias("blob"))
    return rows.join(broadcast_if_small(_by_blob(ledger, rules)), "blob", "left").select(
        "path", "blob", F.coalesce("spans", _no_spans()).alias("spans")
    )


def redacted(docs: DataFrame, ledger: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with every finding in ``text`` replaced, and all other columns and texts as they are."""
    name, blob, spans = (unused(n, docs) for n in ("_name", "_blob", "_spans"))
    columns = [redact(F.col(text), F.coalesce(spans, _no_spans())).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    found = _by_blob(ledger, rules).select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    rows = docs.withColumn(name, blob_of(F.col(text)))
    return rows.join(broadcast_if_small(found), F.col(name) == F.col(blob), "left").select(columns)


def _no_spans() -> Column:
    return F.array().cast("array<struct<rule:string,start:int,end:int>>")


def _by_blob(ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``blob`` and ``spans`` of the blobs in which ``rules`` found something."""
    order = F.map_from_arrays(
        F.array(*(F.lit(f"{r.name}@{r.version}") for r in rules)), F.array(*(F.lit(i) for i in range(len(rules))))
    )
    single = (
        ledger.withColumn("_rank", F.try_element_at(order, F.concat_ws("@", "rule", "version")))
        .filter(F.col("_rank").isNotNull() & (F.size("spans") > 0))
        .select("blob", "rule", "_rank", F.explode("spans").alias("_s"))
    )
    spans = F.array_sort(F.collect_list(F.struct("_s.start", "_rank", "_s.end", "rule")))
    plain = lambda s: F.struct(s["rule"].alias("rule"), s["start"].alias("start"), s["end"].alias("end"))
    per_blob = single.groupBy("blob").agg(spans.alias("_spans"))
    return saved(per_blob.select("blob", F.transform("_spans", plain).alias("spans")), "secret-findings")


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string")))
    )


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its rule's name in brackets; overlapping spans merge into the first."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    step = lambda acc, s: F.struct(
        F.when(s["end"] <= acc["at"], acc["out"])
        .when(s["start"] < acc["at"], acc["out"])
        .otherwise(
            F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("["), s["rule"], F.lit("]"))
        )
        .alias("out"),
        F.greatest(acc["at"], s["end"]).alias("at"),
    )
    done = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.lit(2**31 - 1)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, done))
