"""How far the sources of a language differ in their words, over run-length columns.

A language's vocabulary is put in the order of its terms' counts by source, so
that equal counts stand together, and each source's column of counts is kept as runs.
Two sources are compared run by run: the bounds of their runs are cut with each other,
and the divergence of a run's two probabilities counts once for each term in it. Terms of the same counts in
every source are one row with a length from the start.

Probabilities are whole billionths, divergences their rounded-down quotients; nothing
is rounded otherwise, and nothing overflows while a group counts fewer than 9e15 words.

Only ``text``, ``lang`` and ``source`` are read; other columns do not matter,
whatever their names. NULL counts as the empty text. Repeated rows are documents of their
own. A language or source without terms is a group like others; an empty table gives
no group. Equal values rank by their items' UTF-8 bytes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.shared import saved
from cellweave.plans.skew import broadcast_if_small

# A language keeps the terms of at least so many of its documents.
LEAST_DOCS = 10
ONE = 1_000_000_000
TOP_TERMS = 10
# Letters are what terms consist of: A-Z, in lower case, a-z and all that is not ASCII.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
# Bytes of text that are split at once, and sums that a task holds before it hands them on.
_CUT, _STEP = 1 << 20, 1 << 12
_HELD = 300_000
# Rows of counts whose runs are compared at once.
_BLOCK = 4_096


def terms_of(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, some at a time; a term is never cut."""
    at = 0
    while at < len(raw):
        end = min(at + _CUT, len(raw))
        parts = [raw[at:end].translate(_LETTERS)]
        while end < len(raw) and not parts[-1].endswith(b" "):
            more = raw[end : end + _STEP].translate(_LETTERS)
            parts.append(more[: more.find(b" ") + 1] or more)
            end += len(parts[-1])
        yield b"".join(parts).split()
        at = end


def _groups(docs: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(text("lang"), text("source"), text("text"))


def term_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, term, total, counts``: each kept term with its occurrences, in all and by source (an array of source and n, sources ascending)."""
    rows = _groups(docs).select("lang", "source", F.col("text").cast("binary").alias("text"))
    sums = rows.mapInArrow(_sums, "lang string, source string, term binary, n long, docs long")
    # One shuffle by language and term serves the sums by source and those over sources.
    by_term = sums.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = by_term.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("counts")
    )
    return kept.filter(F.col("docs") >= least_docs).select("lang", F.col("term").cast("string").alias("term"), "total", "counts")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term, summed by language and source over many rows."""
    counts: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}
    held = 0
    for batch in batches:
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"]):
            group = (lang, source)
            n, d = counts.setdefault(group, Counter()), docs.setdefault(group, Counter())
            before, own = len(n), set()
            for part in terms_of(text.as_py()):
                n.update(part)
                own.update(part)
            d.update(own)
            held += 1 + len(n) - before
            if held > _HELD:
                yield from _summed(counts, docs)
                counts, docs, held = {}, {}, 0
    yield from _summed(counts, docs)


def _summed(counts: dict, docs: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), own in counts.items():
        if own:
            n, d = len(own), docs[lang, source]
            columns = [
                pa.array([lang] * n, pa.string()),
                pa.array([source] * n, pa.string()),
                pa.array(list(own), pa.binary()),
                pa.array(list(own.values()), pa.int64()),
                pa.array([d[t] for t in own], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])


def group_sizes(docs: DataFrame, counted: DataFrame) -> DataFrame:
    """``lang, source, size, all_size, vocabulary``: kept words of each occurring group and of its language, and its kept terms."""
    words = counted.select("lang", F.explode("counts").alias("c")).groupBy("lang", "c.source").agg(F.sum("c.n").alias("size"))
    totals = counted.groupBy("lang").agg(F.count("*").alias("vocabulary"), F.sum("total").alias("all_size"))
    groups = _groups(docs).select("lang", "source").distinct()
    none = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return groups.join(words, ["lang", "source"], "left").join(totals, "lang", "left").select("lang", "source", *map(none, ("size", "all_size", "vocabulary")))


def probability(n: Column, size: Column, vocabulary: Column) -> Column:
    """Smoothed share of a term in whole billionths, above zero."""
    wide = lambda c: c.cast("decimal(19,0)")
    share = F.call_function("div", F.lit(ONE).cast("decimal(10,0)") * wide(n + 2), wide(size + 2 * vocabulary))
    return F.lit(1) + share


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def probabilities(n: np.ndarray, size: int, vocabulary: int) -> np.ndarray:
    """As ``probability``, by long division, so that no step passes 63 bits."""
    whole = size + 2 * vocabulary
    quotient, rest = np.divmod(n + 2, whole)
    for _ in range(3):  # ONE is a thousand thrice over
        more, rest = np.divmod(rest * 1000, whole)
        quotient = quotient * 1000 + more
    return 1 + quotient


def pair_divergence(counted: DataFrame, sizes: DataFrame) -> DataFrame:
    """``lang, source, other, value`` for every two sources of a language: divergences summed over its kept terms."""
    # Terms of the same counts in every source are one row; a common row (one word in one source) combines in each task.
    alike = counted.groupBy("lang", "counts").agg(F.count("*").alias("length"))
    of_lang = sizes.groupBy("lang").agg(
        F.array_sort(F.collect_list(F.struct("source", "size"))).alias("sizes"), F.first("vocabulary").alias("vocabulary")
    )
    rows = saved(alike.join(broadcast_if_small(of_lang), "lang"), "divergence-rows")
    # Ordered by their counts, so that equal ones cluster; a language is dealt to as many ranges as it needs.
    ordered = rows.repartitionByRange("lang", "counts").sortWithinPartitions("lang", "counts")
    parts = ordered.mapInArrow(_compare, "lang string, source string, other string, value long")
    half = parts.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    met = half.unionByName(half.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))
    # Where no term is kept, sources still form pairs.
    bare = sizes.filter("vocabulary = 0").select("lang", "source")
    others = bare.select("lang", F.col("source").alias("other"))
    unmet = bare.join(others, "lang").filter("source != other").withColumn("value", F.lit(0).cast("long"))
    return met.unionByName(unmet)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of each pair of sources over blocks of rows of one language."""
    lang, sizes, vocabulary, block = None, [], 0, []
    for batch in batches:
        columns = [batch[n] for n in ("lang", "counts", "length", "sizes", "vocabulary")]
        for i, own in enumerate(columns[0].to_pylist()):
            if own != lang or len(block) == _BLOCK:
                yield from _pairs(lang, sizes, vocabulary, block)
                block = []
            if own != lang:
                lang, sizes, vocabulary = own, columns[3][i].as_py(), columns[4][i].as_py()
            block.append((columns[1][i].as_py(), columns[2][i].as_py()))
    yield from _pairs(lang, sizes, vocabulary, block)


def runs(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal numbers begin, and their numbers."""
    starts = np.flatnonzero(np.diff(column, prepend=column[:1] - 1))
    return starts, column[starts]


def _pairs(lang: str, sizes: list[dict], vocabulary: int, block: list[tuple]) -> Iterator[pa.RecordBatch]:
    if not block:
        return
    number = {s["source"]: k for k, s in enumerate(sizes)}
    columns: list[tuple[list, list]] = [([], []) for _ in sizes]
    for row, (counts, _) in enumerate(block):
        for c in counts:
            at, n = columns[number[c["source"]]]
            at.append(row)
            n.append(c["n"])
    before = np.concatenate([[0], np.cumsum([length for _, length in block])])
    coded = []
    for (at, n), s in zip(columns, sizes):
        column = np.zeros(len(block), np.int64)
        column[at] = n
        starts, numbers = runs(column)
        coded.append((starts, probabilities(numbers, s["size"], vocabulary)))
    names = [s["source"] for s in sizes]
    for a, (starts, p) in enumerate(coded[:-1]):
        values = []
        for others, q in coded[a + 1 :]:
            cuts = np.union1d(starts, others)
            own, its = p[np.searchsorted(starts, cuts, "right") - 1], q[np.searchsorted(others, cuts, "right") - 1]
            lengths = np.diff(before[np.append(cuts, len(block))])
            values.append(int(((own - its) ** 2 // (own + its) * lengths).sum()))
        n = len(values)
        columns_out = [pa.array([lang] * n), pa.array([names[a]] * n), pa.array(names[a + 1 :]), pa.array(values, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns_out, names=["lang", "source", "other", "value"])


def term_divergence(counted: DataFrame, sizes: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, term, value, rank``: the ``top`` terms that a source has more of than its language."""
    said = counted.select("lang", "term", "total", F.explode("counts").alias("c")).select("lang", "term", "total", "c.source", "c.n")
    known = said.join(broadcast_if_small(sizes), ["lang", "source"])
    p = probability(F.col("n"), F.col("size"), F.col("vocabulary"))
    q = probability(F.col("total"), F.col("all_size"), F.col("vocabulary"))
    more = known.select("lang", "source", "term", p.alias("p"), q.alias("q")).filter("p > q")
    valued = more.select("lang", "source", "term", divergence(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    return valued.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: pairs of sources (part ``pair``) and a source's own terms (part ``term``)."""
    counted = saved(term_counts(docs, least_docs), "divergence-terms")
    sizes = saved(group_sizes(docs, counted), "divergence-sizes")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "other")
    pairs = pair_divergence(counted, sizes).withColumn("rank", F.row_number().over(ranked))
    terms = term_divergence(counted, sizes, top)
    return pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", "rank").unionByName(
        terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    )
