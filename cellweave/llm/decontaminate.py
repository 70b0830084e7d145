"""Benchmark decontamination by winnowing, on DataFrame functions only.

Both sides keep, for every window of t words, the smallest hash among its
k-grams and that k-gram's place. Equal windows keep equal hashes at equal places, so a
join on the hash meets every span of t words or more that a document shares with an item.
Each hit is then extended to its window and compared word by word, so no
hash decides a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.shared import lower_ascii, saved, unused
from cellweave.plans.skew import broadcast_if_small

# Fixed value: words are runs of digits, a-z and characters past ASCII.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
_LAST = 2**31 - 1


def words_of(text: Column) -> Column:
    """The words of ``text``, A-Z in lower case; NULL has none."""
    return F.coalesce(F.regexp_extract_all(lower_ascii(text.cast("string")), F.lit(WORDS), F.lit(0)), F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """How many words ``words_of`` gives, without making them."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(ANY_CASE)), F.lit(0)).cast("long")


def fingerprints(words: Column, window: int) -> Column:
    """Kept k-grams of ``words``, each packed into a long: 32 bits of hash, then the place counted from the end.

    The smallest long of a window has its smallest hash, at the last place on ties.
    Texts shorter than ``window`` have none.
    """
    k = max(1, 2 * window // 5)
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    # A lambda parameter names each array once, so that none is computed per element.
    grams = _let(
        hashes,
        lambda h: F.transform(
            _places(F.size(h) - k),
            lambda i: F.shiftleft(F.xxhash64(*(F.get(h, i + j) for j in range(k))), 32).bitwiseOR(
                (F.lit(_LAST) - i).cast("long")
            ),
        ),
    )
    width = window - k + 1
    if width == 1:
        return grams
    return _let(
        grams,
        lambda g: F.array_distinct(
            F.transform(_places(F.size(g) - width), lambda i: F.least(*(F.get(g, i + j) for j in range(width))))
        ),
    )


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _places(last: Column) -> Column:
    """0 to ``last``; empty if that is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _unpacked(packed: Column) -> tuple[Column, Column]:
    place = (F.lit(_LAST) - packed.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")).cast("int")
    return F.shiftright(packed, 32).cast("int"), place


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item_id``, ``passage`` (words joined by spaces) and ``n`` of every window; a shorter item is one window."""
    words = items.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("_w"))
    words = words.filter(F.size("_w") > 0).withColumn("n", F.least(F.size("_w"), F.lit(window)))
    starts = words.select("item_id", "_w", "n", F.explode(F.sequence(F.lit(1), F.size("_w") - F.col("n") + 1)).alias("_at"))
    passage = F.concat_ws(" ", F.slice("_w", F.col("_at"), F.col("n")))
    return starts.select("item_id", passage.alias("passage"), "n").distinct()


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): its words, and those inside windows of ``items``.

    Columns: ``doc_id``, ``n_words``, ``hits`` (places of hit words, from 0, in order),
    ``items`` (ids as sorted strings). NULL texts have no words; items without
    words have no windows; items without an id mark words, but are not listed.
    Equal rows give equal results; other columns are left out.
    """
    counted = docs.select(_row(), "doc_id", word_count(F.col("text")).alias("n_words"))
    result = broadcast_if_small(_contaminated(docs, items, window))
    return counted.join(result, "_row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("hits", F.array().cast("array<int>")).alias("hits"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window of ``items``, with all columns."""
    row = unused("_row", docs)
    result = _contaminated(docs, items, window).select(F.col("_row").alias(row))
    return docs.withColumn(row, _row()).join(broadcast_if_small(result), row, "left_anti").select(*docs.columns)


def _row() -> Column:
    return F.xxhash64("doc_id", "text").alias("_row")


def _contaminated(docs: DataFrame, items: DataFrame, window: int) -> DataFrame:
    """``_row``, ``hits`` and ``items`` of the rows with hits."""
    windows = saved(item_windows(items, window), "passages")
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())
    words = docs.select(_row(), words_of(F.col("text")).alias("_w"))
    met = docs.sparkSession.createDataFrame([], "_row long, start int, n int, passage string")
    for n in lengths:
        met = met.unionByName(_met(words, windows.filter(F.col("n") == n), n))
    met = saved(met.distinct(), "passage-hits")
    per_row = met.groupBy("_row").agg(F.collect_set(F.struct("start", "n", "passage")).alias("_met"))
    sure = saved(_extended(per_row, words), "passage-matches")
    covered = F.transform("_sure", lambda m: F.sequence(m["start"], m["start"] + m["n"] - 1))
    places = F.array_sort(F.array_distinct(F.flatten(covered)))
    listed = (
        sure.select("_row", F.explode(F.array_distinct(F.transform("_sure", lambda m: m["passage"]))).alias("passage"))
        .join(broadcast_if_small(windows.select("passage", "item_id").distinct()), "passage")
        .groupBy("_row")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    return saved(sure.select("_row", places.alias("hits")).join(listed, "_row", "left"), "passage-rows")


def _met(words: DataFrame, windows: DataFrame, n: int) -> DataFrame:
    """Rows and places where a window of ``n`` words may stand, by the fingerprints."""
    passages = windows.select("passage").distinct()
    hash_of, offset = _unpacked(F.get(fingerprints(F.split("passage", " "), n), F.lit(0)))
    prints = passages.select(hash_of.alias("_hash"), offset.alias("_offset"), "passage")
    kept = words.select("_row", F.explode(fingerprints(F.col("_w"), n)).alias("_packed"))
    hash_of, place = _unpacked(F.col("_packed"))
    kept = kept.select("_row", hash_of.alias("_hash"), place.alias("_place"))
    joined = kept.join(broadcast_if_small(prints), "_hash").filter(F.col("_place") >= F.col("_offset"))
    return joined.select("_row", (F.col("_place") - F.col("_offset")).alias("start"), F.lit(n).alias("n"), "passage")


def _extended(per_row: DataFrame, words: DataFrame) -> DataFrame:
    """``_row`` and ``_sure``: the candidates whose whole window equals the row's words there."""
    rows = words.join(broadcast_if_small(per_row.select("_row")), "_row", "left_semi").dropDuplicates(["_row"])
    same = lambda m: F.concat_ws(" ", F.slice("_w", m["start"] + 1, m["n"])) == m["passage"]
    sure = rows.join(per_row, "_row").select("_row", F.filter("_met", same).alias("_sure"))
    return sure.filter(F.size("_sure") > 0)
