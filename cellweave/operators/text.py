"""Word counts and log totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.functions.text import is_blank, utf16_length, words
from cellweave.schema import PUT, mutations

WORD_FAMILY = "words"
WORD_QUALIFIER = "value"


def word_count(df: DataFrame, text: str = "text") -> DataFrame:
    """``(word, cnt)`` of all non-blank words.

    Words are counted within each task before the shuffle, so a frequent word
    costs one row per task. Catalyst moves the blank filter below the count.
    """
    each = df.select(F.explode(words(F.col(text))).alias("word"))
    counts = each.groupBy("word").agg(F.count("*").alias("cnt"))
    return counts.filter(~is_blank(F.col("word")))


def word_count_puts(counts: DataFrame, ts: Column, seq: Column | None = None) -> DataFrame:
    """Puts that store each count as decimal text under its word."""
    return mutations(
        counts,
        row_key=F.col("word"),
        family=F.lit(WORD_FAMILY),
        qualifier=F.lit(WORD_QUALIFIER),
        op=F.lit(PUT),
        value=F.col("cnt").cast("string"),
        ts=ts,
        seq=F.lit(0) if seq is None else seq,
    )


def line_lengths(lines: DataFrame, line: str = "value") -> DataFrame:
    return lines.select(utf16_length(F.col(line)).alias("length"))


def total_length(lines: DataFrame, line: str = "value") -> DataFrame:
    """One row with the summed line length; 0 for no lines."""
    total = F.coalesce(F.sum("length"), F.lit(0).cast("long"))
    return line_lengths(lines, line).agg(total.alias("total_length"))
