"""Text files: lines in, values and key-TAB-value pairs out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, glob: str) -> DataFrame:
    """Lines of all matching files, in column ``value``; LF, CRLF and CR all end a line."""
    return spark.read.text(glob)


def save_pairs(df: DataFrame, path: str, key: str, value: str) -> None:
    """One ``key TAB value`` line per row; a path that exists is refused."""
    df.select(
        F.concat_ws("\t", F.col(key).cast("string"), F.col(value).cast("string")).alias("value")
    ).write.text(path)


def save_values(df: DataFrame, path: str, value: str = "value") -> None:
    """One line per non-empty value; the key is dropped, and a path that exists is refused."""
    df.filter(F.length(value) > 0).select(F.col(value).alias("value")).write.text(path)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first rows found, in no order; reads only as many partitions as it needs."""
    return df.limit(n)
