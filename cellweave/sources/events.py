"""JSON message streams: read, require fields, track, sample and project."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellweave.functions.events import in_sample, millis_timestamp, parsed_with_keys, tracks
from cellweave.functions.text import ascii_only, join_texts, or_empty
from cellweave.schema import puts_from_wide, record

# The fields a message must have, the languages of a feed, and
# the cells a message is stored in.
REQUIRED_FIELDS = ["id", "text", "timestamp_ms", "user"]
LANGUAGES = ["en", "es", "he"]
GENERAL = "general"
HASHTAGS = "hashtags"

MESSAGE = record(
    id=T.LongType(),
    id_str=T.StringType(),
    text=T.StringType(),
    timestamp_ms=T.StringType(),
    lang=T.StringType(),
    user=record(id=T.LongType(), id_str=T.StringType()),
    place=record(country=T.StringType()),
    entities=record(hashtags=T.ArrayType(record(text=T.StringType()))),
)


def read_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """New lines of the files that arrive in a folder, in column ``value``."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def parse_messages(
    lines: DataFrame, line: str = "value", keep: Column | None = None
) -> DataFrame:
    """Messages with all required fields, projected to one flat record each.

    Other messages and malformed lines are skipped. Text, country and hashtags
    keep only ASCII and are empty when missing. ``keep`` is a condition on the
    message ``m`` as it came, such as ``tracked(phrases, text="m.text", lang="m.lang")``.
    """
    kept = lines.select(F.explode(parsed_with_keys(F.col(line), MESSAGE, REQUIRED_FIELDS)).alias("m"))
    if keep is not None:
        kept = kept.filter(keep)
    hashtags = F.transform("m.entities.hashtags.text", lambda t: ascii_only(or_empty(t)))
    no_hashtags = F.array().cast("array<string>")
    return kept.select(
        F.coalesce("m.id_str", F.col("m.id").cast("string")).alias("row_key"),
        F.col("m.id").alias("id"),
        ascii_only(or_empty(F.col("m.text"))).alias("text"),
        F.col("m.timestamp_ms").alias("timestamp_ms"),
        millis_timestamp(F.col("m.timestamp_ms")).alias("ts"),
        F.col("m.user.id_str").alias("user_id"),
        F.col("m.lang").alias("lang"),
        ascii_only(or_empty(F.col("m.place.country"))).alias("country"),
        F.coalesce(hashtags, no_hashtags).alias("hashtags"),
    )


def tracked(
    phrases: Sequence[str] | str,
    languages: Sequence[str] = LANGUAGES,
    text: str = "text",
    lang: str = "lang",
) -> Column:
    """True for messages in the languages that match a phrase; a string is split at commas."""
    if isinstance(phrases, str):
        phrases = phrases.split(",")
    return F.col(lang).isin(list(languages)) & tracks(F.col(text), phrases)


def sample(
    messages: DataFrame,
    fraction: float,
    key: str,
    languages: Sequence[str] | None = LANGUAGES,
    lang: str = "lang",
) -> DataFrame:
    """A stable share of the messages, in batch and in streams alike."""
    if languages is not None:
        messages = messages.filter(F.col(lang).isin(list(languages)))
    return messages.filter(in_sample(F.col(key), fraction))


def message_puts(messages: DataFrame) -> DataFrame:
    """Puts that store each message as a row; a missing field leaves no cell."""
    return puts_from_wide(
        messages,
        row_key=F.col("row_key"),
        values={
            (GENERAL, "text"): F.col("text"),
            (GENERAL, "timestamp"): F.col("timestamp_ms"),
            (GENERAL, "user_id"): F.col("user_id"),
            (GENERAL, "lang"): F.col("lang"),
            (GENERAL, "country"): F.col("country"),
            (HASHTAGS, ""): join_texts(F.col("hashtags")),
        },
        ts=F.col("ts"),
        seq=F.col("id"),
    )
