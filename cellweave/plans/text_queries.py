"""Queries over text, log lines and JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.functions.events import has_keys
from cellweave.functions.text import ascii_only, from_bytes, to_bytes, utf16_length
from cellweave.operators.text import total_length, word_count, word_count_puts
from cellweave.operators.cells import latest
from cellweave.operators.mutations import put
from cellweave.plans.inputs import document_cells, message_lines, scratch, table
from cellweave.plans.skew import spread
from cellweave.schema import cells
from cellweave.sources.events import (
    REQUIRED_FIELDS,
    message_puts,
    parse_messages,
    sample,
    tracked,
)
from cellweave.sources.tables import append_cells, create_cell_table, read_cells
from cellweave.sources.text import preview, read_lines, save_pairs, save_values

TRACKED = "the,und,la que"
FIRST_RUN, SECOND_RUN = 1_000, 2_000


def _texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(table(spark, sf_dir, name).select("text"))


def count_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(_texts(spark, sf_dir, "documents"))


def count_words_in_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The word count over a table: read the text cell of each row, then count."""
    stored = document_cells(spark, sf_dir)
    text = stored.filter((F.col("family") == "general") & (F.col("qualifier") == "text"))
    return word_count(spread(text.select("value")), "value")


def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(count_words(spark, sf_dir).orderBy(F.desc("cnt"), "word"))


def word_count_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts stored twice as text: the second run overwrites, vanished words stay."""
    first = word_count(_texts(spark, sf_dir, "conversations"))
    second = word_count(_texts(spark, sf_dir, "documents"))
    name = "cellweave_" + scratch(spark, "words").rsplit("-", 1)[1]
    create_cell_table(spark, name, ["words"], scratch(spark, "words"))
    create_cell_table(spark, name, ["words"])
    append_cells(spark, name, word_count_puts(first, F.timestamp_millis(F.lit(FIRST_RUN))))
    append_cells(spark, name, word_count_puts(second, F.timestamp_millis(F.lit(SECOND_RUN))))
    return latest(read_cells(spark, name)).select("row_key", "family", "qualifier", "value")


def word_count_put(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as one bulk put of counts into the cells of an earlier count."""
    before = word_count_puts(
        word_count(_texts(spark, sf_dir, "conversations")), F.timestamp_millis(F.lit(FIRST_RUN))
    )
    after = word_count_puts(
        word_count(_texts(spark, sf_dir, "documents")), F.timestamp_millis(F.lit(SECOND_RUN))
    )
    return put(cells(before), cells(after)).select("row_key", "family", "qualifier", "value")


def log_total_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts written out as log files, read back by a glob and measured."""
    path = scratch(spark, "logs")
    _texts(spark, sf_dir, "documents").write.text(path)
    return total_length(read_lines(spark, f"{path}/*.txt"))


def text_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    restored = from_bytes(to_bytes(F.col("text")))
    return docs.select(
        "doc_id",
        utf16_length(F.col("text")).alias("utf16_units"),
        F.octet_length(to_bytes(F.col("text"))).cast("long").alias("bytes"),
        restored.eqNullSafe(F.col("text")).alias("restored"),
    )


def ascii_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", ascii_only(F.col("text")).alias("text_ascii"))


def ingest_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message cells: JSON parsed, required fields tested, fields projected to puts."""
    puts = message_puts(parse_messages(spread(message_lines(spark, sf_dir))))
    return puts.select("row_key", "family", "qualifier", "value", F.unix_millis("ts").alias("ts_ms"))


def json_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = message_lines(spark, sf_dir)
    kept = lines.filter(has_keys(F.col("value"), REQUIRED_FIELDS))
    return kept.select(F.get_json_object("value", "$.id_str").alias("id_str"))


def track_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return docs.filter(tracked(TRACKED)).select("doc_id")


def ingest_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracking inside the ingest, on the text as it came."""
    keep = tracked(TRACKED, text="m.text", lang="m.lang")
    messages = parse_messages(spread(message_lines(spark, sf_dir)), keep=keep)
    return messages.select("row_key", "lang", "country")


def stable_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return sample(docs, 0.25, "doc_id").select("doc_id")


def event_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return sample(events, 0.1, "event_id", languages=None)


def save_word_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts as key-TAB-value lines, read back; a word with line ends spans lines."""
    path = scratch(spark, "pairs")
    save_pairs(count_words(spark, sf_dir), path, "word", "cnt")
    return read_lines(spark, path)


def export_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-empty cell values as text, key dropped, read back line by line."""
    path = scratch(spark, "values")
    save_values(document_cells(spark, sf_dir), path)
    lines = read_lines(spark, path)
    return lines.groupBy("value").agg(F.count("*").alias("cnt"))


QUERIES = {
    "word_count": count_words,
    "word_count_cells": count_words_in_cells,
    "preview_top_words": top_words,
    "word_count_table": word_count_table,
    "word_count_put": word_count_put,
    "log_total_length": log_total_length,
    "text_lengths": text_lengths,
    "ascii_fold": ascii_fold,
    "ingest_messages": ingest_messages,
    "json_required": json_required,
    "track_lang": track_words,
    "ingest_tracked": ingest_tracked,
    "stable_sample": stable_sample,
    "event_sample": event_sample,
    "save_pairs": save_word_pairs,
    "export_values": export_values,
}


def _counts(source: str) -> str:
    return f"""
    SELECT word, count(*) AS cnt
    FROM (SELECT unnest(string_split(text, ' ')) AS word FROM {source})
    WHERE NOT regexp_full_match(word, '[\\x00-\\x20]*')
    GROUP BY word"""


_LINES = r"regexp_split_to_array({0}, '\r\n|\r|\n')"

_STORED_COUNTS = f"""
    SELECT coalesce(d.word, c.word) AS row_key, 'words' AS family, 'value' AS qualifier,
           CAST(coalesce(d.cnt, c.cnt) AS VARCHAR) AS value
    FROM ({_counts("documents")}) d FULL JOIN ({_counts("conversations")}) c ON d.word = c.word"""

# Tokens that match a tracked word: the word, its hashtag or its mention.
_TRACKS = r"""(list_has_any(tokens, ['the', '#the', '@the'])
           OR list_has_any(tokens, ['und', '#und', '@und'])
           OR (list_has_any(tokens, ['la', '#la', '@la'])
               AND list_has_any(tokens, ['que', '#que', '@que'])))"""
_TOKENS = r"regexp_split_to_array(lower(text), '[^\p{L}\p{N}_#@]+') AS tokens"

_SAMPLED = "CAST('0x' || substr(md5(CAST({0} AS VARCHAR)), 1, 8) AS BIGINT) < {1}"

ORACLES = {
    "word_count": _counts("documents"),
    "word_count_cells": _counts("documents"),
    "preview_top_words": _counts("documents") + " ORDER BY cnt DESC, word LIMIT 10",
    "word_count_table": _STORED_COUNTS,
    "word_count_put": _STORED_COUNTS,
    "log_total_length": rf"""
    SELECT CAST(coalesce(sum(length(l) + length(
               regexp_replace(l, '[^\x{{10000}}-\x{{10FFFF}}]', '', 'g'))), 0) AS BIGINT) AS total_length
    FROM (SELECT unnest({_LINES.format("text")}) AS l FROM documents)""",
    "text_lengths": r"""
    SELECT doc_id,
           length(text) + length(regexp_replace(text, '[^\x{10000}-\x{10FFFF}]', '', 'g')) AS utf16_units,
           strlen(text) AS bytes, true AS restored
    FROM documents""",
    "ascii_fold": r"""
    SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', '', 'g') AS text_ascii FROM documents""",
    "ingest_messages": r"""
    WITH m AS (
      SELECT CAST(doc_id AS VARCHAR) AS row_key, n_chars, lang,
             regexp_replace(text, '[^\x00-\x7F]', '', 'g') AS text,
             CASE WHEN lang = 'en' THEN source ELSE '' END AS country,
             CASE WHEN lang = 'es' THEN '' ELSE lang || ',,' || source END AS tags,
             n_chars AS ts_ms
      FROM documents WHERE lang <> 'de')
    SELECT row_key, 'general' AS family, 'text' AS qualifier, text AS value, ts_ms FROM m
    UNION ALL SELECT row_key, 'general', 'timestamp', CAST(n_chars AS VARCHAR), ts_ms FROM m
    UNION ALL SELECT row_key, 'general', 'user_id', CAST(n_chars AS VARCHAR), ts_ms FROM m
    UNION ALL SELECT row_key, 'general', 'lang', lang, ts_ms FROM m
    UNION ALL SELECT row_key, 'general', 'country', country, ts_ms FROM m
    UNION ALL SELECT row_key, 'hashtags', '', tags, ts_ms FROM m""",
    "json_required": "SELECT CAST(doc_id AS VARCHAR) AS id_str FROM documents WHERE lang <> 'de'",
    "track_lang": f"""
    SELECT doc_id FROM (SELECT doc_id, lang, {_TOKENS} FROM documents)
    WHERE lang IN ('en', 'es', 'he') AND {_TRACKS}""",
    "ingest_tracked": f"""
    SELECT CAST(doc_id AS VARCHAR) AS row_key, lang,
           CASE WHEN lang = 'en' THEN source ELSE '' END AS country
    FROM (SELECT doc_id, lang, source, {_TOKENS} FROM documents WHERE lang <> 'de')
    WHERE lang IN ('en', 'es', 'he') AND {_TRACKS}""",
    "stable_sample": f"""
    SELECT doc_id FROM documents
    WHERE lang IN ('en', 'es', 'he') AND {_SAMPLED.format("doc_id", round(0.25 * (1 << 32)))}""",
    "event_sample": f"""
    SELECT event_id, user_id FROM events
    WHERE {_SAMPLED.format("event_id", round(0.1 * (1 << 32)))}""",
    "save_pairs": f"""
    SELECT unnest({_LINES.format("word || chr(9) || CAST(cnt AS VARCHAR)")}) AS value
    FROM ({_counts("documents")})""",
    "export_values": f"""
    SELECT value, count(*) AS cnt FROM (
      SELECT unnest({_LINES.format("v")}) AS value
      FROM (SELECT unnest([text, lang, source]) AS v FROM documents) WHERE length(v) > 0)
    GROUP BY value""",
}
