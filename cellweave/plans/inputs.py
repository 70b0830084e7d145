"""The given tables as cells, mutations, conditional operations, messages and streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cellweave.plans.skew import HOT_ROWS, HotKeys, hot_keys
from cellweave.schema import (
    DELETE_ROW,
    INCREMENT,
    PUT,
    checks,
    delete_change,
    mutations,
    put_change,
    puts_from_wide,
)
from cellweave.session import scratch_path

# Steps of the event funnel: type, state it expects (None: no state yet).
FUNNEL = [("signup", None), ("view", "signup"), ("click", "view"), ("purchase", "click")]
STATE = ("funnel", "state")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as rows: name and segment in ``general``, nation in ``geo``."""
    return puts_from_wide(
        table(spark, sf_dir, "customer"),
        row_key=F.col("c_custkey"),
        values={
            ("general", "name"): F.col("c_name"),
            ("general", "segment"): F.col("c_mktsegment"),
            ("geo", "nation"): F.col("c_nationkey"),
        },
        ts=F.timestamp_millis(F.lit(0)),
        seq=F.lit(0),
    )


def document_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rows: text and language in ``general``, source in ``origin``."""
    return puts_from_wide(
        table(spark, sf_dir, "documents"),
        row_key=F.col("doc_id"),
        values={
            ("general", "text"): F.col("text"),
            ("general", "lang"): F.col("lang"),
            ("origin", ""): F.col("source"),
        },
        ts=F.timestamp_millis(F.lit(0)),
        seq=F.lit(0),
    )


def _event_columns(**columns: Column) -> dict[str, Column]:
    named = {
        "row_key": F.col("user_id"),
        "family": F.lit("events"),
        "qualifier": F.col("event_type"),
        "ts": F.col("ts"),
        "seq": F.col("event_id"),
    }
    return named | columns


def event_puts(events: DataFrame) -> DataFrame:
    return mutations(events, **_event_columns(op=F.lit(PUT), value=F.col("value")))


def event_deltas(events: DataFrame) -> DataFrame:
    """Each event adds its whole-number value to the counter of its type."""
    delta = F.floor("value")
    return mutations(events, **_event_columns(op=F.lit(INCREMENT), delta=delta))


def event_tombstones(events: DataFrame) -> DataFrame:
    """Errors delete the user's row; other events put."""
    error = F.col("event_type") == "error"
    cell = _event_columns(
        family=F.when(~error, F.lit("events")),
        qualifier=F.when(~error, F.col("event_type")),
        op=F.when(error, DELETE_ROW).otherwise(PUT),
        value=F.when(~error, F.col("value")),
    )
    return mutations(events, **cell)


def event_mix(events: DataFrame) -> DataFrame:
    """One counter per user: signup sets it to 100, error deletes it, others add 1."""
    kind = F.col("event_type")
    op = F.when(kind == "signup", PUT).when(kind == "error", DELETE_ROW).otherwise(INCREMENT)
    cell = _event_columns(
        family=F.when(kind != "error", "counters"),
        qualifier=F.when(kind != "error", "score"),
        op=op,
        value=F.when(kind == "signup", "100"),
        delta=F.when(op == INCREMENT, 1),
    )
    return mutations(events, **cell)


def event_checks(events: DataFrame, row_key: Column | None = None) -> DataFrame:
    """Funnel steps as check-and-put, errors as check-and-delete of a purchase.

    A step also stores its event as the row's last one.
    """
    kind = F.col("event_type")
    expected = F.when(kind == "error", "purchase")
    for step, before in FUNNEL:
        if before is not None:
            expected = expected.when(kind == step, before)
    step = F.array(
        put_change(*STATE, kind), put_change("funnel", "last", F.col("event_id"))
    )
    return checks(
        events,
        row_key=F.col("user_id") if row_key is None else row_key,
        chk_family=F.lit(STATE[0]),
        chk_qualifier=F.lit(STATE[1]),
        expected=expected,
        changes=F.when(kind == "error", F.array(delete_change(*STATE))).otherwise(step),
        ts=F.col("ts"),
        seq=F.col("event_id"),
    )


def message_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON messages, in column ``value``.

    German ones are delete notices. Only English ones have a place, and Spanish
    ones have no hashtags.
    """
    docs = table(spark, sf_dir, "documents")
    lang = F.col("lang")
    hashtags = F.array(
        F.struct(lang.alias("text")),
        F.struct(F.lit(None).cast("string").alias("text")),
        F.struct(F.col("source").alias("text")),
    )
    no_hashtags = F.filter(hashtags, lambda h: F.lit(False))
    message = F.to_json(
        F.struct(
            F.col("doc_id").alias("id"),
            F.col("doc_id").cast("string").alias("id_str"),
            "text",
            F.col("n_chars").cast("string").alias("timestamp_ms"),
            "lang",
            F.struct(
                F.col("n_chars").alias("id"), F.col("n_chars").cast("string").alias("id_str")
            ).alias("user"),
            F.when(lang == "en", F.struct(F.col("source").alias("country"))).alias("place"),
            F.struct(
                F.when(lang == "es", no_hashtags).otherwise(hashtags).alias("hashtags")
            ).alias("entities"),
        )
    )
    notice = F.to_json(F.struct(F.struct(F.col("doc_id").alias("id")).alias("delete")))
    return docs.select(F.when(lang == "de", notice).otherwise(message).alias("value"))


def weighed(df: DataFrame, key: str) -> HotKeys:
    """Heavy keys for a table of any size: a sixteenth of the rows is heavy in a small one."""
    rows = df.count()
    return hot_keys(df, key, min_rows=min(HOT_ROWS, max(1, rows // 16)))


def arriving_events(
    spark: SparkSession,
    sf_dir: str,
    folder: str,
    start: Callable[[DataFrame], StreamingQuery],
    parts: int = 4,
) -> None:
    """Let the events arrive in time order, and run a stream on what is new each time.

    Every run goes on from the checkpoint of the one before.
    """
    events = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    shares = [i / parts for i in range(1, parts)]
    cuts = events.agg(F.percentile_approx(micros, shares)).first()[0] or []
    bounds = [None, *cuts, None]
    for low, high in zip(bounds, bounds[1:]):
        part = events
        if low is not None:
            part = part.filter(micros >= low)
        if high is not None:
            part = part.filter(micros < high)
        part.write.mode("append").parquet(f"{folder}/source")
        start(spark.readStream.schema(events.schema).parquet(f"{folder}/source")).awaitTermination()


def scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)
