"""A corpus pipeline: toxicity, near duplicates, benchmark decontamination, secrets, piece ids.

Each stage takes the documents that its predecessor kept, and all but the last
return documents. Written as Parquet between stages, so that a stage can be run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm import bag_minhash, decontaminate, piece_codec, secret_scan, toxicity
from cellweave.llm.queries import TOKENIZERS, held_out
from cellweave.llm.shared import saved
from cellweave.plans.inputs import table
from cellweave.session import ship_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half."""
    ship_package(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out(5, 0)))
    return toxicity.score(docs, model).filter("score < 0.5").drop("score")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least id."""
    ship_package(spark)
    return bag_minhash.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by the name of their kind."""
    ship_package(spark)
    files = docs.select(F.col("doc_id").alias("path"), F.col("text").alias("content"))
    ledger = saved(secret_scan.scan_new(files), "secret-ledger")
    clean = secret_scan.redacted(docs, ledger)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document, and whether they decode to its text (NULL: empty)."""
    ship_package(spark)
    model = f"{TOKENIZERS}/piece_bpe_32k.model"
    back = piece_codec.round_trips(docs, model)
    return back.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("piece ids", to_pieces),
]

# Training, signatures and piece ids are not for SQL; tests hold the pipeline against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
