"""Small helpers that several operators here use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from cellweave.session import scratch_path

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; every other character stays."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, so that its plan runs once and survives lost executors.

    The shuffles that made it are of no use any more, and are removed with the write's end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_saved(table: DataFrame) -> None:
    """Remove the files of a ``saved`` table that no later plan reads."""
    context = table.sparkSession.sparkContext
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def unused(name: str, df: DataFrame) -> str:
    """``name``, or a longer one that no column of ``df`` has in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def widened(df: DataFrame, **kinds: str | DataType) -> StructType:
    """The schema of ``df`` with further columns."""
    out = StructType(list(df.schema.fields))
    for name, kind in kinds.items():
        out = out.add(name, kind)
    return out
