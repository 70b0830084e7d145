"""Column layouts of cells, mutations and conditional operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CELL_KEY = ["row_key", "family", "qualifier"]

PUT = "put"
INCREMENT = "increment"
DELETE_CELL = "delete_cell"
DELETE_FAMILY = "delete_family"
DELETE_ROW = "delete_row"


def record(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


CELL = record(
    row_key=T.StringType(),
    family=T.StringType(),
    qualifier=T.StringType(),
    value=T.StringType(),
    ts=T.TimestampType(),
    seq=T.LongType(),
)

# family is NULL for delete_row, qualifier is NULL for delete_row and
# delete_family; '' is a legal qualifier.
MUTATION = record(
    row_key=T.StringType(),
    family=T.StringType(),
    qualifier=T.StringType(),
    op=T.StringType(),
    value=T.StringType(),
    delta=T.LongType(),
    ts=T.TimestampType(),
    seq=T.LongType(),
)

# What a conditional operation does to its row once the check holds.
CHANGE = record(
    op=T.StringType(),
    family=T.StringType(),
    qualifier=T.StringType(),
    value=T.StringType(),
)

# A conditional operation checks one cell of a row; a NULL ``expected`` means
# that the cell must be absent. ``changes`` are all puts or all deletes, name no
# cell twice, and happen together.
CHECK = record(
    row_key=T.StringType(),
    chk_family=T.StringType(),
    chk_qualifier=T.StringType(),
    expected=T.StringType(),
    changes=T.ArrayType(CHANGE),
    ts=T.TimestampType(),
    seq=T.LongType(),
)

CELL_COLUMNS = CELL.fieldNames()
MUTATION_COLUMNS = MUTATION.fieldNames()
CHECK_COLUMNS = CHECK.fieldNames()


def conform(df: DataFrame, schema: T.StructType, **columns: Column) -> DataFrame:
    """Project to ``schema``: given expressions first, then columns of that name, else NULL."""
    present = set(df.columns)
    out = []
    for field in schema.fields:
        if field.name in columns:
            value = columns[field.name]
        elif field.name in present:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)


def cells(df: DataFrame, **columns: Column) -> DataFrame:
    return conform(df, CELL, **columns)


def mutations(df: DataFrame, **columns: Column) -> DataFrame:
    """The record-to-mutation mapping: name the expression of each mutation column."""
    return conform(df, MUTATION, **columns)


def checks(df: DataFrame, **columns: Column) -> DataFrame:
    return conform(df, CHECK, **columns)


def put_change(family: str, qualifier: str, value: Column) -> Column:
    return _change(PUT, family, qualifier, value)


def delete_change(family: str | None = None, qualifier: str | None = None) -> Column:
    """Delete a cell, a family (no qualifier) or the row (no family)."""
    op = DELETE_ROW if family is None else DELETE_FAMILY if qualifier is None else DELETE_CELL
    return _change(op, family, qualifier, F.lit(None))


def _change(op: str, family: str | None, qualifier: str | None, value: Column) -> Column:
    return F.struct(
        F.lit(op).alias("op"),
        F.lit(family).cast("string").alias("family"),
        F.lit(qualifier).cast("string").alias("qualifier"),
        value.cast("string").alias("value"),
    )


def puts_from_wide(
    df: DataFrame,
    row_key: Column,
    values: Mapping[tuple[str, str], Column],
    ts: Column,
    seq: Column,
) -> DataFrame:
    """One put per non-NULL value of a wide record, as a single narrow pass."""
    entries = F.array(
        *[
            F.struct(
                F.lit(family).alias("family"),
                F.lit(qualifier).alias("qualifier"),
                value.cast("string").alias("value"),
            )
            for (family, qualifier), value in values.items()
        ]
    )
    long = df.select(
        row_key.cast("string").alias("row_key"),
        ts.cast("timestamp").alias("ts"),
        seq.cast("long").alias("seq"),
        F.inline(entries),
    ).filter(F.col("value").isNotNull())
    return mutations(long, op=F.lit(PUT))


def as_puts(cell_rows: DataFrame) -> DataFrame:
    """Cells seen as the puts that would create them."""
    return mutations(cell_rows, op=F.lit(PUT))


def require_families(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Fail the job when a row names a family the table was not created with."""
    family = F.col("family")
    message = F.concat(F.lit("unknown column family: "), family)
    checked = F.when(family.isNull() | family.isin(list(allowed)), family).otherwise(
        F.raise_error(message).cast("string")
    )
    return df.withColumn("family", checked)
