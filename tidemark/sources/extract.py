"""Full and incremental extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import UNSET, name, strict_literal

FULL = "FULL"
INCREMENTAL = "INCREMENTAL"


def is_unset(value: str | None) -> bool:
    """NULL, empty and the literal text ``None`` all mean that nothing is set."""
    return value is None or value in UNSET


def checked_load_type(value: str | None) -> str:
    """``FULL`` or ``INCREMENTAL`` in any case, untrimmed; anything else is an error."""
    load_type = str(value).upper()
    if load_type not in (FULL, INCREMENTAL):
        raise ValueError(f"unknown load_type: {value!r}")
    return load_type


def extract_full(spark: SparkSession, source, table: str, keys: Sequence[str] = ()) -> DataFrame:
    """The whole source table. A source may split its read by the keys."""
    return source.read(spark, table, keys=keys)


def extract_first_run(spark: SparkSession, source, table: str, keys: Sequence[str] = ()) -> DataFrame:
    """An incremental table that has no mark yet: everything, landed as an append."""
    return source.read(spark, table, keys=keys)


def extract_incremental(
    spark: SparkSession, source, table: str, dt_column: str, mark: str
) -> DataFrame:
    """Rows strictly above the mark. Rows equal to it, and NULL rows, are not taken."""
    df = source.read(spark, table, after=(dt_column, mark))
    dtype = df.select(name(dt_column)).schema[0].dataType
    bound = strict_literal(mark, dtype, f"high-water mark of {table}")
    return df.filter(name(dt_column) > bound)


def extract(spark: SparkSession, source, control: dict) -> tuple[DataFrame, str]:
    """The extract that a control row asks for, and the mode to land it with.

    ``keys`` of the row, if it has them, are the table's key columns.
    """
    table, keys = control["table_name"], control.get("keys") or ()
    if checked_load_type(control["load_type"]) == FULL:
        return extract_full(spark, source, table, keys), "overwrite"
    mark, dt_column = control["ingest_column"], control["source_dt_col"]
    if is_unset(mark):
        return extract_first_run(spark, source, table, keys), "append"
    if is_unset(dt_column):
        raise ValueError(f"{table} has a mark but no source_dt_col to compare it with")
    return extract_incremental(spark, source, table, dt_column, mark), "append"


def is_empty(df: DataFrame) -> bool:
    """True if there is no row; looks at one row at most."""
    return df.isEmpty()


def next_watermark(batch: DataFrame, dt_column: str) -> DataFrame:
    """The highest value in the batch, as the mark to use next; NULL if it is empty."""
    return batch.agg(F.max(name(dt_column)).alias("next_mark"))
