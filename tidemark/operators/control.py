"""Operators over the control table: one row per managed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import split_keys

# Control columns and the states a table passes through in one run.
CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("load_type", T.StringType()),
        T.StructField("ingest_column", T.StringType()),
        T.StructField("source_dt_col", T.StringType()),
        T.StructField("primary_keys", T.StringType()),
        T.StructField("process_number", T.StringType()),
    ]
)
IDLE, LANDED, CURATED = "00", "01", "02"


class ControlError(ValueError):
    """The control table does not say clearly what to do."""


def control_lookup(control: DataFrame, table: str) -> DataFrame:
    """The row of one table, its load type in upper case."""
    return control.filter(F.col("table_name") == F.lit(table)).withColumn(
        "load_type", F.upper("load_type")
    )


def only_row(found: DataFrame, table: str) -> dict:
    """The one row of a lookup; none or several are errors."""
    rows = found.limit(2).collect()
    if not rows:
        raise ControlError(f"table {table!r} is not in the control table")
    if len(rows) > 1:
        raise ControlError(f"table {table!r} has more than one control row")
    return rows[0].asDict(recursive=True)


def control_ready(control: DataFrame, status: str = CURATED) -> DataFrame:
    """Names of all tables at a status."""
    return control.filter(F.col("process_number") == F.lit(status)).select("table_name")


def key_list(control: DataFrame) -> DataFrame:
    """One row per key column of each table, in the order given, counted from 1."""
    keys = split_keys(F.col("primary_keys"))
    return control.select("table_name", F.posexplode(keys).alias("pos", "key_col")).select(
        "table_name", (F.col("pos") + 1).alias("pos"), "key_col"
    )


def _move(control: DataFrame, hit: Column, current: str, new: str) -> DataFrame:
    status = F.col("process_number")
    return control.withColumn(
        "process_number", F.when(hit & (status == F.lit(current)), new).otherwise(status)
    )


def advance_status(control: DataFrame, table: str, current: str, new: str) -> DataFrame:
    """Move one table from ``current`` to ``new``; any other status is left alone."""
    return _move(control, F.col("table_name") == F.lit(table), current, new)


def reset_status(
    control: DataFrame,
    tables: Sequence[str] | DataFrame,
    current: str = CURATED,
    new: str = IDLE,
) -> DataFrame:
    """Move the tables of a batch back, where they still are at ``current``.

    ``tables`` is a list of names, or a DataFrame with ``table_name`` for long batches.
    """
    if isinstance(tables, DataFrame):
        batch = tables.select("table_name").distinct().withColumn("_hit", F.lit(True))
        marked = control.join(batch, "table_name", "left")
        moved = _move(marked, F.col("_hit").isNotNull(), current, new)
        return moved.select(*control.columns)
    return _move(control, F.col("table_name").isin(list(tables)), current, new)
