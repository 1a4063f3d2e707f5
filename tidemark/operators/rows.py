"""Row-level operators: the envelope, the day slice, and latest-per-key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import name, names, split_by_null_key
from tidemark.functions.stamps import INGESTION_TIME, RunTime, day_parts, run_column


def enrich(df: DataFrame, run_ts: RunTime) -> DataFrame:
    """Add the ingest time and its year, month and day."""
    return df.withColumns({INGESTION_TIME: run_column(run_ts), **day_parts(run_ts)})


def day_slice(df: DataFrame, run_ts: RunTime) -> DataFrame:
    """Rows of one ingest day. All three parts are partition columns, so files prune."""
    for column, value in day_parts(run_ts).items():
        df = df.filter(F.col(column) == value)
    return df


def dedupe_latest(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """One row per key, the first in ``order``; a total order makes the result stable.

    Keeping rank 1 lets Spark drop the rest of a key before the shuffle, so a hot key
    costs one row per task. Rows with a NULL key part equal nothing and all stay.
    """
    keyed, unkeyed = split_by_null_key(df, keys)
    first = Window.partitionBy(*names(keys)).orderBy(
        *[name(o) if isinstance(o, str) else o for o in order]
    )
    ranked = keyed.withColumn("_rank", F.row_number().over(first))
    return ranked.filter(F.col("_rank") == 1).drop("_rank").unionByName(unkeyed)
