"""Writes to the date-partitioned Bronze layer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.functions.stamps import DAY_COLUMNS


def write_bronze(
    df: DataFrame, path: str, mode: str, partition_by: Sequence[str] = DAY_COLUMNS
) -> None:
    """Append files, or replace just the partitions that occur in ``df``.

    No shuffle: each task writes the rows it read. A run has one ingest day, so
    clustering by the partition columns would send the whole batch to one task.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown write mode: {mode!r}")
    writer = df.write.mode(mode).partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
