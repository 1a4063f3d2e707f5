"""Staging copies in a database."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed value: prefix of staging table names.
STAGING_PREFIX = "stg_"


def stage_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 16,
    batch_size: int = 10_000,
) -> str:
    """Drop, recreate and fill ``stg_<table>`` from all tasks; returns that name.

    ``connections`` bounds how many tasks write to the database at once. Columns a
    database cannot take are refused before anything there is touched.
    """
    nested = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
    ]
    if nested:
        raise ValueError(f"nested columns cannot be staged over JDBC: {nested}")
    staging = f"{STAGING_PREFIX}{table}"
    (
        df.write.option("numPartitions", connections)
        .option("batchsize", batch_size)
        .jdbc(url, staging, mode="overwrite", properties=dict(properties or {}))
    )
    return staging
