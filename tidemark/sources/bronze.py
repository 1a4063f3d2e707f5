"""Reads of the date-partitioned Bronze layer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.functions.stamps import DAY_COLUMNS, day_folder, day_parts
from tidemark.operators.rows import day_slice
from tidemark.session import exists
from tidemark.sources.files import folder_marks


def text_partitions(
    schema: T.StructType, partition_by: Sequence[str] = DAY_COLUMNS
) -> T.StructType:
    """The schema with string partition columns, so that ``'01'`` stays ``'01'``."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType()) if f.name in partition_by else f
            for f in schema.fields
        ]
    )


def landed_schema(spark: SparkSession, path: str, paths: Sequence[str]) -> T.StructType:
    """The schema of all files below ``paths``, not of a sampled one.

    A column that only some files have is part of it, so that it can't get lost.
    """
    return _reader(spark, path).option("mergeSchema", "true").parquet(*paths).schema


def _reader(spark: SparkSession, path: str):
    return spark.read.option("basePath", path)


def read_bronze(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    run_ts: datetime | None = None,
    days: Sequence[str] | None = None,
    known: T.StructType | None = None,
) -> DataFrame:
    """Every landed day, the day of ``run_ts``, or some ``days`` given by folder.

    Days are opened by their own folders, so that the file listing does not grow
    with the age of the table. A day without data gives an empty result. Files are opened to
    learn their schema only if it is not given; ``known`` is that of a day without data.
    """
    if run_ts is not None:
        folder = f"{path}/{day_folder(run_ts)}"
        if not exists(spark, folder):
            return day_slice(read_bronze(spark, path, schema or known, days=[] if known else None), run_ts)
        if schema is None:
            schema = landed_schema(spark, path, [folder])
        day = _reader(spark, path).schema(text_partitions(schema)).parquet(folder)
        # As literals, the day parts need no sort when the slice is written again.
        return day_slice(day, run_ts).withColumns(day_parts(run_ts))
    paths = [path] if days is None else [f"{path}/{day}" for day in days]
    if schema is None:
        schema = landed_schema(spark, path, paths or [path])
    schema = text_partitions(schema)
    if not paths:
        return spark.createDataFrame([], schema)
    return _reader(spark, path).schema(schema).parquet(*paths)


def landed_days(spark: SparkSession, path: str) -> dict[str, str]:
    """Every landed day by its folder, with a mark that changes when its files change; see :func:`folder_marks`."""
    depth = -len(DAY_COLUMNS)
    return {"/".join(folder.split("/")[depth:]): mark for folder, mark in folder_marks(spark, path).items()}
