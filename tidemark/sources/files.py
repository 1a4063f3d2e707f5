"""Listings of data files: one row per file, whatever the files hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, name, length of each Parquet file below some folders.

    No file is opened: only columns of the listing are read. Paths are as Spark wrote them.
    """
    if not paths:
        return spark.createDataFrame([], "path string, name string, length long")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = reader.option("pathGlobFilter", "*.parquet").load(list(paths))
    return files.select(
        "path",
        F.substring_index("path", "/", -1).alias("name"),
        "length",
    )


def folder_of(path: Column) -> Column:
    """The folder of a file given by its path."""
    return F.regexp_replace(path, "/[^/]*$", "")


def folder_marks(spark: SparkSession, root: str) -> dict[str, str]:
    """Every folder with files below ``root``, with a mark that changes when its files change.

    Names are unique to the job that wrote the file, so the same names are the same files.
    """
    mark = F.concat_ws("-", F.count(F.lit(1)), F.sum("length"), F.bit_xor(F.xxhash64("name")))
    folders = list_files(spark, [root]).groupBy(folder_of(F.col("path")).alias("folder")).agg(mark.alias("mark"))
    return {row.folder: row.mark for row in folders.collect()}
