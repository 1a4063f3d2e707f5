"""Silver in a Spark catalog whose tables take row-level writes themselves."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import names
from tidemark.functions.stamps import DAY_COLUMNS


class CatalogTable:
    """Create, overwrite partitions, append and merge through the DataFrame writer."""

    def __init__(
        self,
        spark: SparkSession,
        namespace: str,
        table: str,
        properties: Mapping[str, str] = MappingProxyType({}),
    ):
        self.spark = spark
        self.properties = properties
        self.namespace = namespace
        self.full_name = f"{namespace}.`{table.replace('`', '``')}`"

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.full_name)

    def read(self) -> DataFrame:
        return self.spark.table(self.full_name)

    def create(self, batch: DataFrame, partition_by: Sequence[str] = DAY_COLUMNS) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.namespace}")
        writer = batch.writeTo(self.full_name).partitionedBy(*names(partition_by))
        for key, value in self.properties.items():
            writer = writer.tableProperty(key, value)
        writer.create()

    def append(self, batch: DataFrame) -> None:
        batch.writeTo(self.full_name).append()

    def overwrite_partitions(self, batch: DataFrame) -> None:
        batch.writeTo(self.full_name).overwritePartitions()

    def replace(self, batch: DataFrame) -> None:
        """The batch becomes the whole table."""
        batch.writeTo(self.full_name).overwrite(F.lit(True))

    def merge(self, batch: DataFrame, keys: Sequence[str]) -> None:
        """The engine's own ``MERGE``: it raises on a second match and skips NULL keys."""
        pairs = [
            F.col(f"{self.full_name}.`{key}`") == F.col(f"_batch.`{key}`") for key in keys
        ]
        (
            batch.alias("_batch")
            .mergeInto(self.full_name, reduce(lambda a, b: a & b, pairs))
            .whenMatched()
            .updateAll()
            .whenNotMatched()
            .insertAll()
            .merge()
        )
