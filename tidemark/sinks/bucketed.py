"""Silver as Parquet tables of the session's catalog, bucketed by key.

Rows of one key are in one bucket of every day, in key order, so the key pass of a merge joins the table as it lies:
only the batch is shuffled. A merge stages the days it touches and inserts them over the old ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.scalars import names
from tidemark.functions.stamps import DAY_COLUMNS
from tidemark.operators.merge import conform
from tidemark.session import remove, scratch_path
from tidemark.sinks.catalog import CatalogTable
from tidemark.sinks.silver import read_table, stage_merge


class BucketedTable(CatalogTable):
    """A table partitioned by day. Without keys it has no buckets."""

    def __init__(
        self,
        spark: SparkSession,
        namespace: str,
        table: str,
        properties: Mapping[str, str] = MappingProxyType({}),
        keys: Sequence[str] = (),
        buckets: int = 64,
    ):
        super().__init__(spark, namespace, table, properties)
        self.keys = list(keys)
        self.buckets = buckets

    def create(self, batch: DataFrame, partition_by: Sequence[str] = DAY_COLUMNS) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.namespace}")
        writer = self._dealt(batch).write.format("parquet").partitionBy(*partition_by)
        if self.keys:
            writer = writer.bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        for key, value in self.properties.items():
            writer = writer.option(key, value)
        writer.saveAsTable(self.full_name)

    def append(self, batch: DataFrame) -> None:
        self._dealt(conform(batch, self.read().schema)).write.insertInto(self.full_name)

    def overwrite_partitions(self, batch: DataFrame) -> None:
        """Replace the days of the batch, which must not be read from this table."""
        with _overwriting(self.spark, "dynamic"):
            self._dealt(conform(batch, self.read().schema)).write.insertInto(self.full_name, overwrite=True)

    def replace(self, batch: DataFrame) -> None:
        """The batch, not read from this table, becomes the whole table."""
        with _overwriting(self.spark, "static"):
            self._dealt(conform(batch, self.read().schema)).write.insertInto(self.full_name, overwrite=True)

    def merge(self, batch: DataFrame, keys: Sequence[str]) -> None:
        """Upsert by key with the rules of :func:`tidemark.operators.merge.upsert`. Days left empty are dropped."""
        path = scratch_path(self.spark, "bucketed-merge")
        schema = self.read().schema
        staged = stage_merge(self.read(), batch, schema, keys, path)
        self.overwrite_partitions(read_table(self.spark, path, schema))
        for folder in staged.gone:
            values = (part.split("=") for part in folder.split("/")[-len(DAY_COLUMNS) :])
            spec = ", ".join(f"`{column}` = '{value}'" for column, value in values)
            self.spark.sql(f"ALTER TABLE {self.full_name} DROP IF EXISTS PARTITION ({spec})")
        remove(self.spark, path)

    def _dealt(self, batch: DataFrame) -> DataFrame:
        """The batch with one task per bucket, so that a bucket gets one file a day."""
        return batch.repartition(self.buckets, *names(self.keys)) if self.keys else batch


@contextmanager
def _overwriting(spark: SparkSession, mode: str) -> Iterator[None]:
    """Inserts into tables take this from the session only."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, mode)
    try:
        yield
    finally:
        spark.conf.set(setting, before)
