"""Changes to a curated table of plain Parquet, whole partitions at a time.

Spark replaces partitions by dynamic overwrite. What is to replace partitions that it was read from is written
aside first (:class:`Staged`) and read back, so that nothing is overwritten while it is read. Once staged, a change
no longer depends on the table, and :func:`apply` may be repeated after any failure with the same result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import all_nullable, all_set, name, names, resolve_keys
from tidemark.functions.stamps import DAY_COLUMNS
from tidemark.operators.merge import (
    N,
    MergeConflict,
    conform,
    key_counts,
    once_each,
    range_ends,
    range_filter,
    replace_rows,
    upsert,
)
from tidemark.session import delete, exists, remove, remove_scratch, scratch_path, write_scratch
from tidemark.sources.files import folder_marks, folder_of

PARTITION, FOLDER = "_partition", "_folder"

# Up to so many matched rows, a merge joins its batch; to find out if it needs to would take longer.
FEW = 1_000_000


@dataclass(frozen=True)
class Staged:
    """New partitions in a folder of their own, and the table's folders that no row is left in."""

    path: str
    gone: tuple[str, ...] = ()


def read_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The table as it is now. Partition filters prune folders."""
    return spark.read.schema(schema).parquet(root).select(*names(schema.names))


def create_silver(
    batch: DataFrame, root: str, partition_by: Sequence[str] = DAY_COLUMNS
) -> T.StructType:
    """A table that is exactly this batch; its schema, which is returned, is fixed from here on."""
    batch.write.mode("overwrite").partitionBy(*partition_by).parquet(root)
    return all_nullable(batch.schema)


def append_silver(
    batch: DataFrame, root: str, schema: T.StructType, partition_by: Sequence[str] = DAY_COLUMNS
) -> None:
    """Add the batch. Nothing that is there already is read or rewritten."""
    conform(batch, schema).write.mode("append").partitionBy(*partition_by).parquet(root)


def overwrite_partitions(
    batch: DataFrame,
    root: str,
    schema: T.StructType,
    partition_by: Sequence[str] = DAY_COLUMNS,
    *,
    reads_table: bool = True,
) -> None:
    """Replace the partitions that occur in the batch; the rest is kept as it lies.

    A batch that was not read from the table is written at once, others are staged.
    """
    batch = conform(batch, schema)
    if not reads_table:
        _overwrite(batch, root, partition_by)
        return
    staged = stage(batch, scratch_path(batch.sparkSession, "silver-partitions"), partition_by)
    apply(batch.sparkSession, staged, root, schema, partition_by)
    remove(batch.sparkSession, staged.path)


def replace_silver(
    batch: DataFrame, root: str, schema: T.StructType, partition_by: Sequence[str] = DAY_COLUMNS
) -> None:
    """The batch, not read from the table, becomes the whole table."""
    spark = batch.sparkSession
    before = folder_marks(spark, root)
    _overwrite(conform(batch, schema), root, partition_by)
    after = folder_marks(spark, root)
    for folder in before:
        if before[folder] == after.get(folder):
            delete(spark, folder)


def merge_silver(
    batch: DataFrame, root: str, schema: T.StructType, keys: Sequence[str], partition_by: Sequence[str] = DAY_COLUMNS
) -> None:
    """Upsert the batch by key."""
    spark = batch.sparkSession
    table = spark.read.schema(schema).parquet(root)
    staged = stage_merge(table, batch, schema, keys, scratch_path(spark, "silver-merge"), partition_by)
    apply(spark, staged, root, schema, partition_by)
    remove(spark, staged.path)


def stage(batch: DataFrame, path: str, partition_by: Sequence[str]) -> Staged:
    batch.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return Staged(path)


def stage_merge(
    table: DataFrame,
    batch: DataFrame,
    schema: T.StructType,
    keys: Sequence[str],
    path: str,
    partition_by: Sequence[str] = DAY_COLUMNS,
) -> Staged:
    """The partitions as an upsert of the batch by key leaves them; ``table`` is read from files.

    One pass over the table reads key columns alone, in the range of the batch's keys. Its hits, a fraction of the
    batch's size, are written to the shared scratch folder; they tell which partitions have a matched row,
    whether a key matches twice, and which batch rows are new. Those partitions and the ones that the batch's rows go
    to are read in full, the others are not opened. Updated rows move to the partition of their new values. Where many
    keys match and none twice, the batch's rows take the place of the matched ones without a join.
    Keys are found in the table's spelling. The driver holds a row per partition touched.
    """
    spark = batch.sparkSession
    batch = conform(batch, schema)
    keys = resolve_keys(keys, schema.names)
    here = partition_text(partition_by).alias(PARTITION)
    *ends, own = batch.agg(*range_ends(schema, keys), F.collect_set(here)).first()
    near = table.select(*names(keys), here, folder_of(F.col("_metadata.file_path")).alias(FOLDER)).filter(
        all_set(keys) & range_filter(schema, keys, ends)
    )
    hits = write_scratch(near.join(key_counts(batch, keys), list(keys)), "merge-hits")
    folders, matched = _matched(hits, keys)
    touched = partition_text(partition_by).isin(list({*own, *folders}))
    old = table.select(*names(schema.names)).filter(touched)
    found = hits.select(*names(keys))
    if matched > FEW and once_each(found, keys):
        rows = replace_rows(old, found, batch, keys)
    else:
        rows = upsert(old, batch, keys, found)
    # Cluster by partition to avoid a file per task and day; hot days are split by size.
    # (Without adaptive execution Spark ignores the hint: then there is a file per task and day.)
    # The writer sorts by partition anyway; keys next make row groups skippable by key.
    rows = rows.hint("rebalance", *names(partition_by)).sortWithinPartitions(*names([*partition_by, *keys]))
    stage(rows, path, partition_by)
    remove_scratch(hits)
    # Spark names a partition's folder alike everywhere, and encodes the paths of files.
    names_of = {folder: unquote("/".join(folder.split("/")[-len(partition_by) :])) for folder in folders.values()}
    return Staged(path, tuple(f for f, inner in names_of.items() if not exists(spark, f"{path}/{inner}")))


def _matched(hits: DataFrame, keys: Sequence[str]) -> tuple[dict[str, str], int]:
    """Partitions with a matched row and their folders, and the number of such rows.

    A key that matches and is twice in the batch is an error.
    """
    found = hits.groupBy(PARTITION).agg(
        F.max(FOLDER).alias(FOLDER),
        F.max(N).alias(N),
        F.max_by(F.struct(*names(keys)), name(N)).alias("key"),
        F.count(F.lit(1)).alias("rows"),
    )
    folders, matched = {}, 0
    for row in found.collect():
        if row[N] > 1:
            raise MergeConflict(f"several source rows match one target row: {row['key']}")
        folders[row[PARTITION]] = row[FOLDER]
        matched += row["rows"]
    return folders, matched


def apply(
    spark: SparkSession,
    staged: Staged,
    root: str,
    schema: T.StructType,
    partition_by: Sequence[str] = DAY_COLUMNS,
) -> None:
    """Put staged partitions into the table, then drop the folders that they leave empty."""
    _overwrite(read_table(spark, staged.path, schema), root, partition_by)
    for folder in staged.gone:
        delete(spark, folder)


def partition_text(partition_by: Sequence[str]) -> Column:
    """A row's partition as one text, with NULL apart from all values. Filters on it prune folders."""
    values = [F.concat(F.lit("="), name(c).cast("string")) for c in partition_by]
    return F.concat_ws("/", *[F.coalesce(v, F.lit("")) for v in values])


def _overwrite(rows: DataFrame, root: str, partition_by: Sequence[str]) -> None:
    writer = rows.write.mode("overwrite").partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "dynamic").parquet(root)
