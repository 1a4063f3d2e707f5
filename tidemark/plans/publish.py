"""Gold: publish every finished table of a run together."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.config import LakeConfig
from tidemark.functions.scalars import all_nullable
from tidemark.functions.stamps import DAY_COLUMNS
from tidemark.operators.control import reset_status
from tidemark.plans.results import DONE, EMPTY, RunResult
from tidemark.sinks.catalog import CatalogTable
from tidemark.sinks.jdbc import stage_jdbc
from tidemark.sinks.silver import read_table
from tidemark.state import ControlTable


def read_silver(spark: SparkSession, cfg: LakeConfig, table: str) -> DataFrame:
    """The curated table as it is now."""
    return _silver(spark, cfg, ControlTable(spark, cfg.state_path).lookup(table))


def _silver(spark: SparkSession, cfg: LakeConfig, row: dict) -> DataFrame:
    table = row["table_name"]
    if cfg.silver_catalog:
        return CatalogTable(spark, cfg.silver_catalog, table).read()
    if row["silver"] is None:
        raise ValueError(f"table {table!r} has no Silver data, no data in this layer yet")
    return read_table(spark, cfg.silver_path(table), T.StructType.fromJson(json.loads(row["silver"])))


def read_gold(spark: SparkSession, cfg: LakeConfig, table: str) -> DataFrame:
    """The table as last published."""
    row = ControlTable(spark, cfg.state_path).lookup(table)
    if row["gold"] is None:
        raise ValueError(f"table {table!r} has no data in this layer yet")
    return read_version(spark, cfg, table, row["gold"])


def read_version(spark: SparkSession, cfg: LakeConfig, table: str, version: str) -> DataFrame:
    """What :func:`stage_gold` wrote."""
    known = json.loads(version)
    return read_table(spark, f"{cfg.gold_path(table)}/{known['folder']}", T.StructType.fromJson(known["schema"]))


def stage_gold(spark: SparkSession, cfg: LakeConfig, row: dict) -> str:
    """Copy one Silver table into a version folder of its own, unseen by readers until a commit.

    Returns the folder and the schema as text. Without a shuffle: each task writes what it read.
    """
    table = row["table_name"]
    rows = _silver(spark, cfg, row)
    folder = f"version={uuid.uuid4().hex[:16]}"
    rows.write.partitionBy(*DAY_COLUMNS).parquet(f"{cfg.gold_path(table)}/{folder}")
    return json.dumps({"folder": folder, "schema": all_nullable(rows.schema).jsonValue()})


def publish_ready(spark: SparkSession, cfg: LakeConfig, parallel: int = 4) -> RunResult:
    """Stage every curated table, then show all of them and reset their status in one commit.

    ``parallel`` tables are staged at a time, so small ones do not leave the cluster
    idle. If one fails, nothing is published and no status changes. Earlier versions stay for
    those who read them, until the user removes them.
    """
    state = ControlTable(spark, cfg.state_path)
    rows = state.ready()
    if not rows:
        return RunResult(EMPTY, ())
    stage = inheritable_thread_target(spark)(lambda row: stage_gold(spark, cfg, row))
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        versions = list(pool.map(stage, rows))
    tables = [row["table_name"] for row in rows]
    gold = dict(zip(tables, versions, strict=True))
    moved = state.commit(tables, lambda df: reset_status(df, tables), gold=gold)
    return RunResult(DONE, tuple(tables), moved)


def stage_ready(
    spark: SparkSession,
    cfg: LakeConfig,
    url: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 16,
) -> dict[str, str]:
    """Copy every curated table into its staging table of a database.

    Returns staging names by table. The swap is the database's own DDL and stays with
    the caller; statuses are not touched.
    """
    return {
        row["table_name"]: stage_jdbc(_silver(spark, cfg, row), url, row["table_name"], properties, connections)
        for row in ControlTable(spark, cfg.state_path).ready()
    }
