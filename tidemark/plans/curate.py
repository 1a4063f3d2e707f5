"""Silver: fold landed rows of one table into its curated table."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.config import LakeConfig
from tidemark.functions.scalars import resolve_keys
from tidemark.functions.stamps import day_folder
from tidemark.operators.control import CURATED, LANDED, advance_status
from tidemark.operators.rows import dedupe_latest
from tidemark.plans.ingest import Landed
from tidemark.plans.results import DONE, RunResult
from tidemark.session import remove, remove_scratch, write_scratch
from tidemark.sinks.bucketed import BucketedTable
from tidemark.sinks.catalog import CatalogTable
from tidemark.sinks.silver import (
    Staged,
    append_silver,
    apply,
    create_silver,
    overwrite_partitions,
    replace_silver,
    stage_merge,
)
from tidemark.sources.bronze import landed_days, read_bronze
from tidemark.sources.extract import FULL, checked_load_type
from tidemark.state import ControlTable


def curate(
    spark: SparkSession,
    cfg: LakeConfig,
    table: str,
    run_ts: datetime,
    full_mode: str = "partitions",
    dedupe_order: Sequence[Column | str] | None = None,
) -> RunResult:
    """Fold landed rows into Silver and move the status from landed to curated.

    Incremental tables take the day of ``run_ts`` and upsert it by their keys, or append
    it if they have none. Full tables take every landed day and replace the partitions
    found; days that Silver already holds unchanged are left as they are, with the same
    result. ``full_mode="replace"`` takes the run day alone as the whole table.
    ``dedupe_order`` keeps the first row per key of a batch that delivers keys twice.

    An upsert is staged, noted in the control table, and then applied. A run that finds such a note finishes
    that upsert first; if it was this day's, that is all there is to do.
    """
    if full_mode not in ("partitions", "replace"):
        raise ValueError(f"unknown full_mode: {full_mode!r}")
    state = ControlTable(spark, cfg.state_path)
    control = state.lookup(table)
    full = checked_load_type(control["load_type"]) == FULL
    keys = [] if full else control["keys"]
    run = run_ts.isoformat()

    def done(**changes: str | None) -> RunResult:
        moved = state.commit(
            [table],
            lambda df: advance_status(df, table, LANDED, CURATED),
            **{column: {table: value} for column, value in changes.items()},
        )
        return RunResult(DONE, (table,), moved)

    if control["pending"]:
        unfinished = json.loads(control["pending"])
        _apply(spark, cfg, table, control["silver"], unfinished)
        this_run = unfinished["run"] == run
        result = done(pending=None, folded=None) if this_run else None
        if not this_run:
            state.commit([table], pending={table: None}, folded={table: None})
            control = state.lookup(table)
        remove(spark, unfinished["path"])
        if result:
            return result

    every_day = full and full_mode == "partitions"
    bronze_path = cfg.bronze_path(table)
    folded = json.loads(control["folded"] or "{}")
    landed, days = {}, None
    if every_day and not cfg.silver_catalog:
        landed = landed_days(spark, bronze_path)
        days = [day for day in landed if folded.get(day) != landed[day]]
    known = Landed.of(control["landed"])
    schema = known.schema(None if every_day else day_folder(run_ts))
    batch = read_bronze(spark, bronze_path, schema, None if every_day else run_ts, days, known.every)
    keys = resolve_keys(keys, batch.columns)
    scratch: list[DataFrame] = []
    if keys and dedupe_order:
        batch = dedupe_latest(batch, keys, dedupe_order)
        if control["silver"] is not None or cfg.silver_catalog:
            # Written once, because a merge looks at its batch several times. A first load takes it as it comes.
            batch = write_scratch(batch, "deduped")
            scratch.append(batch)
    try:
        if cfg.silver_catalog:
            _fold_into_catalog(spark, cfg, table, batch, keys, full, full_mode == "replace")
            return done()
        root = cfg.silver_path(table)
        if control["silver"] is None:
            silver = create_silver(batch, root)
            return done(silver=silver.json(), folded=json.dumps(landed) if every_day else None)
        present = T.StructType.fromJson(json.loads(control["silver"]))
        if every_day:
            overwrite_partitions(batch, root, present, reads_table=False)
            return done(folded=json.dumps(landed))
        if full:
            replace_silver(batch, root, present)
        elif keys:
            staging = f"{cfg.staging_root}/{table}-{uuid.uuid4().hex[:12]}"
            table_now = spark.read.schema(present).parquet(root)
            pending = {**asdict(stage_merge(table_now, batch, present, keys, staging)), "run": run}
            state.commit([table], pending={table: json.dumps(pending)})
            _apply(spark, cfg, table, control["silver"], pending)
            result = done(pending=None, folded=None)
            remove(spark, staging)
            return result
        else:
            append_silver(batch, root, present)
        return done(folded=None)
    finally:
        remove_scratch(*scratch)


def _apply(spark: SparkSession, cfg: LakeConfig, table: str, schema: str, pending: dict) -> None:
    staged = Staged(pending["path"], tuple(pending["gone"]))
    apply(spark, staged, cfg.silver_path(table), T.StructType.fromJson(json.loads(schema)))


def _fold_into_catalog(
    spark: SparkSession,
    cfg: LakeConfig,
    table: str,
    batch: DataFrame,
    keys: list[str],
    full: bool,
    replace: bool,
) -> None:
    if cfg.silver_buckets:
        silver = BucketedTable(spark, cfg.silver_catalog, table, cfg.table_properties, keys, cfg.silver_buckets)
    else:
        silver = CatalogTable(spark, cfg.silver_catalog, table, cfg.table_properties)
    if not silver.exists():
        silver.create(batch)
    elif replace:
        silver.replace(batch)
    elif full:
        silver.overwrite_partitions(batch)
    elif keys:
        silver.merge(batch, keys)
    else:
        silver.append(batch)
