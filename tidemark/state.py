"""The control table with what the jobs have to remember, as one small Parquet folder per commit.

``commit=<n>`` holds a row per table; the highest n that is complete is the state. A change reads it, applies a
transition, writes a folder of its own and renames it to ``commit=<n + 1>``. If that exists, another run was faster:
the change is applied again to what that run left, so that transitions which ask for a status never overwrite
one. A commit covers any number of tables and is seen whole or not at all. The last ``KEPT`` commits stay.

Renaming a folder is one step on HDFS and local disks. Where storage copies instead, a run that dies may leave a
commit without ``_SUCCESS``: as it may be at work still, others wait for it and then fail, and
:meth:`ControlTable.abandon` removes it. Two runs that copy at the same instant leave two files, and every later read is refused.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import split_keys
from tidemark.operators.control import (
    CONTROL_SCHEMA,
    CURATED,
    ControlError,
    control_lookup,
    only_row,
)
from tidemark.session import exists, names_in, remove, rename

# Schemas as JSON, the published folder, and what a repeated run needs to know.
REMEMBERED = ("landed", "silver", "folded", "pending", "gold")
STATE_SCHEMA = T.StructType([*CONTROL_SCHEMA.fields, *(T.StructField(c, T.StringType()) for c in REMEMBERED)])
KEPT = 20
ATTEMPTS = 50
PAUSE = 0.2  # seconds

Move = Callable[[DataFrame], DataFrame]


class ControlTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def current(self) -> DataFrame:
        """The rows of the latest complete commit."""
        return self._rows(self._last())

    def lookup(self, table: str) -> dict:
        """State of one table with its key columns as ``keys``; it must have one row."""
        found = control_lookup(self.current(), table)
        return only_row(found.withColumn("keys", split_keys(F.col("primary_keys"))), table)

    def ready(self, status: str = CURATED) -> list[dict]:
        """States of the tables at a status, by name; each must have one row."""
        rows = self.current().collect()  # one per managed table
        ready = {r.table_name for r in rows if r.process_number == status}
        found = sorted((r.asDict() for r in rows if r.table_name in ready), key=lambda r: r["table_name"])
        if len(found) > len(ready):
            raise ControlError(f"tables with more than one control row: {[r['table_name'] for r in found]}")
        return found

    def create(self, control: DataFrame) -> None:
        """Start the state of a new lake with its control rows."""
        rows = control.select(*CONTROL_SCHEMA.names, *(F.lit(None).cast("string").alias(c) for c in REMEMBERED))
        if not self._write(rows, 1):
            raise ControlError(f"a control table already exists at {self.path}")

    def register(self, control: DataFrame) -> None:
        """Add control rows, or replace those of known tables; what is remembered of them stays."""

        def put(rows: DataFrame) -> DataFrame:
            given = control.select(*CONTROL_SCHEMA.names)
            kept = rows.join(given, "table_name", "left_anti")
            known = rows.select("table_name", *REMEMBERED)
            return kept.unionByName(given.join(known, "table_name", "left"))

        self._replace(put)

    def commit(self, tables: Sequence[str], move: Move | None = None, **changes: Mapping[str, str | None]) -> int:
        """Change ``tables`` together; returns how many of them changed status.

        ``changes`` gives new values by table for any column, and ``move`` is the status transition.
        Both are applied to the state as it is when the commit succeeds.
        """
        mine = F.col("table_name").isin(list(tables))

        def change(rows: DataFrame) -> DataFrame:
            for column, values in changes.items():
                pairs = [F.lit(x).cast("string") for pair in values.items() for x in pair]
                known = F.col("table_name").isin(list(values))
                rows = rows.withColumn(
                    column, F.when(known, F.create_map(*pairs)[F.col("table_name")]).otherwise(F.col(column))
                )
            before = rows.withColumn("_before", F.col("process_number"))
            return move(before) if move else before

        return self._replace(change, mine & ~F.col("process_number").eqNullSafe(F.col("_before")))

    def abandon(self, n: int) -> None:
        """Remove a commit that a run left unfinished. Only while no run is at work."""
        if self._complete(n):
            raise ControlError(f"commit {n} is complete")
        remove(self.spark, self._folder(n))

    def _folder(self, n: int) -> str:
        return f"{self.path}/commit={n}"

    def _complete(self, n: int) -> bool:
        return "_SUCCESS" in names_in(self.spark, self._folder(n))

    def _last(self) -> int:
        """The latest complete commit. From listings, without a job."""
        commits = (name.split("=")[1] for name in names_in(self.spark, self.path) if name.startswith("commit="))
        for n in sorted(map(int, commits), reverse=True):
            if self._complete(n):
                return n
        raise ControlError(f"there is no control table at {self.path}")

    def _rows(self, n: int) -> DataFrame:
        files = [f for f in names_in(self.spark, self._folder(n)) if f.endswith(".parquet")]
        if len(files) > 1:
            raise ControlError(f"two runs wrote commit {n} at once: {files}")
        return self.spark.read.schema(STATE_SCHEMA).parquet(self._folder(n))

    def _replace(self, change: Move, counted: Column | None = None) -> int:
        """Commit what ``change`` makes of the rows; returns how many rows are ``counted``."""
        for _ in range(ATTEMPTS):
            last = self._last()
            seen = Observation()
            n = F.count_if(F.lit(False) if counted is None else counted)
            if self._write(change(self._rows(last)).observe(seen, n.alias("n")), last + 1):
                remove(self.spark, self._folder(last + 1 - KEPT))
                return seen.get["n"]
            time.sleep(PAUSE)
        raise ControlError(f"commit {last + 1} is being written by another run, or one that died left it: see abandon()")

    def _write(self, rows: DataFrame, n: int) -> bool:
        """Write a commit, unless it exists already. Of several that try at once, the first to rename its folder wins."""
        if exists(self.spark, self._folder(n)):
            return False
        own = f"{self.path}/writing-{uuid.uuid4().hex}"
        try:
            rows.select(*STATE_SCHEMA.names).coalesce(1).write.parquet(own)
            (file,) = (f for f in names_in(self.spark, own) if f.endswith(".parquet"))
            rename(self.spark, own, self._folder(n))
            # A folder that comes too late ends up inside the other one.
            won = exists(self.spark, f"{self._folder(n)}/{file}")
            if not won:
                remove(self.spark, f"{self._folder(n)}/{own.rsplit('/', 1)[1]}")
            return won
        finally:
            remove(self.spark, own)
