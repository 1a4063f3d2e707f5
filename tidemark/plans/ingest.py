"""Bronze: extract one table and land it under the run day."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import LakeConfig
from tidemark.functions.scalars import all_nullable, merged_schema, name, resolve
from tidemark.functions.stamps import day_folder
from tidemark.operators.control import IDLE, LANDED, advance_status
from tidemark.operators.rows import enrich
from tidemark.plans.results import DONE, EMPTY, RunResult
from tidemark.sinks.bronze import write_bronze
from tidemark.sources.extract import extract
from tidemark.state import ControlTable


def ingest(spark: SparkSession, cfg: LakeConfig, table: str, run_ts: datetime) -> RunResult:
    """Land one table and move its status from idle to landed.

    The source is read once: row count and highest source time are observed while the
    rows are written. Without rows no data file appears and the status stays. The stored
    mark is not advanced; ``next_mark`` is the value to use, and the caller applies it. The
    schema that was landed is remembered, so that no later step opens files to learn it.
    """
    state = ControlTable(spark, cfg.state_path)
    control = state.lookup(table)
    rows, mode = extract(spark, cfg.source, control)

    dt_column = resolve(control["source_dt_col"] or "", rows.columns)
    newest = F.max(name(dt_column)) if dt_column else F.lit(None)
    seen = Observation()
    observed = rows.observe(
        seen, F.count(F.lit(1)).alias("rows"), newest.cast("string").alias("next_mark")
    )
    batch = enrich(observed, run_ts)
    write_bronze(batch, cfg.bronze_path(table), mode)

    written = seen.get
    if not written["rows"]:
        return RunResult(EMPTY, (table,), rows=0)
    landed = Landed.of(control["landed"]).with_batch(day_folder(run_ts), batch.schema, mode)
    moved = state.commit(
        [table], lambda df: advance_status(df, table, IDLE, LANDED), landed={table: landed.to_json()}
    )
    return RunResult(DONE, (table,), moved, written["rows"], written["next_mark"])


class Landed:
    """The schema of all landed files, and of those of the last day."""

    def __init__(self, every: T.StructType | None = None, day: str = "", last: T.StructType | None = None):
        self.every, self.day, self.last = every, day, last

    @classmethod
    def of(cls, text: str | None) -> Landed:
        if text is None:
            return cls()
        value = json.loads(text)
        return cls(T.StructType.fromJson(value["every"]), value["day"], T.StructType.fromJson(value["last"]))

    def with_batch(self, day: str, schema: T.StructType, mode: str) -> Landed:
        """What is known after a batch of a day, which an overwrite replaces."""
        schema = all_nullable(schema)
        every = merged_schema(self.every, schema) if self.every else schema
        same_day = self.last and self.day == day and mode == "append"
        return Landed(every, day, merged_schema(self.last, schema) if same_day else schema)

    def schema(self, day: str | None) -> T.StructType | None:
        """The schema of one day's files, or of all; None if it is not known."""
        if day is None:
            return self.every
        return self.last if self.day == day else None

    def to_json(self) -> str:
        return json.dumps({"every": self.every.jsonValue(), "day": self.day, "last": self.last.jsonValue()})
