"""Run time as columns: every step of a run takes the same explicit ``run_ts``."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the envelope columns added to every landed row.
INGESTION_TIME = "_ingestion_time"
DAY_COLUMNS = ("year", "month", "day")

RunTime = datetime | Column


def run_column(run_ts: RunTime) -> Column:
    """``run_ts`` as UTC wall time, independent of session and machine time zones."""
    if isinstance(run_ts, Column):
        return run_ts
    if run_ts.tzinfo is not None:
        run_ts = run_ts.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz")


def day_parts(run_ts: RunTime) -> dict[str, Column]:
    """Year, zero-padded month and zero-padded day, all strings."""
    ts = run_column(run_ts)
    year, month, day = DAY_COLUMNS
    return {
        year: F.year(ts).cast("string"),
        month: F.lpad(F.month(ts).cast("string"), 2, "0"),
        day: F.lpad(F.dayofmonth(ts).cast("string"), 2, "0"),
    }


def day_folder(run_ts: datetime) -> str:
    """Relative folder of one ingest day."""
    if run_ts.tzinfo is not None:
        run_ts = run_ts.astimezone(timezone.utc)
    year, month, day = DAY_COLUMNS
    return f"{year}={run_ts.year}/{month}={run_ts.month:02d}/{day}={run_ts.day:02d}"
