"""Whole runs; most rules only show on the second one."""

from __future__ import annotations

import json
import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import DAY_1, DAY_2, at, data_files, rows
from tidemark import curate, ingest, publish_ready, read_gold, read_silver
from tidemark.operators.control import CONTROL_SCHEMA, ControlError
from tidemark.operators.merge import MergeConflict
from tidemark.operators.rows import enrich
from tidemark.plans.results import DONE, EMPTY
from tidemark.session import shared_root
from tidemark.sinks.bronze import write_bronze
from tidemark.sinks.silver import read_table
from tidemark.sources import bronze as bronze_module
from tidemark.sources.bronze import read_bronze

curate_module = sys.modules["tidemark.plans.curate"]
publish_module = sys.modules["tidemark.plans.publish"]

EVENTS = ("events", "INCREMENTAL", None, "ts", "event_id", "00")
CUSTOMER = ("customer", "full", None, None, "c_custkey", "00")


def run(lake, table, frame, run_ts, **options):
    cfg = lake.showing(**{table: frame})
    first = ingest(lake.spark, cfg, table, run_ts)
    return first, curate(lake.spark, cfg, table, run_ts, **options)


def test_statuses_follow_the_run(spark, lake, load):
    lake.create(EVENTS)
    cfg = lake.showing(events=load("events"))
    landed = ingest(spark, cfg, "events", DAY_1)
    assert (landed.outcome, landed.moved, landed.rows) == (DONE, 1, 1000)
    assert lake.status("events") == "01"
    assert curate(spark, cfg, "events", DAY_1).moved == 1
    assert lake.status("events") == "02"
    assert publish_ready(spark, cfg).moved == 1
    assert lake.status("events") == "00"
    assert publish_ready(spark, cfg).outcome == EMPTY


def test_next_mark_is_reported_and_the_stored_one_stays(spark, lake, load):
    events = load("events")
    lake.create(EVENTS)
    newest = events.agg(F.max("ts").cast("string")).first()[0]
    result = ingest(spark, lake.showing(events=events), "events", DAY_1)
    assert result.next_mark == newest
    assert lake.state.lookup("events")["ingest_column"] is None
    lake.set("events", ingest_column=result.next_mark)
    assert ingest(spark, lake.cfg, "events", DAY_2).outcome == EMPTY


def test_empty_extract_writes_nothing_and_keeps_the_status(spark, lake, load):
    lake.create(EVENTS)
    cfg = lake.showing(events=load("events").filter("event_id < 0"))
    result = ingest(spark, cfg, "events", DAY_1)
    assert (result.outcome, result.moved, result.rows) == (EMPTY, 0, 0)
    assert lake.status("events") == "00"
    assert data_files(cfg.bronze_path("events")) == {}


def test_unregistered_table_fails_before_any_write(spark, lake, load):
    lake.create(EVENTS)
    cfg = lake.showing(nation=load("nation"))
    for job in (ingest, curate):
        with pytest.raises(ControlError):
            job(spark, cfg, "nation", DAY_1)
    assert data_files(cfg.bronze_root) == {}


def test_unknown_load_type_fails_before_any_write(spark, lake, load):
    lake.create(("nation", "delta", None, None, None, "01"))
    cfg = lake.showing(nation=load("nation"))
    for job in (ingest, curate):
        with pytest.raises(ValueError, match="unknown load_type"):
            job(spark, cfg, "nation", DAY_1)
    assert data_files(cfg.bronze_root) == {} == data_files(cfg.silver_root)
    assert lake.status("nation") == "01"


def test_status_moves_only_from_the_expected_one(spark, lake, load):
    lake.create((*EVENTS[:5], "02"))
    cfg = lake.showing(events=load("events"))
    assert ingest(spark, cfg, "events", DAY_1).moved == 0
    assert curate(spark, cfg, "events", DAY_1).moved == 0
    assert lake.status("events") == "02"
    assert read_silver(spark, cfg, "events").count() == 1000


def test_a_day_without_landed_rows_still_advances(spark, lake, load):
    lake.create(EVENTS)
    cfg = lake.showing(events=load("events"))
    ingest(spark, cfg, "events", DAY_1)
    assert curate(spark, cfg, "events", DAY_2).moved == 1
    assert read_silver(spark, cfg, "events").isEmpty()


def test_repeated_extract_of_a_day(spark, lake, load):
    """Landed twice on one day: a conflict, unless the latest row per key is asked for."""
    events = load("events")
    lake.create(EVENTS)
    run(lake, "events", events, DAY_1)
    ingest(spark, lake.cfg, "events", DAY_2)
    ingest(spark, lake.cfg, "events", DAY_2.replace(hour=4))
    assert read_bronze(spark, lake.cfg.bronze_path("events"), run_ts=DAY_2).count() == 2000
    with pytest.raises(MergeConflict):
        curate(spark, lake.cfg, "events", DAY_2)
    assert rows(read_silver(spark, lake.cfg, "events").select("day").distinct()) == [("01",)]
    order = [F.desc("_ingestion_time"), F.desc("ts")]
    curate(spark, lake.cfg, "events", DAY_2, dedupe_order=order)
    silver = read_silver(spark, lake.cfg, "events")
    assert silver.count() == 1000
    assert rows(silver.select("_ingestion_time").distinct()) == [(DAY_2.replace(hour=4),)]


def test_upsert_moves_rows_to_the_new_day(spark, lake, load):
    events = load("events")
    lake.create(EVENTS)
    run(lake, "events", events.filter(F.col("ts") <= at("2024-01-20 00:00:00")), DAY_1)
    lake.set("events", ingest_column="2024-01-10 00:00:00")
    run(lake, "events", events.withColumn("value", F.lit(-1.0)), DAY_2)
    silver = read_silver(spark, lake.cfg, "events")
    assert silver.count() == silver.select("event_id").distinct().count() == 1000
    newer = F.col("ts") > at("2024-01-10 00:00:00")
    assert silver.filter(newer != (F.col("day") == "02")).isEmpty()
    assert silver.filter(newer != (F.col("value") == -1.0)).isEmpty()


@pytest.mark.parametrize("keys", ["", None, "None", " | "])
def test_without_keys_rows_are_appended(spark, lake, load, keys):
    lake.create(("region", "INCREMENTAL", None, None, keys, "00"))
    for day in (DAY_1, DAY_2):
        run(lake, "region", load("region"), day)
    assert read_silver(spark, lake.cfg, "region").count() == 10


def test_control_names_match_columns_in_any_case(spark, lake, load):
    lake.create(("region", "INCREMENTAL", None, "R_NAME", "R_RegionKey", "00"))
    first, _ = run(lake, "region", load("region"), DAY_1)
    assert first.next_mark == "MIDDLE EAST"
    run(lake, "region", load("region"), DAY_2)
    assert read_silver(spark, lake.cfg, "region").count() == 5


def test_unknown_key_columns_are_refused(spark, lake, load):
    lake.create(("region", "INCREMENTAL", None, None, "r_regionkey|nope", "00"))
    with pytest.raises(ValueError, match="nope"):
        run(lake, "region", load("region"), DAY_1)


def test_full_load_keeps_a_copy_per_day_or_replaces(spark, lake, load):
    customer = load("customer")
    lake.create(CUSTOMER)
    run(lake, "customer", customer, DAY_1)
    run(lake, "customer", customer.filter("c_custkey < 10"), DAY_2)
    counts = read_silver(spark, lake.cfg, "customer").groupBy("day").count()
    assert rows(counts) == [("01", 150), ("02", 10)]
    run(lake, "customer", customer.filter("c_custkey < 20"), DAY_2, full_mode="replace")
    assert read_silver(spark, lake.cfg, "customer").count() == 20
    with pytest.raises(ValueError, match="full_mode"):
        curate(spark, lake.cfg, "customer", DAY_2, full_mode="other")


def test_full_load_folds_changed_days_only(spark, lake, load):
    customer = load("customer")
    lake.create(CUSTOMER)
    day_3 = datetime(2026, 1, 3)
    run(lake, "customer", customer, DAY_1)
    run(lake, "customer", customer, DAY_2)

    def files():
        return data_files(lake.cfg.silver_path("customer"))

    two_days = files()
    run(lake, "customer", customer, day_3)
    assert two_days.items() <= files().items() and len({f[:25] for f in files()}) == 3
    three_days = files()
    curate(spark, lake.cfg, "customer", day_3)
    assert files() == three_days

    # Landed again, appended to, or changed in Silver: folded again.
    ingest(spark, lake.showing(customer=customer.limit(7)), "customer", DAY_2)
    write_bronze(
        enrich(customer.limit(3), DAY_1), lake.cfg.bronze_path("customer"), "append"
    )
    curate(spark, lake.cfg, "customer", day_3)
    assert {f[:25] for f in files().keys() & three_days.keys()} == {"year=2026/month=01/day=03"}
    counts = read_silver(spark, lake.cfg, "customer").groupBy("day").count()
    assert rows(counts) == [("01", 153), ("02", 7), ("03", 150)]

    lake.set("customer", load_type="INCREMENTAL")
    changed = customer.filter("c_custkey = 1").withColumn("c_name", F.lit("changed"))
    run(lake, "customer", changed, datetime(2026, 1, 4))
    lake.set("customer", load_type="FULL")
    curate(spark, lake.cfg, "customer", day_3)
    silver = read_silver(spark, lake.cfg, "customer")
    bronze = read_bronze(spark, lake.cfg.bronze_path("customer"))
    assert silver.exceptAll(bronze).isEmpty() and bronze.exceptAll(silver).isEmpty()


def test_full_load_then_keyed_updates_reach_every_copy(spark, lake, load):
    """Two full copies, then an upsert: MERGE updates each target row that matches."""
    region = load("region")
    lake.create(("region", "FULL", None, None, "r_regionkey", "00"))
    run(lake, "region", region, DAY_1)
    run(lake, "region", region, DAY_2)
    lake.set("region", load_type="INCREMENTAL")
    one = region.filter("r_regionkey = 1").withColumn("r_name", F.lit("NEW"))
    run(lake, "region", one, datetime(2026, 1, 3))
    silver = read_silver(spark, lake.cfg, "region")
    assert silver.count() == 10
    assert rows(silver.filter("r_name = 'NEW'"), "r_regionkey", "day") == [(1, "03")] * 2


def test_changed_source_columns_are_refused(spark, lake, load):
    region = load("region")
    lake.create(("region", "INCREMENTAL", None, None, "r_regionkey", "00"))
    run(lake, "region", region, DAY_1)
    with pytest.raises(ValueError, match="columns differ"):
        run(lake, "region", region.withColumn("extra", F.lit(1)), DAY_2)
    assert read_silver(spark, lake.cfg, "region").count() == 5


def test_array_columns_survive_the_lake(spark, lake, load):
    vectors = load("embeddings")
    lake.create(("embeddings", "FULL", None, None, None, "00"))
    run(lake, "embeddings", vectors, DAY_1)
    publish_ready(spark, lake.cfg)
    got = read_gold(spark, lake.cfg, "embeddings").select(*vectors.columns)
    assert got.exceptAll(vectors).isEmpty() and vectors.exceptAll(got).isEmpty()


# ---- publication -------------------------------------------------------------------


def ready_tables(lake, load, *tables):
    lake.create(*[(t, "FULL", None, None, None, "00") for t in tables])
    for t in tables:
        run(lake, t, load(t), DAY_1)


def test_many_tables_are_published_together(spark, lake, load):
    tables = ["nation", "region", "supplier", "part", "labels"]
    ready_tables(lake, load, *tables)
    with pytest.raises(ValueError, match="no data in this layer"):
        read_gold(spark, lake.cfg, "nation")
    result = publish_ready(spark, lake.cfg)
    assert (result.tables, result.moved) == (tuple(sorted(tables)), 5)
    for t in tables:
        assert read_gold(spark, lake.cfg, t).count() == load(t).count()


def test_failed_staging_publishes_nothing(spark, lake, load, monkeypatch):
    ready_tables(lake, load, "nation", "region")
    publish_ready(spark, lake.cfg)
    run(lake, "nation", load("nation").limit(1), DAY_2)
    run(lake, "region", load("region").limit(1), DAY_2)
    real = publish_module.stage_gold

    def failing(spark, cfg, row):
        if row["table_name"] == "region":
            raise OSError("disk gone")
        return real(spark, cfg, row)

    with monkeypatch.context() as patch:
        patch.setattr(publish_module, "stage_gold", failing)
        with pytest.raises(OSError, match="disk gone"):
            publish_ready(spark, lake.cfg)
    assert [r["table_name"] for r in lake.state.ready()] == ["nation", "region"]
    assert read_gold(spark, lake.cfg, "nation").count() == 25
    assert publish_ready(spark, lake.cfg).moved == 2
    assert read_gold(spark, lake.cfg, "nation").count() == 26
    assert read_gold(spark, lake.cfg, "region").count() == 6


def test_a_publication_is_one_folder_and_one_row(spark, lake, load):
    ready_tables(lake, load, "customer")
    publish_ready(spark, lake.cfg)
    first = json.loads(lake.state.lookup("customer")["gold"])["folder"]
    lake.set("customer", load_type="INCREMENTAL")
    run(lake, "customer", load("customer").limit(5), DAY_2)
    publish_ready(spark, lake.cfg)
    second = json.loads(lake.state.lookup("customer")["gold"])["folder"]
    folders = {f.split("/")[0] for f in data_files(lake.cfg.gold_path("customer"))}
    assert folders == {first, second} and first != second
    assert read_gold(spark, lake.cfg, "customer").count() == 155


def test_readers_of_an_old_publication_are_not_disturbed(spark, lake, load):
    ready_tables(lake, load, "customer")
    publish_ready(spark, lake.cfg)
    old = read_gold(spark, lake.cfg, "customer")
    run(lake, "customer", load("customer").limit(5), DAY_1)
    publish_ready(spark, lake.cfg)
    assert old.count() == 150
    assert read_gold(spark, lake.cfg, "customer").count() == 5


def test_half_written_copies_are_replaced(spark, lake, load):
    """A staging attempt that died after writing leaves no duplicates behind."""
    ready_tables(lake, load, "customer")
    publish_module.stage_gold(spark, lake.cfg, lake.state.lookup("customer"))
    publish_ready(spark, lake.cfg)
    assert read_gold(spark, lake.cfg, "customer").count() == 150


def test_reset_leaves_tables_that_moved_meanwhile(spark, lake, load, monkeypatch):
    ready_tables(lake, load, "nation", "region")
    real = publish_module.stage_gold

    def slow(spark, cfg, row):
        if row["table_name"] == "region":
            lake.set("region", process_number="00")
            lake.set("region", process_number="01")
        return real(spark, cfg, row)

    monkeypatch.setattr(publish_module, "stage_gold", slow)
    assert publish_ready(spark, lake.cfg).moved == 1
    assert (lake.status("nation"), lake.status("region")) == ("00", "01")


def test_a_ready_table_without_silver_data_fails(spark, lake):
    lake.create(("nation", "FULL", None, None, None, "02"))
    with pytest.raises(ValueError, match="no Silver data"):
        publish_ready(spark, lake.cfg)


def test_a_new_column_is_refused_not_lost(spark, lake):
    lake.create(("squares", "INCREMENTAL", None, None, "id", "00"))
    run(lake, "squares", spark.range(4), DAY_1)
    lake.set("squares", process_number="00")
    wider = spark.range(2).withColumn("extra", F.lit(1))
    ingest(spark, lake.showing(squares=spark.range(9, 10)), "squares", DAY_2)
    lake.set("squares", process_number="00")
    ingest(spark, lake.showing(squares=wider), "squares", DAY_2)
    with pytest.raises(ValueError, match="unknown .*extra"):
        curate(spark, lake.cfg, "squares", DAY_2)


def test_a_source_may_change_the_case_of_its_columns(spark, lake):
    lake.create(("squares", "INCREMENTAL", None, None, " id|\tID\n", "00"))
    run(lake, "squares", spark.range(4).withColumn("v", F.lit(1)), DAY_1)
    lake.set("squares", process_number="00")
    changed = spark.range(2, 5).select(F.col("id").alias("ID"), F.lit(2).alias("V"))
    run(lake, "squares", changed, DAY_2)
    silver = read_silver(spark, lake.cfg, "squares")
    assert rows(silver, "id", "v") == [(0, 1), (1, 1), (2, 2), (3, 2), (4, 2)]


def test_jobs_leave_no_scratch_files(spark, lake):
    root = shared_root(spark).removeprefix("file:")
    lake.create(("squares", "INCREMENTAL", None, None, "id", "00"))
    run(lake, "squares", spark.range(4), DAY_1)
    before = set(os.listdir(root))
    lake.set("squares", process_number="00")
    run(lake, "squares", spark.range(2, 8), DAY_2, dedupe_order=["id"])
    assert set(os.listdir(root)) == before


def test_a_first_load_is_not_written_aside(spark, lake, monkeypatch):
    """Only a merge looks at its batch more than once."""
    written = []
    real = curate_module.write_scratch
    monkeypatch.setattr(curate_module, "write_scratch", lambda df, name: written.append(name) or real(df, name))
    lake.create(("squares", "INCREMENTAL", None, None, "k", "00"))
    twice = spark.range(8).selectExpr("id % 4 k", "id")
    run(lake, "squares", twice, DAY_1, dedupe_order=[F.desc("id")])
    assert rows(read_silver(spark, lake.cfg, "squares"), "k", "id") == [(k, k + 4) for k in range(4)]
    assert written == []
    lake.set("squares", process_number="00")
    run(lake, "squares", twice.filter("k > 1"), DAY_2, dedupe_order=["id"])
    assert rows(read_silver(spark, lake.cfg, "squares"), "k", "id") == [(0, 4), (1, 5), (2, 2), (3, 3)]
    assert written == ["deduped"]


# ---- runs that stop, and what a run costs --------------------------------------------


@pytest.mark.parametrize("stop", ["before apply", "in apply", "before the status moves"])
def test_an_upsert_that_stops_is_finished_by_the_next_run(spark, lake, monkeypatch, stop):
    """Rows with a NULL key are inserted by every merge, so folding a day twice would show."""
    keyed = lambda df: df.select(F.when(F.col("id") % 4 != 0, F.col("id")).alias("k"), "id")
    lake.create(("squares", "INCREMENTAL", None, None, "k", "00"))
    run(lake, "squares", keyed(spark.range(8)), DAY_1)
    lake.set("squares", process_number="00")
    ingest(spark, lake.showing(squares=keyed(spark.range(4, 12))), "squares", DAY_2)
    real = curate_module.apply

    def stopped(spark, staged, root, schema):
        if stop == "in apply":
            read_table(spark, staged.path, schema).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("year", "month", "day").parquet(root)
        elif stop != "before apply":
            real(spark, staged, root, schema)
        raise OSError("driver gone")

    with monkeypatch.context() as patch:
        patch.setattr(curate_module, "apply", stopped)
        with pytest.raises(OSError, match="driver gone"):
            curate(spark, lake.cfg, "squares", DAY_2)
    assert lake.status("squares") == "01"
    assert curate(spark, lake.cfg, "squares", DAY_2).moved == 1
    got = rows(read_silver(spark, lake.cfg, "squares"), "id", "k", "day")
    kept = [(0, None, "01"), (1, 1, "01"), (2, 2, "01"), (3, 3, "01"), (4, None, "01")]
    new = [(i, i if i % 4 else None, "02") for i in range(4, 12)]
    assert got == sorted(kept + new)
    assert lake.state.lookup("squares")["pending"] is None
    assert os.listdir(lake.cfg.staging_root) == []


def test_a_later_day_finishes_the_day_before_first(spark, lake, monkeypatch):
    lake.create(("squares", "INCREMENTAL", None, None, "id", "00"))
    run(lake, "squares", spark.range(4), DAY_1)

    def stopped(*args):
        raise OSError("driver gone")

    ingest(spark, lake.showing(squares=spark.range(2, 6)), "squares", DAY_2)
    with monkeypatch.context() as patch:
        patch.setattr(curate_module, "apply", stopped)
        with pytest.raises(OSError):
            curate(spark, lake.cfg, "squares", DAY_2)
    run(lake, "squares", spark.range(5, 8), datetime(2026, 1, 3))
    silver = rows(read_silver(spark, lake.cfg, "squares"), "id", "day")
    assert silver == [(0, "01"), (1, "01"), (2, "02"), (3, "02"), (4, "02"), (5, "03"), (6, "03"), (7, "03")]


def test_a_daily_run_takes_few_jobs(spark, lake, load):
    events = load("events")
    lake.create(EVENTS)
    run(lake, "events", events, DAY_1)
    publish_ready(spark, lake.cfg)
    lake.set("events", ingest_column="2024-01-10 00:00:00")
    context = spark.sparkContext
    context.setJobGroup("daily run", "ingest, curate and publish one table")
    try:
        run(lake, "events", events, DAY_2)
        publish_ready(spark, lake.cfg)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("daily run")) <= 25


def test_landed_schemas_are_remembered(spark, lake, monkeypatch):
    """No file is opened to learn a schema, neither for a day nor for all of them."""

    def opened(*args):
        raise AssertionError("files are opened")

    monkeypatch.setattr(bronze_module, "landed_schema", opened)
    for table, load_type in (("a", "INCREMENTAL"), ("b", "FULL")):
        control = spark.createDataFrame([(table, load_type, None, None, "id", "00")], CONTROL_SCHEMA)
        lake.state.register(control) if table == "b" else lake.state.create(control)
        run(lake, table, spark.range(3), DAY_1)
        run(lake, table, spark.range(2, 5), DAY_2)
        curate(spark, lake.cfg, table, DAY_2)
        curate(spark, lake.cfg, table, datetime(2026, 1, 9))
        days = {"a": [(0, "01"), (1, "01"), (2, "02"), (3, "02"), (4, "02")]}
        days["b"] = [(0, "01"), (1, "01"), (2, "01"), (2, "02"), (3, "02"), (4, "02")]
        assert rows(read_silver(spark, lake.cfg, table), "id", "day") == days[table]


def test_a_column_that_a_day_lacks_is_refused(spark, lake):
    lake.create(("squares", "INCREMENTAL", None, None, "id", "00"))
    run(lake, "squares", spark.range(4).withColumn("extra", F.lit(1)), DAY_1)
    with pytest.raises(ValueError, match="missing .*extra"):
        run(lake, "squares", spark.range(4), DAY_2)
