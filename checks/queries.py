"""One query per operator, each over whole tables of ``sf_dir``.

Queries that write use a fresh folder of the shared scratch root.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import LakeConfig
from tidemark.operators import control as ctl
from tidemark.operators import rows as row_ops
from tidemark.operators.merge import duplicate_keys, upsert
from tidemark.operators.rows import day_slice, enrich
from tidemark.plans.curate import curate
from tidemark.plans.ingest import ingest
from tidemark.plans.publish import publish_ready, read_gold, read_silver, read_version, stage_gold
from tidemark.session import scratch_path
from tidemark.sinks.bronze import write_bronze
from tidemark.sinks.silver import (
    append_silver,
    create_silver,
    merge_silver,
    overwrite_partitions,
    read_table,
)
from tidemark.sources import extract as extracts
from tidemark.sources.bronze import read_bronze
from tidemark.sources.tables import FrameSource, ParquetSource
from tidemark.state import ControlTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY_1 = datetime(2026, 1, 1, 3)
DAY_2 = datetime(2026, 1, 2, 3)
DAY_3 = datetime(2026, 1, 3, 3)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return ParquetSource(sf_dir).read(spark, table)


def ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


# ---- control table -----------------------------------------------------------------


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control table with one feed per customer, its mark taken from their orders."""
    marks = (
        load(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.max("o_orderdate").alias("mark"))
    )
    customer = load(spark, sf_dir, "customer")
    kind = F.col("c_nationkey") % 5
    return customer.join(
        marks, customer.c_custkey == marks.o_custkey, "left"
    ).select(
        F.col("c_name").alias("table_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", "full")
        .when(F.col("c_mktsegment") == "MACHINERY", "Incremental")
        .otherwise("INCREMENTAL")
        .alias("load_type"),
        F.date_format("mark", "yyyy-MM-dd HH:mm:ss").alias("ingest_column"),
        F.lit("o_orderdate").alias("source_dt_col"),
        F.when(kind == 0, "o_orderkey")
        .when(kind == 1, " o_custkey |\t o_orderkey \n| o_custkey")
        .when(kind == 2, "")
        .when(kind == 3, "|o_custkey|| o_orderdate|")
        .when(F.col("c_custkey") % 2 == 0, "None")
        .alias("primary_keys"),
        F.lpad((F.col("c_custkey") % 3).cast("string"), 2, "0").alias("process_number"),
    )


@query
def control_lookup(spark, sf_dir):
    return ctl.control_lookup(feeds(spark, sf_dir), "Customer#000000001").select(
        "table_name", "load_type", "ingest_column", "source_dt_col"
    )


@query
def control_ready(spark, sf_dir):
    return ctl.control_ready(feeds(spark, sf_dir))


@query
def key_list(spark, sf_dir):
    return ctl.key_list(feeds(spark, sf_dir))


@query
def status_advance(spark, sf_dir):
    moved = ctl.advance_status(feeds(spark, sf_dir), "Customer#000000001", "01", "02")
    return moved.select("table_name", "process_number")


@query
def status_reset(spark, sf_dir):
    control = feeds(spark, sf_dir)
    batch = control.filter(F.upper("load_type") == "FULL")
    return ctl.reset_status(control, batch).select("table_name", "process_number")


# ---- extracts ----------------------------------------------------------------------


@query
def extract_full(spark, sf_dir):
    return extracts.extract_full(spark, ParquetSource(sf_dir), "customer")


@query
def extract_first_run(spark, sf_dir):
    return extracts.extract_first_run(spark, ParquetSource(sf_dir), "lineitem")


@query
def extract_incremental(spark, sf_dir):
    return extracts.extract_incremental(
        spark, ParquetSource(sf_dir), "orders", "o_orderdate", "2001-01-01 00:00:00"
    )


@query
def next_watermark(spark, sf_dir):
    batch = extract_incremental(spark, sf_dir)
    return extracts.next_watermark(batch, "o_orderdate").select(
        F.lit("orders").alias("table_name"), "next_mark"
    )


# ---- Bronze ------------------------------------------------------------------------


@query
def bronze_enrich(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    return enrich(events, F.col("ts")).select(
        "event_id", "event_type", "_ingestion_time", "year", "month", "day"
    )


@query
def bronze_append(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    path = scratch_path(spark, "bronze")
    first = events.filter(F.col("ts") <= ntz("2024-01-10 00:00:00"))
    second = events.filter(F.col("ts") > ntz("2024-01-05 00:00:00"))
    write_bronze(enrich(first, DAY_1), path, "append")
    write_bronze(enrich(second, DAY_1), path, "append")
    return read_bronze(spark, path).select("event_id", "event_type")


@query
def bronze_overwrite_day(spark, sf_dir):
    events = enrich(load(spark, sf_dir, "events"), F.col("ts"))
    path = scratch_path(spark, "bronze")
    write_bronze(events.withColumn("tag", F.lit("old")), path, "overwrite")
    clicks = day_slice(events, datetime(2024, 1, 15)).filter(
        F.col("event_type") == "click"
    )
    write_bronze(clicks.withColumn("tag", F.lit("new")), path, "overwrite")
    return read_bronze(spark, path).select(
        "event_id", F.col("day").cast("int").alias("d"), "tag"
    )


@query
def bronze_day_slice(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    path = scratch_path(spark, "bronze")
    write_bronze(enrich(events, F.col("ts")), path, "append")
    day = read_bronze(spark, path, run_ts=datetime(2024, 1, 15, 3))
    return day.select("event_id", "event_type")


# ---- Silver ------------------------------------------------------------------------


@query
def silver_create(spark, sf_dir):
    events = enrich(load(spark, sf_dir, "events"), F.col("ts"))
    root = scratch_path(spark, "silver")
    schema = create_silver(events, root)
    return read_table(spark, root, schema).select(
        "event_id", "event_type", "year", "month", "day"
    )


@query
def silver_create_null_partition(spark, sf_dir):
    """Partition values that are boolean or NULL."""
    status = F.col("o_orderstatus")
    done = F.when(status == "F", True).when(status == "O", False)
    orders = load(spark, sf_dir, "orders").select("o_orderkey", done.alias("done"))
    root = scratch_path(spark, "silver")
    return read_table(spark, root, create_silver(orders, root, ["done"]))


@query
def silver_overwrite_partitions(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        F.year("l_shipdate").cast("string").alias("year"),
    )
    root = scratch_path(spark, "silver")
    schema = create_silver(lines.withColumn("tag", F.lit("old")), root, ["year"])
    late = F.col("l_shipdate") >= ntz("2000-01-01 00:00:00")
    batch = read_table(spark, root, schema).filter(late).withColumn("tag", F.lit("new"))
    overwrite_partitions(batch, root, schema, ["year"])
    return read_table(spark, root, schema).drop("year")


@query
def silver_append(spark, sf_dir):
    events = load(spark, sf_dir, "events")
    middle = ntz("2024-01-15 00:00:00")
    root = scratch_path(spark, "silver")
    schema = create_silver(enrich(events.filter(F.col("ts") <= middle), DAY_1), root)
    append_silver(enrich(events.filter(F.col("ts") > middle), DAY_2), root, schema)
    return read_table(spark, root, schema).select("event_id", "value", "day")


@query
def silver_upsert_single(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"
    )
    target = orders.filter(F.col("o_orderdate") < ntz("2000-01-01 00:00:00"))
    source = orders.filter(F.col("o_orderdate") > ntz("1999-06-01 00:00:00"))
    return upsert(target, source.withColumn("o_orderstatus", F.lit("U")), ["o_orderkey"])


@query
def silver_upsert_composite(spark, sf_dir):
    turns = load(spark, sf_dir, "conversations")
    target = turns.filter(F.col("conv_id") % 3 != 0)
    changed = (F.col("conv_id") % 2 == 0) | (F.col("conv_id") % 3 == 0)
    source = turns.filter(changed).withColumn("role", F.lit("updated"))
    return upsert(target, source, ["conv_id", "turn"])


@query
def silver_upsert_null_keys(spark, sf_dir):
    customer = load(spark, sf_dir, "customer")
    number = F.col("c_custkey")
    target = customer.select(
        F.when(number % 10 != 0, number).alias("k"), "c_name", F.lit("t").alias("tag")
    )
    source = customer.filter(number % 4 == 0).select(
        F.when(number % 20 != 0, number).alias("k"), "c_name", F.lit("s").alias("tag")
    )
    return upsert(target, source, ["k"])


@query
def silver_merge_null_keys(spark, sf_dir):
    """The same through files: rows with a NULL key match nothing and are kept."""
    customer = load(spark, sf_dir, "customer")
    number, nation = F.col("c_custkey"), F.col("c_nationkey")
    target = customer.select(
        F.when(number % 10 != 0, number).alias("k"), "c_name", nation, F.lit("t").alias("tag")
    )
    source = customer.filter(number % 4 == 0).select(
        F.when(number % 20 != 0, number).alias("k"), "c_name", nation, F.lit("s").alias("tag")
    )
    root = scratch_path(spark, "silver")
    schema = create_silver(target, root, ["c_nationkey"])
    merge_silver(source, root, schema, ["k"], ["c_nationkey"])
    return read_table(spark, root, schema)


@query
def silver_upsert_repeated_target(spark, sf_dir):
    target = load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_shipdate").alias("at"),
        F.col("l_linestatus").alias("status"),
    )
    late = F.col("o_orderdate") > ntz("1999-06-01 00:00:00")
    source = load(spark, sf_dir, "orders").filter(late).select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderdate").alias("at"),
        F.lit("U").alias("status"),
    )
    return upsert(target, source, ["k"])


@query
def merge_duplicate_keys(spark, sf_dir):
    return duplicate_keys(load(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dedupe_latest(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    order = [
        F.desc("l_shipdate"),
        F.desc("l_partkey"),
        F.desc("l_suppkey"),
        F.desc("l_extendedprice"),
    ]
    return row_ops.dedupe_latest(lines, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )


# ---- whole runs --------------------------------------------------------------------


def lake(spark: SparkSession, *control: tuple) -> LakeConfig:
    """A fresh lake with the given control rows."""
    cfg = LakeConfig.under(scratch_path(spark, "lake"))
    rows = spark.createDataFrame(list(control), ctl.CONTROL_SCHEMA)
    ControlTable(spark, cfg.state_path).create(rows)
    return cfg


def run_day(spark, cfg, table, frame, run_ts, **curate_options) -> None:
    """One daily run of one table, with the source system showing ``frame``."""
    cfg = LakeConfig(
        cfg.bronze_root,
        cfg.silver_root,
        cfg.gold_root,
        cfg.state_root,
        FrameSource({table: frame}),
    )
    ingest(spark, cfg, table, run_ts)
    curate(spark, cfg, table, run_ts, **curate_options)


def set_control(spark, cfg, table, **values) -> None:
    """Change control values the way an operator of the lake would."""
    changes = {column: {table: value} for column, value in values.items()}
    ControlTable(spark, cfg.state_path).commit([table], **changes)


@query
def ingest_curate_orders(spark, sf_dir):
    """Incremental with a key: first load, then an upsert that moves rows to day 2."""
    orders = load(spark, sf_dir, "orders")
    cfg = lake(spark, ("orders", "incremental", None, "o_orderdate", "o_orderkey", "00"))
    early = orders.filter(F.col("o_orderdate") <= ntz("2000-01-01 00:00:00"))
    run_day(spark, cfg, "orders", early, DAY_1)
    set_control(
        spark, cfg, "orders", ingest_column="1999-07-01 00:00:00", process_number="00"
    )
    run_day(spark, cfg, "orders", orders, DAY_2)
    return read_silver(spark, cfg, "orders")


@query
def ingest_curate_customer_full(spark, sf_dir):
    """Full loads keep one copy per ingest day; a second run on a day replaces it."""
    customer = load(spark, sf_dir, "customer")
    cfg = lake(spark, ("customer", "full", None, None, "c_custkey", "00"))
    run_day(spark, cfg, "customer", customer, DAY_1)
    poor = customer.filter(F.col("c_acctbal") < 0)
    run_day(spark, cfg, "customer", poor, DAY_2)
    run_day(spark, cfg, "customer", poor.withColumn("c_acctbal", F.lit(0.0)), DAY_2)
    return read_silver(spark, cfg, "customer").select(
        "c_custkey", "c_name", "c_acctbal", "year", "month", "day"
    )


@query
def ingest_curate_orders_three_runs(spark, sf_dir):
    """Merge after merge: files keep unmatched rows next to rows that moved to a later day."""
    orders = load(spark, sf_dir, "orders")
    cfg = lake(spark, ("orders", "INCREMENTAL", None, "o_orderdate", "o_orderkey", "00"))
    run_day(spark, cfg, "orders", orders, DAY_1)
    for run_ts, mark, tag in ((DAY_2, "1996-01-01", "2"), (DAY_3, "2000-01-01", "3")):
        set_control(spark, cfg, "orders", ingest_column=f"{mark} 00:00:00", process_number="00")
        changed = orders.withColumn("o_orderstatus", F.lit(tag))
        run_day(spark, cfg, "orders", changed, run_ts)
    return read_silver(spark, cfg, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "day"
    )


@query
def ingest_curate_customer_replace(spark, sf_dir):
    """``full_mode="replace"``: the last run day alone is the table."""
    customer = load(spark, sf_dir, "customer")
    cfg = lake(spark, ("customer", "FULL", None, None, None, "00"))
    run_day(spark, cfg, "customer", customer.withColumn("c_acctbal", F.lit(0.0)), DAY_1)
    run_day(spark, cfg, "customer", customer, DAY_2, full_mode="replace")
    return read_silver(spark, cfg, "customer").select("c_custkey", "c_name", "c_acctbal", "day")


@query
def ingest_curate_events_no_key(spark, sf_dir):
    """Incremental without a key appends, so rows above an old mark come twice."""
    events = load(spark, sf_dir, "events")
    cfg = lake(spark, ("events", "INCREMENTAL", "", "ts", "", "00"))
    run_day(spark, cfg, "events", events, DAY_1)
    set_control(spark, cfg, "events", ingest_column="2024-01-15 00:00:00")
    run_day(spark, cfg, "events", events, DAY_2)
    return read_silver(spark, cfg, "events").select("event_id", "event_type", "day")


@query
def ingest_curate_lineitem_dedupe(spark, sf_dir):
    """A composite key that repeats in every batch, reduced to its latest row."""
    lines = load(spark, sf_dir, "lineitem")
    cfg = lake(
        spark,
        ("lineitem", "INCREMENTAL", "", "l_shipdate", "l_orderkey | l_linenumber", "00"),
    )
    order = [
        F.desc("l_shipdate"),
        F.desc("l_partkey"),
        F.desc("l_suppkey"),
        F.desc("l_extendedprice"),
    ]
    run_day(spark, cfg, "lineitem", lines, DAY_1, dedupe_order=order)
    set_control(spark, cfg, "lineitem", ingest_column="1998-01-01 00:00:00")
    relisted = lines.withColumn("l_linestatus", F.lit("U"))
    run_day(spark, cfg, "lineitem", relisted, DAY_2, dedupe_order=order)
    return read_silver(spark, cfg, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_linestatus", "day"
    )


# ---- Gold --------------------------------------------------------------------------


@query
def gold_stage(spark, sf_dir):
    cfg = lake(spark, ("orders", "full", None, None, None, "00"))
    run_day(spark, cfg, "orders", load(spark, sf_dir, "orders"), DAY_1)
    staged = stage_gold(spark, cfg, ControlTable(spark, cfg.state_path).lookup("orders"))
    return read_version(spark, cfg, "orders", staged).drop(
        "_ingestion_time", "year", "month", "day"
    )


@query
def gold_publish(spark, sf_dir):
    names = ["customer", "orders"]
    cfg = lake(spark, *[(n, "full", None, None, None, "00") for n in names])
    for n in names:
        run_day(spark, cfg, n, load(spark, sf_dir, n), DAY_1)
    publish_ready(spark, cfg)
    counts = [
        read_gold(spark, cfg, n).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(n).alias("table_name"), "n_rows"
        )
        for n in names
    ]
    status = ControlTable(spark, cfg.state_path).current().select("table_name", "process_number")
    return counts[0].unionByName(counts[1]).join(status, "table_name")


@query
def gold_publish_twice(spark, sf_dir):
    """The second publication shows what the second run made of the table."""
    orders = load(spark, sf_dir, "orders")
    cfg = lake(spark, ("orders", "incremental", None, "o_orderdate", "o_orderkey", "00"))
    early = orders.filter(F.col("o_orderdate") <= ntz("2000-01-01 00:00:00"))
    run_day(spark, cfg, "orders", early, DAY_1)
    publish_ready(spark, cfg)
    set_control(spark, cfg, "orders", ingest_column="1999-07-01 00:00:00")
    run_day(spark, cfg, "orders", orders, DAY_2)
    publish_ready(spark, cfg)
    return read_gold(spark, cfg, "orders")
