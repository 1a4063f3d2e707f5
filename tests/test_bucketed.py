"""Silver in bucketed tables of the session's catalog."""

from __future__ import annotations

import re
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import DAY_1, DAY_2, plan, rows
from tests.test_plans import conf  # noqa: F401
from tidemark import curate, ingest, publish_ready, read_gold, read_silver
from tidemark.operators.merge import MergeConflict, key_counts
from tidemark.operators.rows import enrich
from tidemark.sinks.bucketed import BucketedTable

DAY_3 = datetime(2026, 1, 3, 3)


@pytest.fixture
def table(spark, request):
    name = re.sub(r"\W", "_", request.node.name)
    made = BucketedTable(spark, "spark_catalog.bucketed", name, keys=["id"], buckets=4)
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made.full_name}")


def test_files_hold_one_bucket_in_key_order(spark, table):
    table.create(enrich(spark.range(0, 1000, 1, 5), DAY_1))
    text = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table.full_name}").collect()}
    assert (text["Num Buckets"], text["Bucket Columns"], text["Sort Columns"]) == ("4", "[`id`]", "[`id`]")
    assert len(table.read().inputFiles()) == 4


def test_the_key_pass_does_not_shuffle_the_table(spark, table, conf):  # noqa: F811
    """With a batch too large to broadcast, only its own keys are exchanged."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    table.create(enrich(spark.range(0, 1000, 1, 5), DAY_1))
    batch = enrich(spark.range(900, 1100), DAY_2)
    hits = table.read().select("id").join(key_counts(batch, ["id"]), ["id"])
    assert hits.count() == 100
    tree = plan(hits).split("\n\n")[0]
    join = tree.index("SortMergeJoin")
    sides = re.split(r"\n\s*(?=[:+]- )", tree[join:])
    scan = next(i for i, line in enumerate(sides) if "Scan parquet" in line)
    assert not any("Exchange" in line for line in sides[: scan + 1])
    assert tree.count("Exchange") >= 1


def test_merges_move_rows_and_drop_days(spark, table):
    table.create(enrich(spark.range(4).withColumn("v", F.lit("a")), DAY_1))
    table.append(enrich(spark.range(10, 12).withColumn("v", F.lit("b")), DAY_2))
    table.merge(enrich(spark.range(2, 5).withColumn("v", F.lit("c")), DAY_2), ["id"])
    expected = [(0, "a", "01"), (1, "a", "01"), (2, "c", "02"), (3, "c", "02"), (4, "c", "02"), (10, "b", "02"), (11, "b", "02")]
    assert rows(table.read(), "id", "v", "day") == expected
    table.merge(enrich(spark.range(2).withColumn("v", F.lit("d")), DAY_3), ["ID"])
    expected[:2] = [(0, "d", "03"), (1, "d", "03")]
    assert rows(table.read(), "id", "v", "day") == expected
    days = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table.full_name}").collect()}
    assert days == {"year=2026/month=01/day=02", "year=2026/month=01/day=03"}
    assert len(table.read().inputFiles()) <= 8


def test_conflicts_and_other_columns_are_refused(spark, table):
    table.create(enrich(spark.range(4), DAY_1))
    twice = spark.range(1).union(spark.range(1))
    with pytest.raises(MergeConflict):
        table.merge(enrich(twice, DAY_2), ["id"])
    with pytest.raises(ValueError, match="columns differ"):
        table.append(enrich(spark.range(1).withColumn("extra", F.lit(1)), DAY_2))
    assert rows(table.read(), "id") == [(i,) for i in range(4)]


def test_days_and_the_table_can_be_replaced(spark, table):
    table.create(enrich(spark.range(4), DAY_1))
    table.overwrite_partitions(enrich(spark.range(2), DAY_2))
    table.overwrite_partitions(enrich(spark.range(7, 8), DAY_1))
    assert rows(table.read(), "id", "day") == [(0, "02"), (1, "02"), (7, "01")]
    table.replace(enrich(spark.range(5), DAY_3))
    assert rows(table.read(), "id", "day") == [(i, "03") for i in range(5)]


def test_a_lake_with_bucketed_silver(spark, lake, load):
    """The two-day run of a keyed table, and its publication."""
    events = load("events")
    lake.create(("events", "INCREMENTAL", None, "ts", "event_id", "00"))
    options = {"silver_catalog": "spark_catalog.bucketed_lake", "silver_buckets": 4}
    cfg = replace(lake.showing(events=events), **options)
    ingest(spark, cfg, "events", DAY_1)
    curate(spark, cfg, "events", DAY_1)
    lake.set("events", ingest_column="2024-01-10 00:00:00", process_number="00")
    cfg = replace(lake.showing(events=events.withColumn("value", F.lit(-1.0))), **options)
    ingest(spark, cfg, "events", DAY_2)
    assert curate(spark, cfg, "events", DAY_2).moved == 1
    publish_ready(spark, cfg)
    newer = F.col("ts") > F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    for shown in (read_silver(spark, cfg, "events"), read_gold(spark, cfg, "events")):
        assert shown.count() == 1000
        assert shown.filter(newer != (F.col("day") == "02")).isEmpty()
        assert shown.filter(newer != (F.col("value") == -1.0)).isEmpty()
