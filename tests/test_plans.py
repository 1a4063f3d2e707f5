"""Plans: what is pushed, pruned, pre-aggregated, split, and never done."""

from __future__ import annotations

import re
from datetime import datetime
from functools import partial

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from tests.conftest import DAY_1, DAY_2, plan
from tidemark.operators.merge import duplicate_keys, key_range, matched_keys, upsert
from tidemark.operators.rows import dedupe_latest, enrich
from tidemark.sinks import silver
from tidemark.sinks.silver import create_silver, merge_silver, read_table

READ_ONLY = [
    "control_lookup",
    "control_ready",
    "key_list",
    "status_advance",
    "status_reset",
    "extract_full",
    "extract_incremental",
    "next_watermark",
    "bronze_enrich",
    "silver_upsert_single",
    "silver_upsert_composite",
    "silver_upsert_null_keys",
    "silver_upsert_repeated_target",
    "merge_duplicate_keys",
    "dedupe_latest",
]


@pytest.fixture
def conf(spark):
    """Settings for one test."""
    before = {}

    def set_all(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_all
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("query", READ_ONLY)
def test_no_python_and_no_cross_join(spark, sf_dir, query):
    text = plan(QUERIES[query](spark, sf_dir))
    assert not re.search(r"Python|Cartesian|NestedLoop|Pandas|CollectLimit", text)


def test_duplicate_count_is_partial_before_the_shuffle(load):
    text = plan(duplicate_keys(load("lineitem"), ["l_orderkey", "l_linenumber"]))
    assert "partial_count(1)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text


def test_latest_row_is_limited_before_the_shuffle(load):
    text = plan(dedupe_latest(load("lineitem"), ["l_orderkey"], [F.desc("l_shipdate")]))
    tree = text.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2
    final, partial = [m.start() for m in re.finditer("WindowGroupLimit", tree)]
    assert final < tree.index("Exchange") < partial


def test_null_keys_stay_out_of_every_join(load):
    orders = load("orders")
    source = load("orders").filter("o_orderkey < 9")
    text = plan(upsert(orders, source, ["o_custkey"]))
    scans = re.findall(r"PushedFilters: \[(.*?)\]", text)
    null_scans = [s for s in scans if "IsNull(o_custkey)" in s]
    assert len(null_scans) == 2
    assert all("IsNotNull(o_custkey)" in s for s in scans if s not in null_scans)


def test_an_upsert_sorts_no_target_keys(load, conf):
    """Sorted are the target's rows, and the source with its keys, for changes and for new rows."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    lines = load("lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linestatus").alias("status"))
    batch = load("orders").select(F.col("o_orderkey").alias("k"), F.lit("U").alias("status"))
    tree = plan(upsert(lines, batch, ["k"])).split("\n\n")[0]
    assert (tree.count("SortMergeJoin"), len(re.findall(r"\bSort \(", tree))) == (3, 5)
    assert not re.search(r"Anti|Semi", tree)


def test_a_merge_reads_keys_first_and_then_pruned_partitions(spark, load, tmp_path, monkeypatch):
    root = str(tmp_path / "silver")
    orders = load("orders")
    schema = create_silver(enrich(orders.filter("o_orderkey < 500"), DAY_1), root)
    silver.append_silver(enrich(orders.filter("o_orderkey >= 500"), DAY_2), root, schema)
    texts = {}

    def explained(df, name, *args, real=None):
        texts[name.rsplit("/", 1)[-1]] = plan(df)
        return real(df, name, *args)

    for step in ("write_scratch", "stage"):
        real = getattr(silver, step)
        monkeypatch.setattr(silver, step, partial(explained, real=real))
    batch = enrich(orders.filter("o_orderkey < 3"), datetime(2026, 1, 3))
    merge_silver(batch, root, schema, ["o_orderkey"])
    first = next(t for n, t in texts.items() if n == "merge-hits")
    assert "ReadSchema: struct<o_orderkey:bigint>" in first
    assert "GreaterThanOrEqual(o_orderkey,0), LessThanOrEqual(o_orderkey,2)" in first
    second = next(t for n, t in texts.items() if n.startswith("silver-merge"))
    scans = [s for s in second.split("\n\n") if f"file:{root}" in s]
    assert scans and all(re.search(r"PartitionFilters: \[concat_ws\(/.*=2026/=01/=01", s) for s in scans)
    assert not any("=2026/=01/=02" in s for s in scans)


def test_small_batches_do_not_shuffle_the_target(spark, load):
    lines = load("lineitem")
    batch = load("orders").limit(3).select(F.col("o_orderkey").alias("l_orderkey"))
    hits = matched_keys(lines.select("l_orderkey"), batch, ["l_orderkey"])
    hits.collect()
    assert "BroadcastHashJoin" in plan(hits)


def test_a_hot_target_key_is_split(spark, conf):
    """A third of the target on one key, with a batch too large to broadcast."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="128k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    number = F.col("id")
    target = spark.range(0, 300_000, 1, 8).select(
        F.when(number % 3 == 0, 7).otherwise(number).alias("k"),
        F.sha2(number.cast("string"), 256).alias("v"),
    )
    batch = spark.range(0, 50_000).select(
        number.alias("k"), F.lit("new").alias("v")
    )
    hits = matched_keys(target.select("k", "v"), batch, ["k"])
    n_hits = hits.count()
    merged = upsert(target, batch, ["k"])
    seen = merged.groupBy("v").count().filter("v = 'new'")
    new_rows = seen.collect()[0]["count"]
    hot = target.filter("k = 7").count()
    assert hot > 100_000
    matched = target.filter("k < 50000").count()
    missing = spark.range(0, 50_000).filter("id % 3 = 0 and id <> 7").count()
    assert (n_hits, new_rows) == (matched, matched + missing)
    hits.collect()
    assert "skew=true" in plan(hits)


def test_a_hot_day_is_split_over_files(spark, conf, tmp_path):
    """Rows of a merge are clustered by day, but no task gets a whole hot day."""
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="64k")
    root = str(tmp_path)
    ids = spark.range(0, 60_000, 1, 8).withColumn("text", F.sha2(F.col("id").cast("string"), 256))
    schema = create_silver(enrich(ids, DAY_1), root)
    merge_silver(enrich(ids.filter("id % 2 = 0"), DAY_2), root, schema, ["id"])
    merged = read_table(spark, root, schema)
    sizes = merged.groupBy(F.input_file_name()).agg(
        F.countDistinct("day").alias("days"), F.count("*").alias("n")
    )
    assert merged.groupBy("day").count().orderBy("day").collect() == [("01", 30_000), ("02", 30_000)]
    assert sizes.count() >= 4
    assert sizes.agg(F.max("days")).first()[0] == 1
    assert sizes.agg(F.max("n")).first()[0] <= 15_000
