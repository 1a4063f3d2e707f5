"""Catalog tables and database staging, as far as they go without either."""

from __future__ import annotations

from collections import namedtuple
from dataclasses import replace

import pytest
from pyspark.sql import DataFrameWriter

from tests.conftest import DAY_1, rows
from tidemark import curate, ingest, publish_ready, read_gold, read_silver
from tidemark.config import LakeConfig
from tidemark.operators.rows import enrich
from tidemark.plans.publish import stage_ready
from tidemark.session import scratch_path, shared_root
from tidemark.sinks.catalog import CatalogTable
from tidemark.sinks.jdbc import stage_jdbc
from tidemark.sources.tables import FrameSource, JdbcSource


def test_config_paths_and_repr():
    source = JdbcSource("jdbc:x", {"password": "secret"})
    cfg = LakeConfig("b/", "s//", "g", "st/", source)
    assert cfg.bronze_path("t") == "b/t"
    assert cfg.silver_path("t") == "s/t"
    assert cfg.gold_path("t") == "g/t"
    assert "secret" not in repr(cfg) and "secret" not in repr(source)


def test_scratch_is_below_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == configured
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(f"{configured}/x-")


Fake = namedtuple("Fake", "conf sparkContext")
Conf = namedtuple("Conf", "get")
Context = namedtuple("Context", "master applicationId getCheckpointDir")


def without_setting(master, folder=None):
    context = Context(master, "app-1", lambda: folder)
    return Fake(Conf(lambda key, default=None: default), context)


def test_a_checkpoint_folder_set_in_the_program_counts():
    assert shared_root(without_setting("yarn", "hdfs://x/y/")) == "hdfs://x/y"


@pytest.mark.parametrize("master", ["spark://host:1", "yarn", "local-cluster[2,1,1024]"])
def test_no_machine_local_folder_on_a_cluster(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(without_setting(master))


def test_a_local_session_without_the_setting_has_one_folder():
    session = without_setting("local[8]")
    assert shared_root(session) == shared_root(session)


def test_catalog_table_is_created_partitioned(spark):
    table = CatalogTable(spark, "spark_catalog.curated", "numbers")
    assert not table.exists()
    table.create(enrich(spark.range(3), DAY_1))
    assert table.exists()
    assert rows(table.read(), "id", "day") == [(0, "01"), (1, "01"), (2, "01")]
    columns = spark.catalog.listColumns(table.full_name)
    assert [c.name for c in columns if c.isPartition] == ["year", "month", "day"]


def test_catalog_tables_get_their_properties(spark, lake):
    cfg = replace(lake.cfg, silver_catalog="spark_catalog.kept", table_properties={"purpose": "test"})
    table = CatalogTable(spark, cfg.silver_catalog, "n", cfg.table_properties)
    table.create(enrich(spark.range(3), DAY_1))
    found = spark.sql(f"SHOW TBLPROPERTIES {table.full_name}").collect()
    assert ("purpose", "test") in {tuple(r) for r in found}


def test_first_run_through_a_catalog(spark, lake):
    lake.create(("squares", "INCREMENTAL", None, None, "id", "00"))
    cfg = lake.cfg
    cfg = LakeConfig(
        cfg.bronze_root,
        cfg.silver_root,
        cfg.gold_root,
        cfg.state_root,
        FrameSource({"squares": spark.range(4)}),
        silver_catalog="spark_catalog.jobs",
    )
    ingest(spark, cfg, "squares", DAY_1)
    assert curate(spark, cfg, "squares", DAY_1).moved == 1
    assert read_silver(spark, cfg, "squares").count() == 4
    publish_ready(spark, cfg)
    assert read_gold(spark, cfg, "squares").count() == 4


class Calls:
    """Records a chain of calls."""

    def __init__(self):
        self.made = []

    def __getattr__(self, name):
        def call(*args):
            self.made.append((name, *map(str, args)))
            return self

        return call


def test_catalog_writes_use_the_writers_of_spark(spark, monkeypatch):
    calls = Calls()
    table = CatalogTable(spark, "lake.db", "t")
    batch = enrich(spark.range(1), DAY_1)
    frame = type(batch)
    monkeypatch.setattr(frame, "writeTo", lambda df, name: calls.writeTo(name))
    monkeypatch.setattr(frame, "mergeInto", lambda df, name, on: calls.mergeInto(name, on))
    table.append(batch)
    table.overwrite_partitions(batch)
    table.replace(batch)
    table.merge(batch, ["a", "b"])
    assert [c[0] for c in calls.made] == [
        *("writeTo", "append", "writeTo", "overwritePartitions", "writeTo", "overwrite"),
        *("mergeInto", "whenMatched", "updateAll", "whenNotMatched", "insertAll", "merge"),
    ]
    assert calls.made[0][1] == "lake.db.`t`"
    condition = next(c for c in calls.made if c[0] == "mergeInto")[2]
    assert "lake.db.t.a" in condition.replace("`", "") and "_batch.b" in condition.replace("`", "")


@pytest.fixture
def jdbc_writes(monkeypatch):
    calls = []

    def fake(writer, url, table, mode=None, properties=None):
        calls.append((url, table, mode, properties))

    monkeypatch.setattr(DataFrameWriter, "jdbc", fake)
    return calls


def test_staging_drops_and_recreates(load, jdbc_writes):
    assert stage_jdbc(load("orders"), "jdbc:x", "orders", {"user": "u"}) == "stg_orders"
    assert jdbc_writes == [("jdbc:x", "stg_orders", "overwrite", {"user": "u"})]


def test_staging_refuses_nested_columns(load, jdbc_writes):
    with pytest.raises(ValueError, match="embedding"):
        stage_jdbc(load("embeddings"), "jdbc:x", "embeddings")
    assert jdbc_writes == []


def test_every_ready_table_is_staged(spark, lake, load, jdbc_writes):
    tables = ["nation", "region"]
    lake.create(*[(t, "FULL", None, None, None, "00") for t in tables])
    cfg = lake.showing(**{t: load(t) for t in tables})
    for t in tables:
        ingest(spark, cfg, t, DAY_1)
        curate(spark, cfg, t, DAY_1)
    assert stage_ready(spark, cfg, "jdbc:x") == {t: f"stg_{t}" for t in tables}
    assert [r["table_name"] for r in lake.state.ready()] == tables
