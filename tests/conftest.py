from __future__ import annotations

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.config import LakeConfig
from tidemark.operators.control import CONTROL_SCHEMA
from tidemark.session import local_session
from tidemark.sources.tables import FrameSource
from tidemark.state import ControlTable

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        conf={
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "checkpoints"),
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def load(spark):
    return lambda table: spark.read.parquet(f"{SF_DIR}/{table}.parquet")


class Lake:
    """A lake in a folder, with sources that can be swapped between runs."""

    def __init__(self, spark, root):
        self.spark = spark
        self.cfg = LakeConfig.under(str(root))
        self.state = ControlTable(spark, self.cfg.state_path)

    def create(self, *rows):
        self.state.create(self.spark.createDataFrame(list(rows), CONTROL_SCHEMA))
        return self

    def showing(self, **frames) -> LakeConfig:
        cfg = LakeConfig.under(self.cfg.state_root.rsplit("/", 1)[0], FrameSource(frames))
        self.cfg = cfg
        return cfg

    def status(self, table):
        return self.state.lookup(table)["process_number"]

    def set(self, table, **values):
        changes = {c: {table: v} for c, v in values.items()}
        self.state.commit([table], **changes)


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path / "lake")


DAY_1 = datetime(2026, 1, 1, 3)
DAY_2 = datetime(2026, 1, 2, 3)


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def rows(df, *columns):
    """Rows as sorted tuples, NULL first."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda t: [(v is not None, str(type(v)), v if v is not None else 0) for v in t],
    )


def data_files(root):
    """Data files below a folder with their modification times."""
    found = {}
    for folder, _, names in os.walk(root):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(folder, name)
                found[os.path.relpath(path, root)] = os.stat(path).st_mtime_ns
    return found


def plan(df):
    """The formatted physical plan as text."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
