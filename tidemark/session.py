"""Folders shared by all executors, and a local session for tests and the bench."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared scratch folder; a temporary one on local masters only."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if context.master.startswith("local") and "cluster" not in context.master:
        return _local_root(context.applicationId)
    raise RuntimeError(
        "set spark.checkpoint.dir to a folder that every executor can reach"
    )


@cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared scratch folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: computed once, and safe when executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_scratch(*written: DataFrame) -> None:
    """Delete what :func:`write_scratch` wrote, once nothing reads it any more."""
    for df in written:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            delete(df.sparkSession, folder)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, by the path that Spark gives for it."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, by its plain path."""
    place, system = _place(spark, path)
    return system.exists(place)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if there is no such folder."""
    place, system = _place(spark, path)
    return [found.getPath().getName() for found in system.listStatus(place)] if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder by its plain path, if it is there."""
    place, system = _place(spark, path)
    system.delete(place, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a folder, by plain paths. If ``new`` is a folder already, ``old`` goes into it or stays."""
    place, system = _place(spark, old)
    system.rename(place, _place(spark, new)[0])


def local_session(
    cpus: int | str = "*", name: str = "tidemark", conf: dict[str, str] | None = None
) -> SparkSession:
    """A ``local[n]`` session with the settings the tests and the bench rely on."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        **(conf or {}),
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
