from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import DAY_1, DAY_2, data_files, plan, rows
from tidemark.operators.rows import day_slice, enrich
from tidemark.sinks.bronze import write_bronze
from tidemark.sources.bronze import landed_days, read_bronze
from tidemark.sources.files import list_files


def test_envelope_is_one_utc_time(spark):
    seoul = timezone(timedelta(hours=9))
    got = enrich(spark.range(2), datetime(2026, 3, 1, 8, 30, tzinfo=seoul))
    expected = (datetime(2026, 2, 28, 23, 30), "2026", "02", "28")
    assert rows(got) == [(0, *expected), (1, *expected)]
    assert got.schema["_ingestion_time"].dataType.simpleString() == "timestamp_ntz"


def test_envelope_does_not_shift_with_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    try:
        got = enrich(spark.range(1), datetime(2026, 1, 1, 23))
        assert rows(got, "year", "month", "day") == [("2026", "01", "01")]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_source_columns_of_the_same_name_are_replaced(spark):
    source = spark.range(1).withColumn("year", F.lit(1999))
    assert rows(enrich(source, DAY_1), "year") == [("2026",)]


def test_two_appends_on_one_day_add_up(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        write_bronze(enrich(spark.range(3), DAY_1), path, "append")
    assert read_bronze(spark, path).count() == 6


def test_overwrite_leaves_other_days_files_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bronze(enrich(spark.range(3), DAY_1), path, "overwrite")
    before = data_files(path)
    write_bronze(enrich(spark.range(5), DAY_2), path, "overwrite")
    write_bronze(enrich(spark.range(7, 9), DAY_2), path, "overwrite")
    after = data_files(path)
    assert before.items() <= after.items()
    assert rows(read_bronze(spark, path), "id", "day") == [
        (0, "01"),
        (1, "01"),
        (2, "01"),
        (7, "02"),
        (8, "02"),
    ]


def test_overwrite_with_nothing_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bronze(enrich(spark.range(3), DAY_1), path, "overwrite")
    before = data_files(path)
    write_bronze(enrich(spark.range(0), DAY_1), path, "overwrite")
    assert data_files(path) == before


def test_modes_are_checked(spark):
    with pytest.raises(ValueError, match="unknown write mode"):
        write_bronze(spark.range(1), "/nowhere", "ignore")


def test_day_parts_stay_padded_text_and_prune(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bronze(enrich(spark.range(3), DAY_1), path, "append")
    write_bronze(enrich(spark.range(5), DAY_2), path, "append")
    everything = read_bronze(spark, path)
    assert {f.name: f.dataType.simpleString() for f in everything.schema}["day"] == "string"
    day = day_slice(everything, DAY_2)
    assert day.count() == 5
    text = plan(day)
    assert "PartitionFilters: [isnotnull" in text and "(day#" in text
    assert "Filter" not in text.replace("PartitionFilters", "").replace("PushedFilters", "")


def test_one_day_is_opened_by_its_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bronze(enrich(spark.range(3), DAY_1), path, "append")
    write_bronze(enrich(spark.range(5), DAY_2), path, "append")
    day = read_bronze(spark, path, run_ts=DAY_2)
    assert rows(day, "id", "year", "month", "day")[0] == (0, "2026", "01", "02")
    assert all("day=02" in f for f in day.inputFiles())
    assert len(day.inputFiles()) > 0


def test_landed_days_change_with_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bronze(enrich(spark.range(3), DAY_1), path, "append")
    write_bronze(enrich(spark.range(5), DAY_2), path, "append")
    first, second = "year=2026/month=01/day=01", "year=2026/month=01/day=02"
    before = landed_days(spark, path)
    assert set(before) == {first, second} and before == landed_days(spark, path)
    write_bronze(enrich(spark.range(5), DAY_2), path, "overwrite")
    after = landed_days(spark, path)
    assert after[first] == before[first] and after[second] != before[second]
    write_bronze(enrich(spark.range(1), DAY_1), path, "append")
    assert landed_days(spark, path)[first] != after[first]

    some = read_bronze(spark, path, days=[second])
    assert some.count() == 5
    assert all("day=02" in f for f in some.inputFiles())
    none = read_bronze(spark, path, days=[])
    assert none.isEmpty() and none.schema == some.schema


def test_listings_open_no_file(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bronze(enrich(spark.range(0, 40, 1, 4), DAY_1), path, "append")
    for file in data_files(path):
        (tmp_path / "t" / file).write_bytes(b"not parquet any more")
    assert list(landed_days(spark, path)) == ["year=2026/month=01/day=01"]
    text = plan(list_files(spark, [path]))
    assert "Scan binaryFile" in text and "content" not in text and "Aggregate" not in text


@pytest.mark.parametrize("attempt", range(10))
def test_a_column_that_only_some_files_have_is_never_lost(spark, tmp_path, attempt):
    """File names decide which file a reader samples first, and they are random."""
    path = str(tmp_path / "t")
    wider = spark.range(3, 5).withColumn("extra", F.lit("x"))
    first, second = (spark.range(3), wider) if attempt % 2 else (wider, spark.range(3))
    write_bronze(enrich(first, DAY_1), path, "append")
    write_bronze(enrich(second, DAY_1), path, "append")
    write_bronze(enrich(spark.range(1), DAY_2), path, "append")
    for df in (read_bronze(spark, path), read_bronze(spark, path, run_ts=DAY_1)):
        assert "extra" in df.columns
        assert df.filter("extra = 'x'").count() == 2
    assert "extra" not in read_bronze(spark, path, run_ts=DAY_2).columns


def test_a_day_without_data_is_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    write_bronze(enrich(spark.range(3), DAY_1), path, "append")
    day = read_bronze(spark, path, run_ts=DAY_2)
    assert day.isEmpty()
    assert day.columns == ["id", "_ingestion_time", "year", "month", "day"]
