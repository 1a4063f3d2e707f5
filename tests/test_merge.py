"""The upsert against a plain Python model of MERGE, and what it rewrites."""

from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import DAY_1, DAY_2, data_files, plan, rows
from tidemark.operators.merge import (
    MergeConflict,
    check_single_match,
    conform,
    duplicate_keys,
    key_range,
    matched_keys,
    upsert,
)
from tidemark.operators.rows import dedupe_latest, enrich
from tidemark.sinks import silver
from tidemark.sinks.silver import (
    append_silver,
    apply,
    create_silver,
    merge_silver,
    overwrite_partitions,
    read_table,
    replace_silver,
    stage_merge,
)

SCHEMA = "a int, b string, v int"
maybe_int = st.none() | st.integers(0, 4)
maybe_text = st.none() | st.sampled_from("xyz")
row = st.tuples(maybe_int, maybe_text, st.integers(0, 99))


def merge_model(target, source, width):
    """MERGE on the first ``width`` columns; None if a target row matches twice."""

    def matches(t, s):
        return all(x is not None and x == y for x, y in zip(t[:width], s[:width]))

    result = []
    for t in target:
        found = [s for s in source if matches(t, s)]
        if len(found) > 1:
            return None
        result.append(found[0] if found else t)
    return result + [s for s in source if not any(matches(t, s) for t in target)]


def as_sorted(tuples):
    return sorted(tuples, key=lambda t: [(v is not None, str(v)) for v in t])


@settings(max_examples=8, deadline=None)
@given(
    target=st.lists(row, max_size=12),
    source=st.lists(row, max_size=8),
    keys=st.sampled_from([["a"], ["a", "b"]]),
)
def test_upsert_is_merge(spark, target, source, keys):
    old = spark.createDataFrame(target, SCHEMA)
    new = spark.createDataFrame(source, SCHEMA)
    expected = merge_model(target, source, len(keys))
    hits = matched_keys(old, new, keys)
    if expected is None:
        with pytest.raises(MergeConflict):
            check_single_match(new, hits, keys)
    else:
        check_single_match(new, hits, keys)
        got = [tuple(r) for r in upsert(old, new, keys).collect()]
        assert as_sorted(got) == as_sorted(expected)


@settings(max_examples=5, deadline=None)
@given(
    target=st.lists(row, min_size=1, max_size=12),
    source=st.lists(row, max_size=8),
    keys=st.sampled_from([["a"], ["a", "b"]]),
)
def test_merge_into_folders_is_merge(spark, tmp_path_factory, target, source, keys):
    """The same through folders, partitioned by the value column."""
    root = str(tmp_path_factory.mktemp("silver"))
    part = (F.col("v") % 3).cast("string").alias("p")
    old = spark.createDataFrame(target, SCHEMA).select("*", part)
    new = spark.createDataFrame(source, SCHEMA).select("*", part)
    schema = create_silver(old, root, ["p"])
    expected = merge_model(target, source, len(keys))
    if expected is None:
        with pytest.raises(MergeConflict):
            merge_silver(new, root, schema, keys, ["p"])
        return
    merge_silver(new, root, schema, keys, ["p"])
    got = [tuple(r) for r in read_table(spark, root, schema).collect()]
    assert as_sorted(got) == as_sorted([(*t, str(t[2] % 3)) for t in expected])


def test_key_range_keeps_every_match(spark):
    columns = (
        "i int, d decimal(9,2), s string, t date, n timestamp_ntz, z timestamp, f double"
    )
    values = spark.range(1, 60).selectExpr(
        "cast(id % 50 as int) i",
        "cast(id / 7 as decimal(9,2)) d",
        "concat('k ', char(60 + cast(id as int)), '\\'') s",
        "date '2024-01-01' + cast(id as int) t",
        "timestamp_ntz '2024-01-01 00:00:00.123456' + make_interval(0,0,0,0,id) n",
        "timestamp '2024-01-01 00:00:00' + make_interval(0,0,0,0,id) z",
        "cast(id as double) / 3 f",
    )
    some = values.filter("i between 11 and 17")
    for key in [c.split()[0] for c in columns.split(", ")]:
        near = values.filter(key_range(some, [key]))
        kept = matched_keys(near, some, [key])
        assert kept.count() == matched_keys(values, some, [key]).count() > 0
        pruned = key not in "zf"
        assert near.count() < values.count() if pruned else near.count() == values.count()
    assert values.filter(key_range(some.filter("i < 0"), ["i"])).isEmpty()


def test_duplicate_keys_ignore_null(spark):
    frame = spark.createDataFrame([(1, "x", 0)] * 3 + [(None, "x", 0)] * 2, SCHEMA)
    assert rows(duplicate_keys(frame, ["a", "b"])) == [(1, "x", 3)]


def test_unmatched_repeated_source_keys_are_inserted_twice(spark):
    old = spark.createDataFrame([(1, "x", 0)], SCHEMA)
    new = spark.createDataFrame([(2, "x", 1), (2, "x", 2)], SCHEMA)
    check_single_match(new, matched_keys(old, new, ["a"]), ["a"])
    assert rows(upsert(old, new, ["a"]), "a", "v") == [(1, 0), (2, 1), (2, 2)]


def test_keys_may_be_all_columns_and_have_odd_names(spark):
    old = spark.createDataFrame([(1, 2), (3, 4)], "`my id` int, `a.b` int")
    new = spark.createDataFrame([(1, 2), (5, 6)], "`my id` int, `a.b` int")
    assert rows(upsert(old, new, ["my id", "a.b"])) == [(1, 2), (3, 4), (5, 6)]
    assert rows(upsert(old, new, ["my id"])) == [(1, 2), (3, 4), (5, 6)]


def test_nested_values_are_carried(spark):
    old = spark.createDataFrame([(1, [1.0]), (2, None)], "k int, e array<float>")
    new = spark.createDataFrame([(2, [2.0])], "k int, e array<float>")
    assert [(r.k, r.e) for r in upsert(old, new, ["k"]).orderBy("k").collect()] == [
        (1, [1.0]),
        (2, [2.0]),
    ]


def test_matched_null_values_replace(spark):
    old = spark.createDataFrame([(1, "x", 5)], SCHEMA)
    new = spark.createDataFrame([(1, None, None)], SCHEMA)
    assert rows(upsert(old, new, ["a"])) == [(1, None, None)]


def test_conform(spark):
    target = spark.createDataFrame([], "a int, at timestamp_ntz").schema
    got = conform(spark.range(1).select(F.current_timestamp().alias("at"), F.lit(1).alias("a")), target)
    assert got.schema.simpleString() == "struct<a:int,at:timestamp_ntz>"
    for bad in (spark.range(1), spark.range(1).selectExpr("1 a", "null at", "2 extra")):
        with pytest.raises(ValueError, match="columns differ"):
            conform(bad, target)


def test_dedupe_keeps_rows_with_a_null_key(spark):
    frame = spark.createDataFrame(
        [(1, "x", 1), (1, "x", 9), (None, "x", 1), (None, "x", 1), (1, None, 3)], SCHEMA
    )
    assert rows(dedupe_latest(frame, ["a", "b"], [F.desc("v")])) == [
        (None, "x", 1),
        (None, "x", 1),
        (1, None, 3),
        (1, "x", 9),
    ]


def test_merge_rewrites_only_partitions_with_a_match(spark, tmp_path):
    root = str(tmp_path)
    days = spark.range(0, 32, 1, 4).withColumn("day", (F.col("id") % 2).cast("string"))
    schema = create_silver(days.withColumn("tag", F.lit("old")), root, ["day"])
    before = data_files(root)
    batch = spark.createDataFrame([(1, "9", "new"), (100, "9", "new")], "id long, day string, tag string")
    merge_silver(batch, root, schema, ["id"], ["day"])
    after = data_files(root)
    kept = {f for f in before if f in after}
    assert kept == {f for f in before if f.startswith("day=0")} and len(kept) == 4
    got = read_table(spark, root, schema)
    assert got.count() == 33
    assert rows(got.filter("tag = 'new'"), "id", "day") == [(1, "9"), (100, "9")]


def test_rows_that_are_there_already_stay_in_the_batchs_partition(spark, tmp_path):
    root = str(tmp_path)
    schema = create_silver(enrich(spark.range(3), DAY_1), root)
    append_silver(enrich(spark.range(10, 13), DAY_2), root, schema)
    merge_silver(enrich(spark.range(2, 5), DAY_2), root, schema, ["id"])
    assert rows(read_table(spark, root, schema), "id", "day") == [
        *((i, "01") for i in (0, 1)),
        *((i, "02") for i in (2, 3, 4, 10, 11, 12)),
    ]


def test_partitions_are_replaced_while_they_are_read(spark, tmp_path):
    root = str(tmp_path)
    schema = create_silver(spark.range(30).selectExpr("id", "0 v", "cast(id % 3 as string) p"), root, ["p"])
    for step in range(1, 4):
        part = read_table(spark, root, schema).filter(F.col("p") != "1").withColumn("v", F.col("v") + 1)
        overwrite_partitions(part, root, schema, ["p"])
        got = read_table(spark, root, schema).groupBy("p", "v").count()
        assert rows(got) == [("0", step, 10), ("1", 0, 10), ("2", step, 10)]


def test_a_merge_stopped_between_its_writes_can_be_repeated(spark, tmp_path, monkeypatch):
    """Applying stops after the new partitions, before, or in between; done again, the result is the same."""
    batch = enrich(spark.range(2, 8), DAY_2)
    expected = [(0, "01"), (1, "01"), *((i, "02") for i in range(2, 8))]

    def fresh(name):
        root = str(tmp_path / name)
        schema = create_silver(enrich(spark.range(3), DAY_1), root)
        append_silver(enrich(spark.range(4, 5), datetime(2026, 1, 5)), root, schema)
        table = spark.read.schema(schema).parquet(root)
        return root, schema, stage_merge(table, batch, schema, ["id"], str(tmp_path / f"{name}-staged"))

    root, schema, staged = fresh("once")
    assert len(staged.gone) == 1 and "day=05" in staged.gone[0]
    for _ in range(3):
        apply(spark, staged, root, schema)
        assert rows(read_table(spark, root, schema), "id", "day") == expected

    root, schema, staged = fresh("some")
    some = read_table(spark, staged.path, schema).filter("day = '02'")
    some.write.mode("overwrite").partitionBy("year", "month", "day").option("partitionOverwriteMode", "dynamic").parquet(root)
    assert rows(read_table(spark, root, schema), "id", "day") != expected
    apply(spark, staged, root, schema)
    assert rows(read_table(spark, root, schema), "id", "day") == expected


@pytest.mark.parametrize(
    "old, key, joins",
    [([1, 2, None], "bigint", 0), ([1, 2, 2], "bigint", 1), ([1, 2, None], "double", 1), ([5, 6], "bigint", 0)],
)
def test_a_batch_is_only_joined_where_a_key_matches_twice(spark, tmp_path, monkeypatch, old, key, joins):
    calls = []
    monkeypatch.setattr(silver, "FEW", -1)
    monkeypatch.setattr(silver, "upsert", lambda *args: calls.append(1) or upsert(*args))
    frame = lambda keys, v: spark.createDataFrame([(k, v) for k in keys], "k long, v int").select(
        F.col("k").cast(key), "v"
    )
    new = [2, 3, 3, None]
    schema = create_silver(enrich(frame(old, 0), DAY_1), str(tmp_path))
    merge_silver(enrich(frame(new, 1), DAY_2), str(tmp_path), schema, ["k"])
    result = merge_model([(k, 0, "01") for k in old], [(k, 1, "02") for k in new], 1)
    assert rows(read_table(spark, str(tmp_path), schema), "k", "v", "day") == as_sorted(result)
    assert len(calls) == joins


def test_a_table_can_be_replaced(spark, tmp_path):
    root = str(tmp_path)
    schema = create_silver(enrich(spark.range(3), DAY_1), root)
    append_silver(enrich(spark.range(3), DAY_2), root, schema)
    replace_silver(enrich(spark.range(7), DAY_2), root, schema)
    assert rows(read_table(spark, root, schema), "id", "day") == [(i, "02") for i in range(7)]


batch_rows = st.lists(st.tuples(st.integers(0, 30), st.integers(0, 2)), max_size=8)


@settings(max_examples=3, deadline=None)
@given(first=batch_rows, later=st.lists(batch_rows, min_size=3, max_size=3))
def test_many_merges(spark, tmp_path_factory, first, later):
    """A table follows a plain dictionary through merge after merge."""
    root = str(tmp_path_factory.mktemp("silver"))

    def frame(pairs, step):
        data = [(k, str(p), step) for k, p in pairs]
        return spark.createDataFrame(data, "k int, p string, step int").repartition(3, "k")

    model = {k: (k, str(p), 0) for k, p in dict(first).items()}
    schema = create_silver(frame(dict(first).items(), 0), root, ["p"])
    for step, pairs in enumerate(later, 1):
        unique = dict(pairs)
        merge_silver(frame(unique.items(), step), root, schema, ["k"], ["p"])
        model.update({k: (k, str(p), step) for k, p in unique.items()})
        assert rows(read_table(spark, root, schema), "k", "p", "step") == sorted(model.values())


def test_a_partition_that_loses_every_row_is_dropped(spark, tmp_path):
    root = str(tmp_path)
    schema = create_silver(enrich(spark.range(3), DAY_1), root)
    merge_silver(enrich(spark.range(3), DAY_2), root, schema, ["id"])
    assert all("day=02" in f for f in data_files(root))
    assert read_table(spark, root, schema).count() == 3


def test_merge_into_and_from_nothing(spark, tmp_path):
    root = str(tmp_path)
    schema = create_silver(enrich(spark.range(0), DAY_1), root)
    assert read_table(spark, root, schema).isEmpty()
    merge_silver(enrich(spark.range(2), DAY_1), root, schema, ["id"])
    before = data_files(root)
    merge_silver(enrich(spark.range(0), DAY_2), root, schema, ["id"])
    assert data_files(root) == before
    assert read_table(spark, root, schema).count() == 2


def test_conflict_leaves_the_table_as_it_was(spark, tmp_path):
    root = str(tmp_path)
    schema = create_silver(enrich(spark.range(3), DAY_1), root)
    before = data_files(root)
    twice = enrich(spark.range(1).union(spark.range(1)), DAY_2)
    with pytest.raises(MergeConflict, match="id=0"):
        merge_silver(twice, root, schema, ["id"])
    assert data_files(root) == before


def test_appends_share_a_partition(spark, tmp_path):
    root = str(tmp_path)
    schema = create_silver(enrich(spark.range(3), DAY_1), root)
    append_silver(enrich(spark.range(2), DAY_1), root, schema)
    assert read_table(spark, root, schema).count() == 5


def test_reads_prune(spark, tmp_path):
    root = str(tmp_path)
    schema = create_silver(enrich(spark.range(3), DAY_1), root)
    append_silver(enrich(spark.range(2), DAY_2), root, schema)
    day = read_table(spark, root, schema).filter(F.col("day") == "02")
    assert day.count() == 2
    assert "PartitionFilters: [isnotnull(day" in plan(day)


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("string", ["a b", "x/y", "p=q", "%", "[z]", "ü", None]),
        ("boolean", [True, False, None]),
        ("double", [1e10, 0.5, -3.0, None]),
        ("date", ["2024-01-31", None]),
        ("int", [0, -7, None]),
    ],
)
def test_partition_values_of_any_kind(spark, tmp_path, kind, values):
    """Folders are taken as Spark named them, for all writes."""
    root = str(tmp_path / "silver")

    def frame(first, tag):
        data = [(first + i, v if v is None else str(v), tag) for i, v in enumerate(values)]
        df = spark.createDataFrame(data, "id int, p string, tag string")
        return df.withColumn("p", F.col("p").cast(kind))

    def shown():
        return {(r["id"], str(r["p"]), r["tag"]) for r in read_table(spark, root, schema).collect()}

    def expected(first, tag):
        return {(r["id"], str(r["p"]), r["tag"]) for r in frame(first, tag).collect()}

    schema = create_silver(frame(0, "a"), root, ["p"])
    assert shown() == expected(0, "a")
    append_silver(frame(100, "b"), root, schema, ["p"])
    merge_silver(frame(0, "c").limit(1), root, schema, ["id"], ["p"])
    one = {x for x in expected(0, "c") if x[0] == 0}
    rest = {x for x in expected(0, "a") if x[0] != 0}
    assert shown() == one | rest | expected(100, "b")
    overwrite_partitions(frame(200, "d"), root, schema, ["p"])
    assert shown() == expected(200, "d")
    # All rows go to the first partition, so that the others are dropped by name.
    there = frame(200, "e").withColumn("p", F.lit(values[0]).cast(kind))
    merge_silver(there, root, schema, ["id"], ["p"])
    assert {p for _, p, _ in shown()} == {str(frame(0, "a").first()["p"])}
    assert len({f.split("/")[0] for f in data_files(root)}) == 1


def test_upsert_fails_on_a_key_that_matches_twice(spark):
    old = spark.createDataFrame([(1, "x", 0)], SCHEMA)
    new = spark.createDataFrame([(1, "x", 1), (1, "x", 2)], SCHEMA)
    with pytest.raises(Exception, match="several source rows match one target row"):
        upsert(old, new, ["a"]).collect()


def test_keys_may_be_repeated_and_in_any_case(spark, tmp_path):
    old = spark.createDataFrame([(1, "x", 0), (2, "y", 0)], SCHEMA)
    new = spark.createDataFrame([(2, "z", 1)], "A int, B string, V int")
    assert rows(upsert(old, new, ["a", "A", "a"])) == [(1, "x", 0), (2, "z", 1)]
    part = F.lit("1").alias("p")
    schema = create_silver(old.select("*", part), str(tmp_path), ["p"])
    merge_silver(new.select("*", part), str(tmp_path), schema, ["A", "a"], ["p"])
    assert rows(read_table(spark, str(tmp_path), schema), "a", "b", "v") == [(1, "x", 0), (2, "z", 1)]
    with pytest.raises(ValueError, match="does not have"):
        merge_silver(new.select("*", part), str(tmp_path), schema, ["nope"], ["p"])
