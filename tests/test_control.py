from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import state as state_module
from tidemark.operators import control as ctl
from tidemark.sources.extract import checked_load_type, extract, is_unset
from tidemark.state import ControlTable

ROWS = [
    ("orders", "incremental", "2001-01-01 00:00:00", "o_orderdate", "o_orderkey", "00"),
    ("customer", "full", None, None, "c_custkey", "01"),
    ("lineitem", "INCREMENTAL", "", "l_shipdate", "l_orderkey | l_linenumber", "02"),
    ("events", "INCREMENTAL", "2024-01-15 00:00:00", "ts", "", "02"),
]


@pytest.fixture(scope="module")
def control(spark):
    return spark.createDataFrame(ROWS, ctl.CONTROL_SCHEMA)


def test_lookup_upper_cases_the_load_type(control):
    assert ctl.only_row(ctl.control_lookup(control, "orders"), "orders")["load_type"] == (
        "INCREMENTAL"
    )


def test_lookup_of_an_unregistered_table_fails(control):
    with pytest.raises(ctl.ControlError, match="not in the control table"):
        ctl.only_row(ctl.control_lookup(control, "nation"), "nation")


def test_lookup_with_several_rows_fails(control):
    twice = control.unionByName(control)
    with pytest.raises(ctl.ControlError, match="more than one"):
        ctl.only_row(ctl.control_lookup(twice, "orders"), "orders")


def test_table_names_are_values_and_never_sql(control):
    assert ctl.control_lookup(control, "x' OR '1'='1").isEmpty()


def test_ready(control):
    assert rows(ctl.control_ready(control)) == [("events",), ("lineitem",)]


def test_key_list(spark, control):
    assert rows(ctl.key_list(control)) == [
        ("customer", 1, "c_custkey"),
        ("lineitem", 1, "l_orderkey"),
        ("lineitem", 2, "l_linenumber"),
        ("orders", 1, "o_orderkey"),
    ]
    odd = ["", None, "None", " | ", "|", "  ", "b|a", " a || c|"]
    frame = spark.createDataFrame(
        [(str(i), "FULL", None, None, k, "00") for i, k in enumerate(odd)],
        ctl.CONTROL_SCHEMA,
    )
    assert rows(ctl.key_list(frame)) == [
        ("6", 1, "b"),
        ("6", 2, "a"),
        ("7", 1, "a"),
        ("7", 2, "c"),
    ]


def test_advance_moves_only_from_the_expected_status(control):
    moved = ctl.advance_status(control, "customer", "01", "02")
    assert dict(rows(moved, "table_name", "process_number"))["customer"] == "02"
    for unmoved in (
        ctl.advance_status(control, "customer", "00", "01"),
        ctl.advance_status(control, "nation", "00", "01"),
    ):
        assert rows(unmoved) == rows(control)


def test_reset_by_names_and_by_frame(control):
    by_name = ctl.reset_status(control, ["lineitem", "orders"])
    expected = {"orders": "00", "customer": "01", "lineitem": "00", "events": "02"}
    assert dict(rows(by_name, "table_name", "process_number")) == expected
    batch = control.filter(F.col("table_name").isin("lineitem", "orders"))
    by_frame = ctl.reset_status(control, batch.unionByName(batch))
    assert by_frame.columns == control.columns
    assert rows(by_frame) == rows(by_name)


@pytest.mark.parametrize("value", [None, "NONE", " full", "delta", ""])
def test_unknown_load_types(value):
    with pytest.raises(ValueError, match="unknown load_type"):
        checked_load_type(value)


def test_unset_marks():
    assert [is_unset(v) for v in (None, "", "None", "0", " ")] == [True] * 3 + [False] * 2


def test_a_mark_without_a_column_fails(spark):
    row = dict(zip(ctl.CONTROL_SCHEMA.names, ("t", "INCREMENTAL", "5", None, None, "00")))
    with pytest.raises(ValueError, match="source_dt_col"):
        extract(spark, None, row)


# ---- the control table as commits ---------------------------------------------------


@pytest.fixture
def state(spark, tmp_path, control):
    table = ControlTable(spark, str(tmp_path / "control"))
    table.create(control)
    return table


def test_create_refuses_an_existing_table(state, control):
    with pytest.raises(ctl.ControlError, match="already exists"):
        state.create(control)


def test_without_a_table_there_is_no_state(spark, tmp_path):
    with pytest.raises(ctl.ControlError, match="no control table"):
        ControlTable(spark, str(tmp_path / "nothing")).lookup("orders")


def test_commit_counts_what_moved(state):
    def advance(table, current, new):
        return state.commit([table], lambda df: ctl.advance_status(df, table, current, new))

    assert advance("orders", "00", "01") == 1
    assert advance("orders", "00", "01") == 0
    assert state.lookup("orders")["process_number"] == "01"
    assert state.lookup("customer")["process_number"] == "01"


def test_commit_covers_several_tables_at_once(state, tmp_path):
    state.commit(
        ["lineitem", "events"],
        lambda df: ctl.reset_status(df, ["lineitem", "events"]),
        gold={"lineitem": "a", "events": "b"},
    )
    assert sorted(f for f in os.listdir(tmp_path / "control")) == ["commit=1", "commit=2"]
    files = [f for f in os.listdir(tmp_path / "control" / "commit=2") if f.endswith(".parquet")]
    assert len(files) == 1
    assert state.ready() == []
    assert state.lookup("events")["gold"] == "b"
    assert state.lookup("orders")["gold"] is None


def test_keys_come_with_the_lookup(state):
    assert state.lookup("lineitem")["keys"] == ["l_orderkey", "l_linenumber"]
    assert state.lookup("events")["keys"] == []


def test_register_keeps_what_is_remembered(state, spark):
    state.commit(["orders"], silver={"orders": "schema"})
    changed = [("orders", "FULL", None, None, None, "00"), ("new", "FULL", *[None] * 3, "00")]
    state.register(spark.createDataFrame(changed, ctl.CONTROL_SCHEMA))
    assert state.lookup("orders")["load_type"] == "FULL"
    assert state.lookup("orders")["silver"] == "schema"
    assert state.lookup("new")["silver"] is None
    assert state.current().count() == 5


def test_two_writers_of_one_number_leave_one_winner(state):
    """Both read the same commit; the second applies its change to what the first left."""
    real, once = state._write, []

    def late(rows, n):
        if not once:
            once.append(n)
            other = ControlTable(state.spark, state.path)
            assert other.commit(["orders"], lambda df: ctl.advance_status(df, "orders", "00", "01")) == 1
        return real(rows, n)

    state._write = late
    assert state.commit(["orders"], lambda df: ctl.advance_status(df, "orders", "00", "01")) == 0
    assert state.lookup("orders")["process_number"] == "01"
    assert state._last() == 3


def test_a_number_that_exists_is_refused(state):
    rows = state.current()
    assert state._write(rows, 2)
    assert not state._write(rows.withColumn("process_number", F.lit("99")), 2)
    assert state.lookup("orders")["process_number"] == "00"


def test_runs_on_different_tables_may_commit_at_once(state):
    def advance(table):
        return state.commit([table], lambda df: ctl.advance_status(df, table, "02", "00"))

    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(advance, ["lineitem", "events", "lineitem", "events"])).count(1) == 2
    assert state.ready() == []


def test_an_unfinished_commit_is_waited_for_and_can_be_abandoned(state, tmp_path, monkeypatch):
    monkeypatch.setattr(state_module, "PAUSE", 0.0)
    (tmp_path / "control" / "commit=2").mkdir()
    assert state.lookup("orders")["process_number"] == "00"
    with pytest.raises(ctl.ControlError, match="commit 2 is being written"):
        state.commit(["orders"], process_number={"orders": "01"})
    with pytest.raises(ctl.ControlError, match="complete"):
        state.abandon(1)
    state.abandon(2)
    state.commit(["orders"], process_number={"orders": "01"})
    assert state.lookup("orders")["process_number"] == "01"


def test_a_failed_change_leaves_no_commit(state, tmp_path):
    bad = lambda df: df.withColumn("process_number", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        state.commit(["orders"], bad)
    assert os.listdir(tmp_path / "control") == ["commit=1"]


def test_two_files_in_one_commit_are_refused(state, tmp_path):
    state.current().write.mode("append").parquet(str(tmp_path / "control" / "commit=1"))
    with pytest.raises(ctl.ControlError, match="at once"):
        state.lookup("orders")


def test_old_commits_go(state, tmp_path, monkeypatch):
    monkeypatch.setattr(state_module, "KEPT", 3)
    for status in "456789":
        state.commit(["orders"], process_number={"orders": status})
    assert sorted(os.listdir(tmp_path / "control")) == ["commit=5", "commit=6", "commit=7"]
    assert state.lookup("orders")["process_number"] == "9"


def test_a_table_with_two_rows_is_refused(spark, tmp_path, control):
    table = ControlTable(spark, str(tmp_path / "twice"))
    table.create(control.unionByName(control.filter("table_name = 'events'")))
    for step in (lambda: table.lookup("events"), table.ready):
        with pytest.raises(ctl.ControlError, match="more than one"):
            step()
    assert table.lookup("orders")["load_type"] == "INCREMENTAL"


def test_keys_lose_all_white_space(spark):
    control = spark.createDataFrame([("t", "FULL", None, None, "a |\tb\n|\u00a0 c\r|\t| a", "00")], ctl.CONTROL_SCHEMA)
    assert [(r["pos"], r["key_col"]) for r in ctl.key_list(control).collect()] == [(1, "a"), (2, "b"), (3, "c"), (4, "a")]
