import pytest

from rainledger.operators.latest import deleted_keys, drop_deletes, incremental, keep_latest, latest_state
from tests.helpers import plan, rows, ts


@pytest.fixture
def events(spark):
    return spark.createDataFrame(
        [("a", ts("01 10:00"), 1, "x"), ("a", ts("02 10:00"), 2, "y"), ("a", ts("02 10:00"), 3, "z"),
         ("b", None, 4, "w"), ("c", ts("03 00:00"), 5, None), (None, ts("01 00:00"), 6, "n"),
         (None, ts("04 00:00"), 7, "n")],
        "k string, at timestamp, uuid int, v string",
    )


def test_one_row_per_key_with_tie_break(events):
    assert rows(keep_latest(events, "k", "at", ("uuid",)), "k", "uuid") == [
        ("a", 3), ("b", 4), ("c", 5), (None, 7)]


def test_ties_without_named_columns_use_all_others(events):
    assert rows(keep_latest(events.filter("k = 'a'"), "k", "at"), "uuid") == [(3,)]


def test_all_ties_are_kept_and_null_keys_group(events):
    assert rows(keep_latest(events, "k", "at", ties="all"), "k", "uuid") == [
        ("a", 2), ("a", 3), ("b", 4), ("c", 5), (None, 7)]


def test_limit_runs_before_the_shuffle(events):
    assert plan(keep_latest(events.repartition(3), "k", "at")).count("WindowGroupLimit") == 2


def test_bounds_are_half_open(events):
    inside = incremental(events, "at", lo="2024-01-01 10:00:00", hi="2024-01-03 00:00:00")
    assert rows(inside, "uuid") == [(2,), (3,), (5,)]
    assert incremental(events, "at").count() == 7


def test_bound_without_offset_is_utc(events):
    assert rows(incremental(events, "at", lo="2024-01-03T00:00:00"), "uuid") == [(7,)]
    assert rows(incremental(events, "at", lo="2024-01-03T01:00:00+02:00"), "uuid") == [(5,), (7,)]


def test_bound_reaches_the_parquet_reader(spark):
    raw = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    text = plan(incremental(raw, "ts", lo="2024-01-20"))
    assert "GreaterThan(ts," in text


def test_deletes_and_unknown_operations_go(spark):
    df = spark.createDataFrame([(1, "DELETE"), (2, None), (3, "INSERT")], "id int, op string")
    assert rows(drop_deletes(df, "op"), "id") == [(3,)]


def test_deleted_keys_are_those_deleted_last(spark):
    df = spark.createDataFrame(
        [("a", ts("01 00:00"), "INSERT"), ("a", ts("02 00:00"), "DELETE"), ("b", ts("01 00:00"), "DELETE"),
         ("b", ts("02 00:00"), "INSERT")], "k string, at timestamp, change_type string")
    assert rows(deleted_keys(df, "k", "at"), "k") == [("a",)]


def test_latest_state_keeps_null_values_of_the_newest_row(spark):
    df = spark.createDataFrame([(1, ts("01 00:00"), "Rain"), (1, ts("02 00:00"), None), (2, None, "Fog")],
                               "city int, at timestamp, condition string")
    assert rows(latest_state(df, "city", "at", ["condition"]), "city", "condition") == [(1, None)]
