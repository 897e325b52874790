import pytest
from pyspark.errors import UnsupportedOperationException

from rainledger.operators.merge import merge_delete, merge_insert_only, merge_into_catalog, merge_upsert
from tests.helpers import rows, ts

COLS = "id string, status string, kept string, updated_at timestamp"


@pytest.fixture
def target(spark):
    return spark.createDataFrame(
        [("newer", "old", "t", ts("02 00:00")), ("equal", "old", "t", ts("02 00:00")),
         ("stale", "old", "t", ts("02 00:00")), ("null_source", "old", "t", ts("02 00:00")),
         ("null_target", "old", "t", None), ("alone", "old", "t", ts("02 00:00")), (None, "old", "t", None)], COLS)


@pytest.fixture
def source(spark):
    return spark.createDataFrame(
        [("newer", "new", "s", ts("03 00:00")), ("equal", "new", "s", ts("02 00:00")),
         ("stale", "new", "s", ts("01 00:00")), ("null_source", "new", "s", None),
         ("null_target", "new", "s", ts("03 00:00")), ("unseen", "new", "s", None), (None, "new", "s", None)], COLS)


def upsert(target, source):
    return merge_upsert(target, source, "id", "updated_at", ["status", "updated_at"])


def test_upsert(target, source):
    assert rows(upsert(target, source), "id", "status", "kept") == sorted(
        [("newer", "new", "t"), ("equal", "old", "t"), ("stale", "old", "t"), ("null_source", "old", "t"),
         ("null_target", "old", "t"), ("alone", "old", "t"), ("unseen", "new", "s"), (None, "old", "t"),
         (None, "new", "s")], key=repr)


def test_merges_are_idempotent(target, source):
    target, source = target.dropna(subset="id"), source.dropna(subset="id")
    once = upsert(target, source)
    assert rows(upsert(once, source)) == rows(once)
    once = merge_insert_only(target, source, "id")
    assert rows(merge_insert_only(once, source, "id")) == rows(once)


def test_insert_only_never_changes_rows(target, source):
    merged = merge_insert_only(target.dropna(subset="id"), source, "id")
    assert ("newer", "old") in rows(merged, "id", "status")
    assert ("unseen", "new") in rows(merged, "id", "status")
    assert merged.count() == 8


def test_empty_sides(spark, target, source):
    none = spark.createDataFrame([], target.schema)
    assert rows(upsert(none, source)) == rows(source)
    assert rows(upsert(target, none)) == rows(target)


def test_delete(spark, target):
    gone = spark.createDataFrame([("newer",), ("other",)], "id string")
    assert merge_delete(target, gone, "id").count() == 6


def test_catalog_merge_needs_a_table_that_supports_it(spark, target, source):
    target.dropna(subset="id").write.mode("overwrite").saveAsTable("merge_target")
    with pytest.raises(UnsupportedOperationException, match="MERGE INTO TABLE"):
        merge_into_catalog(source, "merge_target", "id", "updated_at", ["status", "updated_at"])
