import random
from datetime import datetime, timedelta

import pytest

from rainledger.operators.quality import check_scd2
from rainledger.operators.scd2 import (
    current,
    late_events,
    scd2_apply,
    scd2_close,
    scd2_history,
    scd2_open,
)
from tests.helpers import rows, ts

DIM = "k int, category string, price double, valid_from timestamp, valid_to timestamp, is_current boolean"
EVENT = "k int, category string, price double, source_timestamp timestamp"
TRACKED = ["category", "price"]


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [(1, "a", 1.0, ts("01 00:00"), ts("02 00:00"), False), (1, "b", 1.0, ts("02 00:00"), None, True),
         (2, "a", 1.0, ts("01 00:00"), None, True), (3, None, 1.0, ts("01 00:00"), None, True),
         (4, "a", None, ts("01 00:00"), None, True), (5, "a", 1.0, ts("05 00:00"), None, True)], DIM)


@pytest.fixture
def batch(spark):
    return spark.createDataFrame(
        [(1, "c", 1.0, ts("10 00:00")), (2, "a", 1.0, ts("10 00:00")), (3, "x", 1.0, ts("10 00:00")),
         (4, "a", 2.0, ts("10 00:00")), (5, "z", 1.0, ts("03 00:00")), (6, "n", None, ts("10 00:00"))], EVENT)


def test_apply(dim, batch):
    after = rows(scd2_apply(dim, batch, "k", TRACKED), "k", "category", "price", "valid_from", "valid_to", "is_current")
    t10 = ts("10 00:00")
    assert after == sorted(
        [(1, "a", 1.0, ts("01 00:00"), ts("02 00:00"), False), (1, "b", 1.0, ts("02 00:00"), t10, False),
         (1, "c", 1.0, t10, None, True), (2, "a", 1.0, ts("01 00:00"), None, True),
         # from and to NULL are changes
         (3, None, 1.0, ts("01 00:00"), t10, False), (3, "x", 1.0, t10, None, True),
         (4, "a", None, ts("01 00:00"), t10, False), (4, "a", 2.0, t10, None, True),
         # earlier than the open version: ignored
         (5, "a", 1.0, ts("05 00:00"), None, True), (6, "n", None, t10, None, True)], key=repr)


def test_apply_is_idempotent_and_keeps_invariants(dim, batch):
    once = scd2_apply(dim, batch, "k", TRACKED)
    assert rows(scd2_apply(once, batch, "k", TRACKED)) == rows(once)
    assert all(n == 0 for _, n in rows(check_scd2(once, "k")))


def test_event_at_the_open_versions_start_is_late(spark, dim):
    event = spark.createDataFrame([(2, "b", 1.0, ts("01 00:00"))], EVENT)
    assert rows(scd2_apply(dim, event, "k", TRACKED)) == rows(dim)
    assert rows(late_events(current(dim), event, "k"), "k") == [(2,)]


def test_strict_mode_reproduces_value_based_classification(dim, batch):
    after = scd2_apply(dim, batch, "k", TRACKED, strict_ref=True)
    # NULL first tracked value: taken for new, so two open versions
    assert rows(current(after).filter("k = 3"), "category") == [("x",), (None,)]
    # NULL price: change unseen
    assert rows(current(after).filter("k = 4"), "price") == [(None,)]
    # late event applied: the closed version ends before it starts
    assert rows(after.filter("k = 5 AND NOT is_current AND valid_to < valid_from"), "k") == [(5,)]
    assert dict(rows(check_scd2(after, "k")))["several_open"] == 1
    assert dict(rows(check_scd2(after, "k")))["bad_interval"] == 1


def test_first_batch_into_an_empty_table(spark, dim, batch):
    empty = spark.createDataFrame([], dim.schema)
    assert rows(scd2_apply(empty, batch, "k", TRACKED)) == rows(
        scd2_open(batch, "source_timestamp").select(*dim.columns))


def test_close(spark, dim):
    gone = spark.createDataFrame([(2, ts("06 00:00")), (5, ts("04 00:00"))], "k int, at timestamp")
    after = scd2_close(dim, gone, "k", "at")
    assert rows(after.filter("k = 2"), "valid_to", "is_current") == [(ts("06 00:00"), False)]
    # a delete older than the open version does not end it
    assert rows(after.filter("k = 5"), "valid_to", "is_current") == [(None, True)]


def brute_history(events):
    """Versions by walking each key's events in time order."""
    out = []
    for key in sorted({e[0] for e in events}):
        versions, last = [], object()
        for _, value, at in sorted((e for e in events if e[0] == key), key=lambda e: e[2]):
            if value != last:
                versions.append((key, value, at))
                last = value
        for i, (k, v, start) in enumerate(versions):
            end = versions[i + 1][2] if i + 1 < len(versions) else None
            out.append((k, v, start, end, end is None))
    return sorted(out, key=repr)


def random_events(seed, n=300, keys=4):
    rng = random.Random(seed)
    seen, out = set(), []
    while len(out) < n:
        # key 0 holds most events; several share an hour or a day
        key = 0 if rng.random() < 0.5 else rng.randrange(keys)
        at = datetime(2024, 1, 1) + timedelta(minutes=rng.randrange(60 * 24 * 6))
        if (key, at) not in seen:
            seen.add((key, at))
            out.append((key, rng.choice(["a", "b", None]), at))
    return out


@pytest.mark.parametrize("bucket", ["hour", "day", "year"])
def test_history_against_brute_force(spark, bucket):
    events = random_events(7)
    df = spark.createDataFrame(events, "k int, category string, source_timestamp timestamp").repartition(5)
    # copies change nothing
    history = scd2_history(df.union(df).union(df), "k", ["category"], bucket=bucket)
    assert rows(history, "k", "category", "valid_from", "valid_to", "is_current") == brute_history(events)
    assert all(n == 0 for _, n in rows(check_scd2(history, "k")))


def test_history_resolves_tied_events_and_skips_missing_keys(spark):
    df = spark.createDataFrame(
        [(1, "b", 1, ts("01 00:00")), (1, "a", 2, ts("01 00:00")), (1, "c", 3, ts("02 00:00")), (None, "x", 4, ts("01 00:00")),
         (1, "y", 5, None)], "k int, category string, uuid int, source_timestamp timestamp")
    assert rows(scd2_history(df, "k", ["category"], tie_cols=("uuid",)), "k", "category") == [(1, "a"), (1, "c")]
    assert rows(scd2_history(df, "k", ["category"]), "k", "category") == [(1, "b"), (1, "c")]


@pytest.mark.parametrize("seed", [1, 2])
def test_folding_single_event_batches_gives_the_history(spark, seed):
    """Whatever the batches, one event per key and batch applied in order is the full history."""
    rng = random.Random(seed)
    events, target = [], None
    for step in range(4):
        at = datetime(2024, 1, 1) + timedelta(hours=step * 7)
        part = [(k, rng.choice(["a", "b", None]), at) for k in range(3) if rng.random() < 0.8]
        events += part
        batch = spark.createDataFrame(part, "k int, category string, source_timestamp timestamp")
        if target is None:
            target = spark.createDataFrame([], "k int, category string, valid_from timestamp, valid_to timestamp, is_current boolean")
        target = scd2_apply(target, batch, "k", ["category"])
    df = spark.createDataFrame(events, "k int, category string, source_timestamp timestamp")
    assert rows(target) == rows(scd2_history(df, "k", ["category"]).select(*target.columns))


def test_invariant_checks_find_violations(spark):
    bad = spark.createDataFrame(
        [(1, "a", 1.0, ts("01 00:00"), ts("03 00:00"), False), (1, "b", 1.0, ts("02 12:00"), None, True),
         (1, "c", 1.0, ts("05 00:00"), None, True), (2, "a", 1.0, ts("04 00:00"), ts("03 00:00"), False),
         (3, "a", 1.0, ts("01 00:00"), ts("02 00:00"), False), (3, "b", 1.0, ts("02 00:00"), None, True)], DIM)
    assert dict(rows(check_scd2(bad, "k"))) == {"several_open": 1, "no_open": 1, "overlap": 2, "bad_interval": 1}
