import random
from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from rainledger import bindings as b
from rainledger.operators.asof import BLOCK, asof_scd2, laid_out, open_shares, unmatched
from tests.helpers import plan, rows, ts

DIM = "k int, city int, valid_from timestamp, valid_to timestamp, is_current boolean"


@pytest.fixture
def dim(spark):
    return spark.createDataFrame(
        [(1, 10, ts("02 00:00"), ts("05 00:00"), False), (1, 20, ts("05 00:00"), None, True),
         (2, 30, ts("01 00:00"), ts("03 00:00"), False), (None, 99, ts("01 00:00"), None, True)], DIM)


@pytest.fixture
def facts(spark):
    return spark.createDataFrame(
        [("before", 1, ts("01 23:59")), ("at_start", 1, ts("02 00:00")), ("at_end", 1, ts("05 00:00")),
         ("open", 1, ts("20 00:00")), ("ended", 2, ts("03 00:00")), ("inside", 2, ts("02 00:00")),
         ("no_key", None, ts("02 00:00")), ("no_time", 1, None), ("unknown", 3, ts("02 00:00"))],
        "id string, k int, at timestamp")


@pytest.mark.parametrize("nested", [False, True])
def test_kinds(dim, facts, nested):
    matched = [("at_end", 20), ("at_start", 10), ("inside", 30), ("open", 20)]
    lost = ["before", "ended", "no_key", "no_time", "unknown"]
    assert rows(asof_scd2(facts, dim, "k", "at", nested=nested), "id", "city") == matched
    assert rows(asof_scd2(facts, dim, "k", "at", "left", nested), "id", "city") == sorted(
        matched + [(i, None) for i in lost], key=repr)
    assert rows(asof_scd2(facts, dim, "k", "at", "left_semi", nested), "id") == sorted((i,) for i, _ in matched)
    assert rows(unmatched(facts, dim, "k", "at", nested), "id") == [(i,) for i in lost]


@pytest.mark.parametrize("nested", [False, True])
def test_against_brute_force(spark, nested):
    rng, start = random.Random(3), datetime(2024, 1, 1)
    versions = []
    for key in range(3):
        cuts = sorted({start + timedelta(minutes=rng.randrange(6000)) for _ in range(30)})
        for i, cut in enumerate(cuts):
            end = cuts[i + 1] if i + 1 < len(cuts) else None
            if rng.random() < 0.8:  # leave gaps
                versions.append((key, rng.randrange(100), cut, end, end is None))
    facts = [(i, rng.randrange(3), start + timedelta(minutes=rng.randrange(7000))) for i in range(400)]
    facts += [(1000 + i, 0, facts[0][2]) for i in range(50)]  # copies of one instant
    want = sorted(
        (i, city) for i, k, at in facts for key, city, lo, hi, _ in versions
        if key == k and at >= lo and (hi is None or at < hi))
    left = spark.createDataFrame(facts, "id int, k int, at timestamp")
    assert sorted(rows(asof_scd2(left, spark.createDataFrame(versions, DIM), "k", "at", nested=nested), "id", "city")) == want


@pytest.mark.parametrize("nested", [False, True])
@pytest.mark.parametrize("versions", [5, 400])
def test_rough_versions_match_alike_at_every_size(spark, nested, versions):
    """Overlapping, empty, negative and open intervals, on shallow and on deep keys."""
    rng, start = random.Random(versions), datetime(2024, 1, 1)
    dims = []
    for i in range(versions):
        lo = start + timedelta(minutes=rng.randrange(8000))
        hi = lo + timedelta(minutes=rng.choice([-60, 0, 1, 90, 4000]))
        dims.append((0, i, lo, None if rng.random() < 0.05 else hi, False))
    facts = [(i, 0, start + timedelta(minutes=rng.randrange(-100, 9000))) for i in range(60)]
    want = sorted((i, c) for i, _, at in facts for _, c, lo, hi, _ in dims if at >= lo and (hi is None or at < hi))
    left = spark.createDataFrame(facts, "id int, k int, at timestamp")
    assert sorted(rows(asof_scd2(left, spark.createDataFrame(dims, DIM), "k", "at", nested=nested), "id", "city")) == want


def test_overlapping_versions_multiply_in_the_general_join(spark, facts):
    twice = spark.createDataFrame([(1, 1, ts("01 00:00"), None, True), (1, 2, ts("01 00:00"), None, True)], DIM)
    assert len(rows(asof_scd2(facts.filter("id = 'open'"), twice, "k", "at"))) == 2


LENGTHS = [1, 16, 17, 10**6, 3_600_000_000, 86_400_000_000, 10 * 366 * 86_400_000_000]  # microseconds


def test_a_version_lies_in_two_units_at_most_however_long(spark):
    start = datetime(2014, 5, 6, 7, 8, 9, 123456)
    dims = [(start, start + timedelta(microseconds=n)) for n in LENGTHS]
    dims += [(start, None), (start, start), (start, start - timedelta(days=1)), (None, start), (None, None)]
    units = laid_out(spark.createDataFrame(dims, "__from timestamp, __to timestamp"))
    copies = {tuple(r)[:2]: r[2] for r in units.groupBy("__from", "__to").count().collect()}
    assert set(copies) == set(dims[: len(LENGTHS) + 1])  # open ones too; empty and negative ones nowhere
    assert all(n <= 2 for n in copies.values()) and copies[(start, None)] == 1
    assert units.agg(F.max("__level")).first()[0] <= 15


def test_times_at_the_edges_of_units_and_before_the_epoch(spark):
    edges = [16**9, 16**10, 0, -(16**10), -1]
    at = [datetime(1970, 1, 1) + timedelta(microseconds=m + d) for m in edges for d in (-1, 0, 1)]
    dims = [(1, i, lo, hi, False) for i, (lo, hi) in enumerate((a, b) for a in at for b in at)]
    want = sorted((f, c) for f, t in enumerate(at) for _, c, lo, hi, _ in dims if lo <= t < hi)
    left = spark.createDataFrame([(f, 1, t) for f, t in enumerate(at)], "id int, k int, at timestamp")
    got = asof_scd2(left, spark.createDataFrame(dims, DIM), "k", "at", nested=True)
    assert sorted(rows(got, "id", "city")) == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_empty_sides_and_repeated_rows(spark, dim, facts, how):
    twice = facts.union(facts)
    for left, right in ((facts, dim.limit(0)), (facts.limit(0), dim), (twice, dim.union(dim))):
        plain, nested = (asof_scd2(left, right, "k", "at", how, nested) for nested in (False, True))
        assert rows(nested) == rows(plain)


def test_a_deep_history_meets_few_versions(spark):
    """Ten thousand versions of one key and as many rows: the residual sees some 17 versions a row and level."""
    versions = spark.range(10000).select(
        F.lit(1).alias("k"), F.col("id").cast("int").alias("city"),
        F.timestamp_seconds(F.col("id") * 3600).alias("valid_from"),
        F.timestamp_seconds((F.col("id") + 1) * 3600).alias("valid_to"), F.lit(False).alias("is_current"))
    left = spark.range(10000).select("id", F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 3600 + 7).alias("at"))
    units = laid_out(versions.select(F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to")))
    assert units.count() <= 2 * 10000
    assert units.groupBy("__level", "__node").count().agg(F.max("count")).first()[0] <= 18
    got = asof_scd2(left, versions, "k", "at", nested=True)
    assert got.filter("id = city").count() == got.count() == 10000
    assert "__in" in plan(got) and "CartesianProduct" not in plan(got) and "NestedLoop" not in plan(got)


def test_rough_versions_end_to_the_microsecond(spark):
    """Their ends lie whole hours from their starts, so an instant within the last second is told right."""
    versions = b.rough_versions(spark, "/root/testdata/sf0.001", 3).filter("valid_to IS NOT NULL")
    length = F.unix_micros("valid_to") - F.unix_micros("valid_from")
    assert versions.count() > 0 and versions.filter(length % 3_600_000_000 != 0).count() == 0
    assert versions.filter(F.unix_micros("valid_from") % 1_000_000 != 0).count() > 0


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti"])
def test_very_many_overlapping_versions(spark, how):
    """More than a block of closed and of open ones in a unit, some open since before the epoch; repeated rows and NULLs."""
    hours, day = F.col("id") % 5 - 1, F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 61)
    start = F.when(F.col("id") % 1009 == 0, F.timestamp_seconds(-F.col("id") - 5)).otherwise(day)
    dims = spark.range(12 * BLOCK).select(
        (F.col("id") % 2).cast("int").alias("k"), F.col("id").cast("int").alias("city"), start.alias("valid_from"),
        F.when(F.col("id") % 3 != 0, F.timestamp_micros(F.unix_micros(start) + hours * 3_600_000_000)).alias("valid_to"),
        F.lit(False).alias("is_current"))
    at = F.when(F.col("id") % 11 != 0, F.timestamp_seconds((F.col("id") - 20) * 3_600 * 24 * 90 + F.col("id")))
    near = spark.range(40).select("id", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 4_000).alias("at"))
    left = spark.range(200).select("id", at.alias("at")).union(near).union(near).withColumn(
        "k", F.when(F.col("id") % 7 != 0, F.col("id") % 3).cast("int"))
    plain, nested = (asof_scd2(left, dims, "k", "at", how, nested).cache() for nested in (False, True))
    assert nested.count() == plain.count() > 0
    assert nested.exceptAll(plain).isEmpty()


def test_matches_are_not_shuffled(spark, dim, facts):
    """Rows may match very many versions: no join or exchange is left to do once rows have met them."""
    above, found, _ = plan(asof_scd2(facts, dim, "k", "at", "left", nested=True)).partition("Generate inline")
    assert found and "Exchange" not in above and "Join" not in above


def test_open_versions_of_a_key_are_dealt_out_only_where_there_are_many(spark):
    start = datetime(2024, 1, 1)
    for count, shares in ((1, 1), (BLOCK, 1), (2 * BLOCK + 1, 3), (100 * BLOCK, 16)):
        opened = spark.range(count).select(
            F.lit(1).alias("k"), F.lit(start).alias("__from"), F.lit(None).cast("timestamp").alias("__to"))
        assert opened.limit(1).select(open_shares(opened, ["k"])).first()[0] == shares
    assert spark.range(1).select(open_shares(opened.limit(0), ["k"])).first()[0] == 1
