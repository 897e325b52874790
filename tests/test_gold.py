import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rainledger.functions.columns import datetime_struct_to_ts, slug
from rainledger.operators.majority import majority, top_k
from rainledger.operators.quality import check_not_null, check_unique
from rainledger.plans.gold import current_weather, fact_sales_weather, order_stats, weather_consensus
from tests.helpers import rows, ts

WEATHER = ("city_id int, city_name string, source string, fetched_at timestamp, temperature double, humidity int, "
           "pressure double, wind_speed double, condition string")


def reading(city, at, condition, temperature=20.0, source="openweather", name="Hanoi"):
    return (city, name, source, ts(at), temperature, 50, 1000.0, 2.0, condition)


def consensus(spark, *readings, **options):
    return weather_consensus(spark.createDataFrame(list(readings), WEATHER), **options)


def test_majority_and_averages(spark):
    df = consensus(spark, reading(1, "01 10:05", "Clear", 10.0), reading(1, "01 10:50", "Clear", 20.0, "openmeteo"),
                   reading(1, "01 10:59", "Rain", 30.0, "tomorrowio"), reading(1, "01 11:00", "Fog", 1.0))
    assert rows(df, "date_hour", "avg_temperature", "majority_condition", "source_count", "temperature_stddev") == [
        (ts("01 10:00"), 20.0, "Clear", 3, 10.0), (ts("01 11:00"), 1.0, "Fog", 1, None)]


def test_three_voices_differ_smallest_wins(spark):
    df = consensus(spark, *[reading(1, "01 10:00", c, source=c) for c in ("Rain", "Clouds", "Fog")])
    assert rows(df, "majority_condition") == [("Clouds",)]


def test_null_condition_votes_and_loses_ties(spark):
    tie = consensus(spark, reading(1, "01 10:00", None), reading(1, "01 10:01", "Rain"))
    assert rows(tie, "majority_condition") == [("Rain",)]
    most = consensus(spark, reading(1, "01 10:00", None), reading(1, "01 10:01", None), reading(1, "01 10:02", "Rain"))
    assert rows(most, "majority_condition") == [(None,)]


def test_one_vote_per_source(spark):
    votes = [reading(1, f"01 10:0{i}", "Rain") for i in range(3)] + [
        reading(1, "01 10:05", "Clear"), reading(1, "01 10:06", "Clear", source="openmeteo")]
    assert rows(consensus(spark, *votes), "majority_condition") == [("Rain",)]
    assert rows(consensus(spark, *votes, one_vote_per_source=True), "majority_condition") == [("Clear",)]


def test_rename_within_the_hour(spark):
    votes = [reading(1, "01 10:00", "Rain", name="Saigon"), reading(1, "01 10:30", "Rain", name="Ho Chi Minh")]
    assert consensus(spark, *votes).count() == 1
    assert consensus(spark, *votes, strict_ref=True).count() == 2


def test_readings_without_time_do_not_vote(spark):
    assert consensus(spark, (1, "Hanoi", "s", None, 1.0, 1, 1.0, 1.0, "Rain")).count() == 0


def test_vote_matches_counting_over_many_partitions_and_groups(spark):
    rng = random.Random(5)
    votes = [(rng.randrange(700), rng.choice(["a", "b", "c", None])) for _ in range(6000)]
    df = spark.createDataFrame([reading(c, "01 10:00", v) for c, v in votes], WEATHER).repartition(7)
    want = {}
    for city in {c for c, _ in votes}:
        counts = Counter(v for c, v in votes if c == city)
        want[city] = min(counts, key=lambda v: (-counts[v], v is None, v or ""))
    assert dict(rows(weather_consensus(df), "city_id", "majority_condition")) == want
    assert dict(rows(majority(df, "city_id", "condition"), "city_id", "majority")) == want


def test_top_k(spark):
    df = spark.createDataFrame([("x", "a", 1), ("x", "b", 3), ("x", "c", 3), ("y", "d", None)], "g string, n string, v int")
    assert rows(top_k(df, "g", "v", 2, "n"), "g", "n", "rank") == [("x", "b", 1), ("x", "c", 2), ("y", "d", 1)]


@pytest.fixture
def shop(spark):
    orders = spark.createDataFrame(
        [("o1", 1, "Delivery", "Completed", ts("02 10:15")), ("o2", 1, "Delivery", "Pending", ts("02 10:45")),
         ("o3", 1, "Dine-in", "Cancelled", ts("02 10:00")), ("o4", 1, "Dine-in", None, ts("02 10:00")),
         ("o5", 1, "Dine-in", "Completed", ts("03 10:00")), ("o6", 1, "Dine-in", "Completed", ts("01 10:00")),
         ("o7", 1, "Dine-in", "Completed", ts("02 23:00"))],
        "order_id string, store_id int, order_type string, status string, created_at timestamp")
    lines = spark.createDataFrame(
        [("o1", 7, 1, 10.0), ("o1", 8, 2, 20.0), ("o1", 7, 1, 5.5), ("o2", 7, 1, 10.0), ("o3", 7, 1, 99.0),
         ("o4", 7, 1, 99.0), ("o5", 7, 3, 30.0), ("o6", 7, 1, 99.0), ("o7", 7, 1, 7.0)],
        "order_id string, product_id int, quantity int, subtotal double")
    products = spark.createDataFrame(
        [(7, "Hot Drink", ts("02 00:00"), ts("03 00:00"), False), (7, "Cold Drink", ts("03 00:00"), None, True),
         (8, "Food", ts("01 00:00"), None, True)],
        "product_id int, category string, valid_from timestamp, valid_to timestamp, is_current boolean")
    stores = spark.createDataFrame(
        [(1, 100, ts("01 00:00"), ts("03 00:00"), False), (1, 200, ts("03 00:00"), None, True)],
        "store_id int, city_id int, valid_from timestamp, valid_to timestamp, is_current boolean")
    weather = spark.createDataFrame(
        [reading(100, "02 10:00", "Rain", 18.0), reading(200, "03 10:00", "Clear", 30.0),
         reading(100, "01 10:00", "Fog", 1.0), reading(100, "02 23:00", None, 1.0)], WEATHER)
    return orders, lines, products, stores, weather_consensus(weather)


@pytest.mark.parametrize("nested", [False, True])
def test_fact(shop, nested):
    fact = fact_sales_weather(*shop, nested=nested)
    got = rows(fact, "date_hour", "city_id", "store_id", "weather_condition", "temperature_c", "order_type",
               "product_category", "total_orders", "total_items_sold", "total_revenue")
    # o3 cancelled, o4 without status, o6 before the product's first version, o7 without a condition
    assert got == sorted([
        (ts("02 10:00"), 100, 1, "Rain", 18.0, "Delivery", "Hot Drink", 2, 3, 25.5),
        (ts("02 10:00"), 100, 1, "Rain", 18.0, "Delivery", "Food", 1, 2, 20.0),
        (ts("03 10:00"), 200, 1, "Clear", 30.0, "Dine-in", "Cold Drink", 1, 3, 30.0)], key=repr)
    kept = fact_sales_weather(*shop, keep_unmatched=True, nested=nested)
    assert rows(kept.filter("weather_condition IS NULL"), "date_hour", "total_revenue") == [(ts("02 23:00"), 7.0)]


def test_fact_checks(shop):
    fact = fact_sales_weather(*shop)
    assert rows(check_unique(fact, ["date_hour", "order_type", "product_category", "store_id", "city_id"])) == [(3, 3, 0)]
    assert rows(check_unique(fact, ["store_id"])) == [(3, 1, 1)]
    assert rows(check_not_null(fact.withColumn("x", F.lit(None)), ["x", "store_id"])) == [("store_id", 0), ("x", 3)]


def test_order_stats_without_amounts(spark):
    df = spark.createDataFrame(
        [(1, "Delivery", "Pending", 1.1, ts("01 10:10")), (1, "Delivery", "Pending", None, ts("01 10:20")),
         (2, "Delivery", "Pending", None, ts("01 10:20")), (2, "Delivery", "Pending", 5.0, None)],
        "store_id int, order_type string, status string, total_amount double, created_at timestamp")
    assert rows(order_stats(df), "store_id", "order_count", "total_revenue", "avg_order_value") == [
        (1, 2, 1.1, 1.1), (2, 1, None, None)]


def test_current_weather_defaults(spark):
    state = spark.createDataFrame([(1, None, None), (2, "", 0.0), (3, "Rain", 5.0), (9, "Fog", 1.0)],
                                  "city_id int, condition string, temperature double")
    cities = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "city_id int, city_name string")
    assert rows(current_weather(state, cities)) == [
        (1, "a", "Clouds", 25.0), (2, "b", "Clouds", 25.0), (3, "c", "Rain", 5.0)]


def test_small_functions(spark):
    df = spark.sql("""SELECT named_struct('date', DATE'2024-01-02', 'time', 36000000001L) AS full,
                             named_struct('date', CAST(NULL AS DATE), 'time', 1L) AS no_date,
                             named_struct('date', DATE'1969-12-31', 'time', CAST(NULL AS BIGINT)) AS no_time,
                             'Ho Chi Minh' AS city""")
    got = df.select(datetime_struct_to_ts(F.col("full")), datetime_struct_to_ts(F.col("no_date")),
                    datetime_struct_to_ts(F.col("no_time")), slug(F.col("city"))).first()
    assert tuple(got) == (ts("02 10:00").replace(microsecond=1), None, None, "ho_chi_minh")
