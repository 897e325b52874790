"""Gold models: hourly weather consensus, sales by weather, order statistics, current weather."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainledger.functions.columns import hour_of, money, money_sum
from rainledger.functions.conditions import DEFAULT_CONDITION, DEFAULT_TEMPERATURE
from rainledger.operators.asof import asof_scd2
from rainledger.operators.latest import keep_latest

FACT_GRAIN = ["date_hour", "order_type", "product_category", "store_id", "city_id"]


def _consensus(rows: DataFrame, grain: list[str], *extra: Column) -> DataFrame:
    """Averages and the majority per group, each from counters alone.

    No buffer holds a group's distinct values: conditions are counted per value first and
    the counts compared, and distinct sources are counted by grouping. NULL conditions vote;
    ties go to the smallest value, NULL last.
    """
    votes = rows.groupBy(*grain, "condition").agg(F.count(F.lit(1)).alias("__n"))
    best = F.min(F.struct(-F.col("__n"), F.col("condition").isNull(), F.col("condition").alias("value")))
    winners = votes.groupBy(*[F.col(c).alias(f"__{c}") for c in grain]).agg(best["value"].alias("majority_condition"))
    averages = rows.groupBy(*grain).agg(
        *extra,
        F.avg("temperature").alias("avg_temperature"),
        F.avg("humidity").alias("avg_humidity"),
        F.avg("pressure").alias("avg_pressure"),
        F.avg("wind_speed").alias("avg_wind_speed"),
        F.count_distinct("source").alias("source_count"),
        F.stddev_samp("temperature").alias("temperature_stddev"),
    )
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in grain])
    return averages.join(winners, same).select(*averages.columns, "majority_condition")


def weather_consensus(weather: DataFrame, one_vote_per_source: bool = False, strict_ref: bool = False) -> DataFrame:
    """One row per city and hour from all sources' readings.

    Every reading votes; ``one_vote_per_source`` lets only a source's newest reading of
    the hour count. Grouped by city alone, so a city renamed within an hour stays one
    row; ``strict_ref`` groups by name too.
    """
    rows = weather.filter(F.col("fetched_at").isNotNull()).withColumn("date_hour", hour_of(F.col("fetched_at")))
    if one_vote_per_source:
        rows = keep_latest(rows, ["city_id", "date_hour", "source"], "fetched_at")
    if strict_ref:
        return _consensus(rows, ["city_id", "city_name", "date_hour"])
    return _consensus(rows, ["city_id", "date_hour"], F.max("city_name").alias("city_name"))


def _placed(orders: DataFrame, stores: DataFrame, nested: bool) -> DataFrame:
    """Orders with the city their store was in at the order time."""
    versions = stores.select("store_id", "city_id", "valid_from", "valid_to")
    return asof_scd2(orders, versions, "store_id", "created_at", nested=nested)


def fact_sales_weather(
    orders: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    consensus: DataFrame,
    keep_unmatched: bool = False,
    nested: bool = False,
) -> DataFrame:
    """Sales by hour, store, order type and product category, with the hour's weather.

    Both dimensions are joined as of the order time. Revenue is the lines' subtotal;
    an order counts once in every category it holds. Sales of hours without weather
    are dropped unless ``keep_unmatched``.

    Stores meet orders before the lines multiply them. Weather depends only on city and
    hour, so it joins the finished sums instead of every line. Counting distinct orders
    becomes a count after a grouping by order and category, which reuses the
    partitioning of the join on the order when the products are broadcast.

    ``nested`` is that of the as-of joins, for dimensions with long histories.
    """
    kept = orders.filter(F.col("status") != "Cancelled").select("order_id", "store_id", "order_type", "created_at")
    placed = _placed(kept, stores, nested)
    sold = placed.join(lines.select("order_id", "product_id", "quantity", "subtotal"), "order_id")
    versions = products.select("product_id", F.col("category").alias("product_category"), "valid_from", "valid_to")
    priced = asof_scd2(sold, versions, "product_id", "created_at", nested=nested)

    at = F.col("created_at").cast("timestamp")
    grain = ["date_hour", "order_date", "city_id", "store_id", "order_type", "product_category"]
    per_order = (
        priced.withColumns({"date_hour": hour_of(at), "order_date": F.to_date(at)})
        .groupBy("order_id", *grain)
        .agg(F.sum("quantity").alias("items"), F.sum(money(F.col("subtotal"))).alias("revenue"))
    )
    sales = per_order.groupBy(*grain).agg(
        F.count("order_id").alias("total_orders"),
        F.sum("items").cast("bigint").alias("total_items_sold"),
        F.sum("revenue").cast("double").alias("total_revenue"),
    )
    weather = consensus.select(
        "city_id",
        "date_hour",
        F.col("majority_condition").alias("weather_condition"),
        F.col("avg_temperature").alias("temperature_c"),
    )
    if keep_unmatched:
        return sales.join(weather, ["city_id", "date_hour"], "left")
    return sales.join(weather.filter(F.col("weather_condition").isNotNull()), ["city_id", "date_hour"])


def sales_without_weather(orders: DataFrame, stores: DataFrame, consensus: DataFrame,
                          nested: bool = False) -> DataFrame:
    """Store hours with orders but no weather, and how many orders the fact loses there."""
    kept = orders.filter(F.col("status") != "Cancelled").select("order_id", "store_id", "created_at")
    placed = _placed(kept, stores, nested)
    hours = placed.groupBy("city_id", "store_id", hour_of(F.col("created_at")).alias("date_hour")).agg(
        F.count(F.lit(1)).alias("lost_orders")
    )
    known = consensus.filter(F.col("majority_condition").isNotNull()).select("city_id", "date_hour")
    return hours.join(known, ["city_id", "date_hour"], "left_anti")


def order_stats(orders: DataFrame) -> DataFrame:
    """Orders and revenue by hour, store, order type and status, cancelled ones included."""
    at = F.col("created_at").cast("timestamp")
    grain = {"order_hour": hour_of(at), "order_date": F.to_date(at)}
    amount = money_sum(F.col("total_amount"))
    return (
        orders.filter(F.col("created_at").isNotNull())
        .withColumns(grain)
        .groupBy(*grain, "store_id", "order_type", "status")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            amount.alias("total_revenue"),
            # try_divide: a group whose amounts are all NULL has no average
            F.try_divide(amount, F.count("total_amount").cast("double")).alias("avg_order_value"),
        )
    )


STATS_GROUP = ["order_hour", "order_date", "store_id", "order_type", "status"]
STATS_SUMS = ["order_count", "revenue", "amounts"]


def order_sums(orders: DataFrame, sign: int = 1) -> DataFrame:
    """What orders add to the statistics, or take from them with ``sign`` -1: exact sums by ``STATS_GROUP``, which can be added."""
    return added_sums(signed_orders(orders, sign))


def signed_orders(orders: DataFrame, sign: int = 1) -> DataFrame:
    """Each order as the sums of itself alone, to be grouped once with others."""
    at = F.col("created_at").cast("timestamp")
    amount = money(F.col("total_amount"))
    return orders.filter(F.col("created_at").isNotNull()).select(
        hour_of(at).alias("order_hour"), F.to_date(at).alias("order_date"), "store_id", "order_type", "status",
        F.lit(sign).cast("bigint").alias("order_count"),
        (amount if sign > 0 else -amount).alias("revenue"),
        F.when(F.col("total_amount").isNotNull(), sign).otherwise(0).cast("bigint").alias("amounts"),
    )


def added_sums(sums: DataFrame) -> DataFrame:
    """Sums of equal groups added up; groups in which nothing is left or changed are gone."""
    total = sums.groupBy(*STATS_GROUP).agg(*[F.sum(c).alias(c) for c in STATS_SUMS])
    total = total.withColumn("revenue", F.coalesce("revenue", F.lit(0)).cast("decimal(38,2)"))
    return total.filter((F.col("order_count") != 0) | (F.col("revenue") != 0) | (F.col("amounts") != 0))


def stats_of_sums(sums: DataFrame) -> DataFrame:
    """``order_stats`` out of sums, which stay beside them."""
    revenue = F.when(F.col("amounts") > 0, F.col("revenue").cast("double"))
    average = F.try_divide(revenue, F.col("amounts").cast("double"))
    return sums.select(*STATS_GROUP, *STATS_SUMS, revenue.alias("total_revenue"), average.alias("avg_order_value"))


def current_weather(state: DataFrame, cities: DataFrame) -> DataFrame:
    """Each city's latest weather; a missing condition reads Clouds, a missing or zero temperature 25.0."""
    condition, temperature = F.col("condition"), F.col("temperature")
    return cities.select("city_id", "city_name").join(state, "city_id").select(
        "city_id",
        "city_name",
        F.when(condition.isNull() | (condition == ""), DEFAULT_CONDITION).otherwise(condition).alias("condition"),
        F.when(temperature.isNull() | (temperature == 0), DEFAULT_TEMPERATURE)
        .otherwise(temperature)
        .alias("temperature"),
    )
