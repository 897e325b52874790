"""Dashboard queries over the Gold models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.functions.columns import money_sum
from rainledger.operators.asof import asof_scd2
from rainledger.operators.majority import top_k


def revenue_by_condition(fact: DataFrame) -> DataFrame:
    """Revenue, items and order count by weather condition and product category."""
    return fact.groupBy("weather_condition", "product_category").agg(
        money_sum(F.col("total_revenue")).alias("revenue"),
        F.sum("total_items_sold").alias("items"),
        F.sum("total_orders").alias("order_count"),
    )


def delivery_ratio(fact: DataFrame) -> DataFrame:
    """Share of delivery orders by weather condition and hour of day."""
    delivery = F.sum(F.when(F.col("order_type") == "Delivery", F.col("total_orders")).otherwise(0))
    total = F.sum("total_orders")
    return fact.groupBy("weather_condition", F.hour("date_hour").alias("hour_of_day")).agg(
        delivery.alias("delivery_orders"),
        total.alias("all_orders"),
        F.try_divide(delivery.cast("double"), total.cast("double")).alias("delivery_share"),
    )


def hourly_volume(stats: DataFrame, stores: DataFrame) -> DataFrame:
    """Orders and revenue per hour, city and store, from the additive order statistics.

    The city is the one the store was in when the hour began; a store the dimension lacks
    keeps its orders under no city.
    """
    volume = stats.groupBy("order_hour", "store_id").agg(
        F.sum("order_count").alias("order_count"), money_sum(F.col("total_revenue")).alias("revenue")
    )
    versions = stores.select("store_id", "city_id", "valid_from", "valid_to")
    return asof_scd2(volume, versions, "store_id", "order_hour", "left")


def top_categories(fact: DataFrame, k: int = 3) -> DataFrame:
    """The categories with most revenue under each weather condition."""
    revenue = fact.groupBy("weather_condition", "product_category").agg(
        money_sum(F.col("total_revenue")).alias("revenue")
    )
    return top_k(revenue, "weather_condition", "revenue", k, "product_category")


def status_scorecard(stats: DataFrame) -> DataFrame:
    """Orders and revenue per status."""
    return stats.groupBy("status").agg(
        F.sum("order_count").alias("order_count"), money_sum(F.col("total_revenue")).alias("revenue")
    )
