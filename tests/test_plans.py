"""What the physical plans must and must not contain."""

import pytest

from pyspark.sql import functions as F

from rainledger import bindings as b
from rainledger import catalogue
from rainledger.plans import gold
from rainledger.session import configure
from tests.helpers import plan

SF_DIR = "/root/testdata/sf0.001"
WRITERS = ("stream_", "bronze_", "published_", "lakehouse_")  # what they return only reads files
QUERIES = {n: q for n, q in catalogue.queries().items() if not n.startswith(WRITERS)}


@pytest.mark.parametrize("name", list(QUERIES))
@pytest.mark.parametrize("broadcast", [True, False])
def test_no_python_and_no_cross_joins(spark, name, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760" if broadcast else "-1")
    try:
        text = plan(QUERIES[name](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in text


def test_fact_reads_only_the_columns_it_needs(spark):
    text = plan(QUERIES["fact_sales_weather"](spark, SF_DIR))
    assert "l_shipdate" not in text and "l_tax" not in text and "o_totalprice" not in text


def test_shared_work_is_done_once(spark):
    """Rows and their per-bucket summary come from one shuffle of the events."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        history = QUERIES["scd2_history"](spark, SF_DIR)
        history.collect()
        assert "ReusedExchange" in plan(history)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_order_and_product_are_split(spark):
    """A third of the lines on one order and a third on one product: AQE splits both joins."""
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB", "spark.sql.shuffle.partitions": "16"}
    before = {name: spark.conf.get(name, None) for name in small}
    third = F.col("n") % 3
    lines = spark.range(60000).withColumnRenamed("id", "n").repartition(6).select(
        F.when(third == 0, 0).otherwise(F.col("n") % 1000).alias("order_id"),
        F.when(third == 1, 0).otherwise(F.col("n") % 500).alias("product_id"),
        F.lit(1).alias("quantity"), F.lit(1.5).alias("subtotal"))
    orders = b.orders(spark, SF_DIR).withColumn("status", F.lit("Completed"))
    products = b.products(spark, SF_DIR)
    try:
        for name, value in small.items():
            spark.conf.set(name, value)
        consensus = gold.weather_consensus(b.weather(spark, SF_DIR))
        fact = gold.fact_sales_weather(orders, lines, products, b.stores(spark, SF_DIR), consensus, keep_unmatched=True)
        sold = fact.agg(F.sum("total_items_sold"))
        known = lines.join(products, "product_id", "left_semi").join(orders, "order_id", "left_semi").count()
        assert sold.first()[0] == known
        sold.collect()
        assert "skew=true" in plan(sold)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_the_consensus_keeps_no_values_per_group(spark):
    text = plan(gold.weather_consensus(b.weather(spark, SF_DIR)))
    assert "ObjectHashAggregate" not in text and "collect_set" not in text and "mode(" not in text


def test_building_a_plan_runs_nothing(spark):
    """As-of joins and the fact only start jobs when asked for rows."""
    inputs = (b.orders(spark, SF_DIR), b.lines(spark, SF_DIR), b.versioned_products(spark, SF_DIR), b.versioned_stores(spark, SF_DIR))
    weather = b.weather(spark, SF_DIR)
    spark.sparkContext.setJobGroup("building", "building")
    try:
        gold.fact_sales_weather(*inputs, gold.weather_consensus(weather), nested=True)
        gold.fact_sales_weather(*inputs, gold.weather_consensus(weather))
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_task_takes_a_bounded_part_of_a_shuffle(spark):
    """Partitions are merged up to 16 MB only, out of 400 at least; what a session sets itself stays."""
    size, first = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    fresh, own, many = spark.newSession(), spark.newSession(), spark.newSession()
    own.conf.set(size, "200MB")
    own.conf.set(first, "10000")
    many.conf.set("spark.sql.shuffle.partitions", "3000")
    got = [tuple(configure(s).conf.get(c, None) for c in (size, first)) for s in (fresh, own, many)]
    assert got == [("16MB", "400"), ("200MB", "10000"), ("16MB", "3000")]


def test_kept_rows_are_merged_into_few_partitions(spark):
    kept = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count().persist()
    try:
        assert kept.count() == 10 and kept.rdd.getNumPartitions() == 1
    finally:
        kept.unpersist()
