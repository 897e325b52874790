"""Every registered query: a name and a function of (session, folder of Parquet tables)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger import bindings as b
from rainledger import jobs
from rainledger.functions.columns import datetime_struct_to_ts, slug, ts_to_datetime_struct
from rainledger.operators import asof, latest, majority, merge, quality, scd2
from rainledger.plans import dashboard, gold, silver
from rainledger.plans import weather as weather_plan
from rainledger.schemas import (
    SILVER_ORDER_DETAILS,
    SILVER_ORDERS,
    SILVER_PRODUCTS,
    SILVER_STORES,
    SILVER_WEATHER,
)
from rainledger.session import configure, scratch
from rainledger.sources import bronze as bronze_source
from rainledger.sources import masters, tables
from rainledger.sources.cdc import read_cdc, read_cdc_stream
from rainledger.streaming import pipelines

Query = Callable[[SparkSession, str], DataFrame]
RUN_TS = "2024-02-01 00:00:00"
DELAY = "2 hours"


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Averages to nine digits, so that the order of summing does not show."""
    return df.withColumns({c: F.round(c, 9) for c in cols})


# --- Gold ---------------------------------------------------------------------------------

CONSENSUS_AVERAGES = ["avg_temperature", "avg_humidity", "avg_pressure", "avg_wind_speed"]


def rounded_consensus(df: DataFrame) -> DataFrame:
    return rounded(df, *CONSENSUS_AVERAGES).withColumn("temperature_stddev", F.round("temperature_stddev", 6))


def weather_consensus(spark, sf):
    return rounded_consensus(gold.weather_consensus(b.weather(spark, sf)))


def weather_consensus_one_vote(spark, sf):
    return rounded_consensus(gold.weather_consensus(b.weather(spark, sf), one_vote_per_source=True))


def condition_majority(spark, sf):
    return majority.majority(b.weather(spark, sf), ["city_id", "source"], "condition", "top_condition")


def realtime_order_stats(spark, sf):
    return gold.order_stats(b.orders(spark, sf))


def _fact(spark, sf):
    return gold.fact_sales_weather(
        b.orders(spark, sf), b.lines(spark, sf), b.products(spark, sf), b.stores(spark, sf),
        gold.weather_consensus(b.weather(spark, sf)),
    )


def fact_sales_weather(spark, sf):
    return rounded(_fact(spark, sf), "temperature_c")


def fact_sales_weather_versioned(spark, sf):
    fact = gold.fact_sales_weather(
        b.orders(spark, sf), b.lines(spark, sf), b.versioned_products(spark, sf), b.versioned_stores(spark, sf),
        gold.weather_consensus(b.weather(spark, sf)),
    )
    return rounded(fact, "temperature_c")


def fact_sales_weather_nested(spark, sf):
    fact = gold.fact_sales_weather(
        b.orders(spark, sf), b.lines(spark, sf), b.versioned_products(spark, sf), b.versioned_stores(spark, sf),
        gold.weather_consensus(b.weather(spark, sf)), nested=True,
    )
    return rounded(fact, "temperature_c")


def fact_sales_weather_unmatched(spark, sf):
    fact = gold.fact_sales_weather(
        b.orders(spark, sf), b.lines(spark, sf), b.products(spark, sf), b.stores(spark, sf),
        gold.weather_consensus(b.weather(spark, sf)), keep_unmatched=True,
    )
    return rounded(fact, "temperature_c")


def sales_without_weather(spark, sf):
    return gold.sales_without_weather(
        b.orders(spark, sf), b.stores(spark, sf), gold.weather_consensus(b.weather(spark, sf))
    )


def current_weather(spark, sf):
    state = latest.latest_state(
        b.weather(spark, sf), "city_id", "fetched_at", ["condition", "temperature", "wind_speed", "humidity"]
    )
    return gold.current_weather(state, b.cities(spark, sf))


# --- Dimensions over time -----------------------------------------------------------------


def _category_history(spark, sf):
    return scd2.scd2_history(b.category_events(spark, sf), "product_id", ["category"])


def scd2_history(spark, sf):
    return _category_history(spark, sf)


def scd2_current(spark, sf):
    return scd2.current(_category_history(spark, sf)).select("product_id", "category", "valid_from")


def _category_versions(spark, sf, strict_ref=False):
    """Two batches, split in time, applied one after the other to an empty table."""
    kept, key, tracked = b.gap_events(spark, sf), "product_id", ["category"]
    newest = lambda rows: latest.keep_latest(rows, key, "source_timestamp", ("uuid",)).drop("uuid")
    first = newest(latest.incremental(kept, "source_timestamp", hi=b.SPLIT))
    second = newest(latest.incremental(kept, "source_timestamp", lo=b.SPLIT))
    start = scd2.scd2_open(first, "source_timestamp")
    return scd2.scd2_apply(start, second, key, tracked, strict_ref=strict_ref)


def scd2_apply_batch(spark, sf):
    return _category_versions(spark, sf)


def scd2_apply_batch_strict(spark, sf):
    return _category_versions(spark, sf, strict_ref=True)


def scd2_invariants(spark, sf):
    return quality.check_scd2(_category_history(spark, sf), "product_id")


def fact_asof_daily(spark, sf):
    seen = asof.asof_scd2(b.incidents(spark, sf), _category_history(spark, sf), "product_id", "happened_at")
    return seen.groupBy(F.to_date("happened_at").alias("happened_on"), "category").agg(
        F.count(F.lit(1)).alias("incidents"),
        F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount"),
    )


def asof_unmatched(spark, sf):
    return asof.unmatched(b.incidents(spark, sf), _category_history(spark, sf), "product_id", "happened_at")


def asof_unmatched_nested(spark, sf):
    return asof.unmatched(b.incidents(spark, sf), _category_history(spark, sf), "product_id", "happened_at", nested=True)


def _rough_asof(keys: int, nested: bool) -> Query:
    """Facts joined to versions that overlap, are empty or end before they start."""

    def run(spark, sf):
        facts = b.incidents(spark, sf).withColumn("product_id", F.col("product_id") % keys)
        seen = asof.asof_scd2(facts, b.rough_versions(spark, sf, keys), "product_id", "happened_at", "left", nested)
        return seen.groupBy("product_id", "category").agg(F.count(F.lit(1)).alias("matches"))

    return run


# --- Change events ------------------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]


def cdc_keep_latest(spark, sf):
    return latest.keep_latest(
        b.table(spark, sf, "lineitem"), LINE_KEY, "l_shipdate", ("l_partkey", "l_suppkey")
    )


def cdc_keep_latest_rank(spark, sf):
    return latest.keep_latest(b.table(spark, sf, "lineitem"), LINE_KEY, "l_shipdate", ties="all")


def cdc_incremental(spark, sf):
    return latest.incremental(b.table(spark, sf, "events"), "ts", lo=b.SPLIT)


def cdc_drop_deletes(spark, sf):
    return latest.drop_deletes(b.cdc(spark, sf), "change_type")


def cdc_deleted_last(spark, sf):
    return latest.deleted_keys(b.cdc(spark, sf), "product_id", "source_timestamp")


def merge_orders(spark, sf):
    rows = b.order_events(spark, sf)
    newest = lambda part: latest.keep_latest(part, "order_id", "source_timestamp").drop("source_timestamp")
    target = newest(latest.incremental(rows, "source_timestamp", hi=b.SPLIT))
    source = newest(latest.incremental(rows, "source_timestamp", lo=b.SPLIT))
    return merge.merge_upsert(target, source, "order_id", "updated_at", silver.ORDER_UPDATES)


def merge_insert_only(spark, sf):
    rows = b.table(spark, sf, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("timestamp"))
    newest = lambda part: latest.keep_latest(part, LINE_KEY, "l_shipdate", ("l_partkey", "l_suppkey"))
    split = "1998-01-01 00:00:00"
    target = newest(latest.incremental(rows, "l_shipdate", hi=split))
    source = newest(latest.incremental(rows, "l_shipdate", lo=split))
    return merge.merge_insert_only(target, source, LINE_KEY)


def decode_datetime(spark, sf):
    packed = b.events(spark, sf).select("event_id", ts_to_datetime_struct(F.col("ts")).alias("packed"))
    return packed.select(
        "event_id",
        F.col("packed.date").alias("day"),
        F.col("packed.time").alias("micros"),
        datetime_struct_to_ts(F.col("packed")).alias("ts"),
    )


def _in_two_batches(step, empty: T.StructType, spark, events, split, **options):
    """Apply a Silver step to an empty table with the events up to the split, then the rest."""
    first = step(spark.createDataFrame([], empty), events, hi=split, **options)
    return step(first, events, lo=split, **options)


def silver_orders(spark, sf):
    return _in_two_batches(silver.silver_orders, SILVER_ORDERS, spark, b.order_cdc(spark, sf), b.SPLIT)


def silver_orders_deletes(spark, sf):
    return _in_two_batches(
        silver.silver_orders, SILVER_ORDERS, spark, b.order_cdc(spark, sf), b.SPLIT, apply_deletes=True
    )


def silver_order_details(spark, sf):
    return _in_two_batches(
        silver.silver_order_details, SILVER_ORDER_DETAILS, spark, b.order_detail_cdc(spark, sf), b.DETAILS_SPLIT
    )


def silver_products(spark, sf):
    return _in_two_batches(silver.silver_products, SILVER_PRODUCTS, spark, b.product_cdc(spark, sf), b.SPLIT)


def silver_products_deletes(spark, sf):
    return _in_two_batches(
        silver.silver_products, SILVER_PRODUCTS, spark, b.product_cdc(spark, sf), b.SPLIT, apply_deletes=True
    )


def silver_stores(spark, sf):
    return _in_two_batches(silver.silver_stores, SILVER_STORES, spark, b.store_cdc(spark, sf), b.SPLIT)


# --- Weather ------------------------------------------------------------------------------


def _normalizer(source: str) -> Query:
    return lambda spark, sf: weather_plan.normalize(b.bronze(spark, sf), source, RUN_TS)


def silver_weather(spark, sf):
    return weather_plan.silver_weather(b.bronze(spark, sf), RUN_TS)


def bronze_roundtrip(spark, sf):
    """Land the payloads by source and day, read back what was fetched after the split."""
    base = f"{scratch(spark, 'bronze')}/weather"
    bronze_source.write_bronze_weather(bronze_source.bronze_envelope(b.bronze(spark, sf), "raw_json"), base)
    landed = bronze_source.read_bronze_weather(spark, base, lo=b.SPLIT)
    return weather_plan.silver_weather(landed, RUN_TS)


# --- Master data, tables ------------------------------------------------------------------


def active_dims(spark, sf):
    """The master tables in use, as (table, key, attribute)."""
    masters_of = {
        "products": b.master_products, "stores": b.master_stores, "customers": b.master_customers,
        "cities": b.master_cities,
    }
    dims = masters.load_dims(lambda name: masters_of[name](spark, sf))
    shape = {"products": ("product_id", "category"), "stores": ("store_id", "city_id"),
             "customers": ("customer_id", "customer_id"), "cities": ("city_id", "city_name")}
    parts = [
        dims[name].select(
            F.lit(name).alias("dim"), F.col(key).cast("bigint").alias("id"),
            F.col(attribute).cast("string").alias("attribute"),
        )
        for name, (key, attribute) in shape.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def cdc_read_batch(spark, sf):
    """Events landed in nested folders, read as one table; a folder that is not there reads as no events."""
    base = scratch(spark, "cdc_read_batch")
    events = b.order_cdc(spark, sf)
    for name, bounds in (("a/1", {"hi": b.SPLIT}), ("b", {"lo": b.SPLIT})):
        latest.incremental(events, "source_timestamp", **bounds).write.parquet(f"{base}/orders/{name}")
    landed = read_cdc(spark, f"{base}/orders", "orders", "parquet")
    every = landed.unionByName(read_cdc(spark, f"{base}/not_there", "orders", "parquet"))
    return silver.flatten(every, "orders").drop("__uuid").withColumnRenamed("__op", "change_type")


def table_append(spark, sf):
    """Create a partitioned table twice, append to it twice, and read it by name."""
    name = f"rainledger_{uuid.uuid4().hex}.weather"
    rows = b.weather(spark, sf).withColumn("ingested_at", F.lit(RUN_TS).cast("timestamp"))
    for part in ("source = 'openweather'", "source <> 'openweather'"):
        tables.ensure_table(spark, name, SILVER_WEATHER, tables.WEATHER_PARTITIONS)
        tables.append(rows.filter(part), name, tables.WEATHER_PARTITIONS)
    return spark.table(name).select(*SILVER_WEATHER.names)


def materialized_order_stats(spark, sf):
    """A model rebuilt twice under one name; the second build is what is left."""
    name = f"order_stats_{uuid.uuid4().hex}"
    stats = gold.order_stats(b.orders(spark, sf))
    tables.materialize(stats.limit(1), name)
    tables.materialize(stats, name)
    return spark.table(name)


def registered_sources(spark, sf):
    """The given tables under names that SQL can use."""
    session = spark.newSession()
    tables.register_sources(configure(session), sf, ["nation", "region"])
    return session.sql("SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")


def ingest_stamp(spark, sf):
    """Rows per source, and whether all carry the time of this run."""
    readings = weather_plan.silver_weather(b.bronze(spark, sf))
    fresh = F.col("ingested_at").between(F.current_timestamp() - F.expr("INTERVAL 1 DAY"), F.current_timestamp())
    return readings.groupBy("source").agg(F.count(F.lit(1)).alias("row_count"), F.bool_and(fresh).alias("is_fresh"))


def city_slugs(spark, sf):
    return b.table(spark, sf, "nation").select("n_name", slug(F.col("n_name")).alias("slug"))


def envelope_json(spark, sf):
    """Responses as structs become JSON text in the envelope."""
    payload = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind"))
    rows = b.events(spark, sf).select(
        "event_id", (F.col("user_id") % 5).alias("city_id"), F.lit("CITY").alias("city_name"), F.lit("own").alias("source"),
        F.col("ts").alias("fetched_at"), payload.alias("payload"),
    )
    return bronze_source.bronze_envelope(rows).select("city_id", "fetched_at", "raw_json")


def weather_route_counts(spark, sf):
    """Payloads per source, among them a source without a dialect and rows without any."""
    rows = b.bronze(spark, sf)
    source = F.when(F.col("city_id") == 0, "weatherstation").when(F.col("city_id") != 1, F.col("source"))
    return weather_plan.route_counts(rows.withColumn("source", source))


def published_consensus(spark, sf):
    """Publish two versions of a table; readers of the view get the second."""
    base = scratch(spark, "published")
    rows = gold.weather_consensus(b.weather(spark, sf))
    tables.publish(rows.filter("city_id = 0"), "published_consensus", base)
    tables.publish(rows, "published_consensus", base)
    return rounded_consensus(spark.table("published_consensus"))


def preview_fact(spark, sf):
    """The ten rows of the fact with most revenue, in a total order."""
    order = [F.desc("total_revenue"), *gold.FACT_GRAIN]
    return rounded(_fact(spark, sf).orderBy(*order).limit(10), "temperature_c")


# --- Dashboard and quality ----------------------------------------------------------------


def revenue_by_condition(spark, sf):
    return dashboard.revenue_by_condition(_fact(spark, sf))


def delivery_ratio(spark, sf):
    return dashboard.delivery_ratio(_fact(spark, sf))


def hourly_volume(spark, sf):
    return dashboard.hourly_volume(realtime_order_stats(spark, sf), b.stores(spark, sf))


def hourly_volume_versioned(spark, sf):
    return dashboard.hourly_volume(realtime_order_stats(spark, sf), b.versioned_stores(spark, sf))


def top_categories(spark, sf):
    return dashboard.top_categories(_fact(spark, sf), 3)


def status_scorecard(spark, sf):
    return dashboard.status_scorecard(realtime_order_stats(spark, sf))


def not_null_gold(spark, sf):
    return quality.check_not_null(_fact(spark, sf), [*gold.FACT_GRAIN, "weather_condition", "total_revenue"])


def unique_gold(spark, sf):
    return quality.check_unique(_fact(spark, sf), gold.FACT_GRAIN)


def consensus_rules(spark, sf):
    grain = ["city_id", "date_hour"]
    return quality.table_rules(gold.weather_consensus(b.weather(spark, sf)), grain, grain)


def order_stats_rules(spark, sf):
    return quality.table_rules(realtime_order_stats(spark, sf), ["order_hour", "order_count"], jobs.STATS_GRAIN)


# --- Streams ------------------------------------------------------------------------------
# Each lands its input in two steps below the work folder and drains the stream after each,
# so the second run starts from the first one's checkpoint.


def _landed_in_two(spark, name, rows, at, split, read, drain) -> str:
    work = scratch(spark, name)
    first, second = latest.incremental(rows, at, hi=split), latest.incremental(rows, at, lo=split)
    for part in (first, second):
        part.write.mode("append").parquet(f"{work}/landing")
        drain(read(f"{work}/landing"), work)
    return work


def _stream_cdc(spark, name, table, rows, split, drain) -> str:
    read = lambda path: read_cdc_stream(spark, path, table, "parquet")
    return _landed_in_two(spark, name, rows, "source_timestamp", split, read, drain)


def stream_merge(spark, sf):
    work = _stream_cdc(
        spark, "stream_merge", "orders", b.order_cdc(spark, sf), b.SPLIT,
        lambda events, work: pipelines.stream_orders(events, f"{work}/orders", work),
    )
    return silver.read_orders(spark, f"{work}/orders").select(*SILVER_ORDERS.names)


def merge_orders_table_two_batches(spark, sf):
    """Two batches of one stream, the first of them repeated, then a stream that starts over, in one staging folder."""
    work = scratch(spark, "merge_orders_table")
    events = b.order_cdc(spark, sf)
    first, second = (latest.incremental(events, "source_timestamp", **bound) for bound in ({"hi": b.SPLIT}, {"lo": b.SPLIT}))
    for run, number, part in (("a", 0, first), ("a", 0, first), ("a", 1, second), ("b", 0, first), ("b", 1, second)):
        source = silver.latest_changes(part, "orders").drop("source_timestamp")
        silver.merge_orders_table(f"{work}/orders", source, f"{work}/staged", tables.Batch(run, number))
    return silver.read_orders(spark, f"{work}/orders").select(*SILVER_ORDERS.names)


def _moved(events):
    """Updates carry another creation time than the insert, or none."""
    created = F.col("payload.created_at")
    number = F.regexp_extract(F.col("payload.order_id"), "[0-9]+", 0).cast("bigint")
    later = F.struct(F.date_add(created["date"], 3).alias("date"), created["time"].alias("time"))
    moved = F.when(number % 3 == 0, F.lit(None)).when(number % 3 == 1, later).otherwise(created)
    update = F.col("source_metadata.change_type") == "UPDATE"
    return events.withColumn("payload", F.when(update, F.col("payload").withField("created_at", moved)).otherwise(F.col("payload")))


def merge_orders_moved_creation(spark, sf):
    """Updates that name another day than their order lies in, or none, still update that order, in four batches."""
    work = scratch(spark, "merge_orders_moved")
    events = _moved(b.order_cdc(spark, sf))
    inserts = F.col("source_metadata.change_type") == "INSERT"
    early = F.col("source_timestamp") <= b.SPLIT
    for number, part in enumerate((inserts & early, ~inserts & early, inserts & ~early, ~inserts & ~early)):
        source = silver.latest_changes(events.filter(part), "orders")
        silver.merge_orders_table(f"{work}/orders", source, f"{work}/staged", tables.Batch("a", number))
    return silver.read_orders(spark, f"{work}/orders").select(*SILVER_ORDERS.names)


def stream_merge_deletes(spark, sf):
    """Deletes applied on the way, and events of the first part landing once more at the end bring nothing back."""
    events = b.order_cdc(spark, sf)
    drain = lambda stream, work: pipelines.stream_orders(stream, f"{work}/orders", work, f"{work}/stats", apply_deletes=True)
    work = _stream_cdc(spark, "stream_merge_deletes", "orders", events, b.SPLIT, drain)
    again = events.filter("source_metadata.change_type = 'INSERT'")
    latest.incremental(again, "source_timestamp", hi=b.SPLIT).write.mode("append").parquet(f"{work}/landing")
    drain(read_cdc_stream(spark, f"{work}/landing", "orders", "parquet"), work)
    return silver.read_orders(spark, f"{work}/orders").select(*SILVER_ORDERS.names)


def stream_products_deletes(spark, sf):
    return _stream_dimension("products", spark, b.product_cdc(spark, sf), SILVER_PRODUCTS, apply_deletes=True)


def order_details_many_batches(spark, sf):
    """Lines in two batches, the first of them repeated, into parts so small that their number grows on the way."""
    path = f"{scratch(spark, 'details_log')}/details"
    events = b.order_detail_cdc(spark, sf)
    log = silver.order_details_log(path)._replace(part_rows=500)
    for bound in ({"hi": b.DETAILS_SPLIT}, {"hi": b.DETAILS_SPLIT}, {"lo": b.DETAILS_SPLIT}):
        part = latest.incremental(events, "source_timestamp", **bound)
        with tables.persisted(silver.latest_changes(part, "order_details").drop("source_timestamp")) as lines:
            log.append(lines, ["detail_id"])
    return log.rows(spark)


def stream_order_stats(spark, sf):
    work = _stream_cdc(
        spark, "stream_order_stats", "orders", b.order_cdc(spark, sf), b.SPLIT,
        lambda events, work: pipelines.stream_orders(events, f"{work}/orders", work, f"{work}/stats"),
    )
    return spark.read.parquet(f"{work}/stats").drop("revenue", "amounts")


def stream_order_details(spark, sf):
    work = _stream_cdc(
        spark, "stream_order_details", "order_details", b.order_detail_cdc(spark, sf), b.DETAILS_SPLIT,
        lambda events, work: pipelines.stream_order_details(events, f"{work}/details", work),
    )
    return silver.read_order_details(spark, f"{work}/details")


def _stream_dimension(name, spark, rows, schema, apply_deletes=False):
    work = _stream_cdc(
        spark, f"stream_{name}", name, rows, b.SPLIT,
        lambda events, work: pipelines.stream_dimension(events, name, f"{work}/{name}", work, apply_deletes),
    )
    return silver.scd2_table(spark, f"{work}/{name}", schema)


def stream_products(spark, sf):
    return _stream_dimension("products", spark, b.product_cdc(spark, sf), SILVER_PRODUCTS)


def stream_stores(spark, sf):
    return _stream_dimension("stores", spark, b.store_cdc(spark, sf), SILVER_STORES)


def _parquet_stream(spark, schema):
    return lambda path: spark.readStream.schema(schema).parquet(path)


def stream_weather(spark, sf):
    """Payloads land, and the first part lands once more with the second."""
    rows = b.bronze(spark, sf)
    work = scratch(spark, "stream_weather")
    early = F.col("fetched_at") <= "2024-01-20"
    for part in (rows.filter(early), rows):
        part.write.mode("append").parquet(f"{work}/landing")
        pipelines.stream_weather(_parquet_stream(spark, rows.schema)(f"{work}/landing"), f"{work}/weather", work, RUN_TS)
    return spark.read.parquet(f"{work}/weather").select(*SILVER_WEATHER.names)


def stream_weather_left_out(spark, sf):
    """What the stream counts while it writes: a city's payloads come from unknown sources, another's without a source or a time."""
    city = F.col("city_id")
    rows = b.bronze(spark, sf).withColumns({
        "source": F.when(city == 0, "weatherstation").when(city != 1, F.col("source")),
        "fetched_at": F.when(city == 2, "no time").otherwise(F.col("fetched_at")),
    })
    work = scratch(spark, "stream_weather_left_out")
    rows.write.parquet(f"{work}/landing")
    lost = pipelines.stream_weather(_parquet_stream(spark, rows.schema)(f"{work}/landing"), f"{work}/weather", work, RUN_TS)
    return spark.createDataFrame(list(lost.items()), "reason string, row_count bigint")


def stream_dedup(spark, sf):
    """Readings land twice in full; the stream keeps each once."""
    rows = b.weather(spark, sf)
    work = scratch(spark, "stream_dedup")
    rows.unionByName(rows).write.mode("append").parquet(f"{work}/landing")
    pipelines.stream_dedup(_parquet_stream(spark, rows.schema)(f"{work}/landing"), f"{work}/weather", work, DELAY)
    return spark.read.schema(rows.schema).parquet(f"{work}/weather")


def _stream_consensus(spark, sf, name, bounds):
    """Readings land in two parts, in the order of ``bounds``."""
    rows = b.weather(spark, sf).withColumn("ingested_at", F.lit(RUN_TS).cast("timestamp"))
    work = scratch(spark, name)
    for bound in bounds:
        latest.incremental(rows, "fetched_at", **bound).write.mode("append").parquet(f"{work}/landing")
        weather = _parquet_stream(spark, rows.schema)(f"{work}/landing")
        pipelines.stream_consensus(weather, f"{work}/weather", f"{work}/consensus", work)
    return rounded_consensus(spark.read.parquet(f"{work}/consensus").drop(pipelines.CONSENSUS_DAY))


def stream_consensus(spark, sf):
    return _stream_consensus(spark, sf, "stream_consensus", ({"hi": b.SPLIT}, {"lo": b.SPLIT}))


def stream_consensus_late(spark, sf):
    """The later readings land first, so all of the second batch is days late."""
    return _stream_consensus(spark, sf, "stream_consensus_late", ({"lo": b.SPLIT}, {"hi": b.SPLIT}))


def stream_enrich(spark, sf):
    rows = b.orders(spark, sf)
    # the consensus as published, so that no batch computes it again
    tables.publish(gold.weather_consensus(b.weather(spark, sf)), "enrich_consensus", scratch(spark, "enrich_consensus"))
    static = b.versioned_stores(spark, sf), spark.table("enrich_consensus")
    work = _landed_in_two(
        spark, "stream_enrich", rows, "created_at", b.SPLIT, _parquet_stream(spark, rows.schema),
        lambda orders, work: pipelines.stream_enrich(orders, *static, f"{work}/enriched", work),
    )
    return spark.read.parquet(f"{work}/enriched")


def stream_current_weather(spark, sf):
    rows = b.weather(spark, sf).withColumn("ingested_at", F.lit(RUN_TS).cast("timestamp"))
    work = _landed_in_two(
        spark, "stream_current_weather", rows, "fetched_at", b.SPLIT, _parquet_stream(spark, rows.schema),
        lambda weather, work: pipelines.stream_current_state(weather, f"{work}/state", work),
    )
    return gold.current_weather(spark.read.parquet(f"{work}/state").drop("city_name"), b.cities(spark, sf))


def _lakehouse(spark, sf, prefix: str, with_sales: bool = True) -> None:
    """Land payloads and change events in two rounds, run the Silver jobs after each, build Gold."""
    work = scratch(spark, "lakehouse")
    bronze, lake = f"{work}/bronze", f"{work}/lake"
    cdc = {
        "orders": b.order_cdc(spark, sf), "order_details": b.order_detail_cdc(spark, sf),
        "products": b.part_cdc(spark, sf), "stores": b.nation_cdc(spark, sf),
    } if with_sales else {}
    payloads = b.bronze(spark, sf)
    early = F.try_to_timestamp("fetched_at") <= F.lit(b.SPLIT).cast("timestamp")
    for rows, bounds in ((payloads.filter(early), {"hi": b.SPLIT}), (payloads.filter(~early), {"lo": b.SPLIT})):
        bronze_source.write_bronze_weather(rows, f"{bronze}/weather")
        for name, events in cdc.items():
            part = latest.incremental(events, "source_timestamp", **bounds)
            part.write.mode("append").parquet(f"{bronze}/cdc/{name}")
        jobs.silver_weather(spark, bronze, lake, RUN_TS)
        jobs.silver_cdc(spark, bronze, lake, "parquet")
    jobs.build_gold(spark, lake, prefix, b.cities(spark, sf))


def lakehouse_fact(spark, sf):
    """The fact at the end of the whole way from raw files, through both Silver rounds."""
    _lakehouse(spark, sf, "lakehouse_")
    return rounded(spark.table("lakehouse_fact_sales_weather"), "temperature_c")


def lakehouse_current_weather(spark, sf):
    """The latest weather at the end of the same way, without any sales."""
    _lakehouse(spark, sf, "weatherhouse_", with_sales=False)
    return spark.table("weatherhouse_current_weather")


QUERIES: dict[str, Query] = {
    "weather_consensus": weather_consensus,
    "weather_consensus_one_vote": weather_consensus_one_vote,
    "condition_majority": condition_majority,
    "realtime_order_stats": realtime_order_stats,
    "fact_sales_weather": fact_sales_weather,
    "fact_sales_weather_versioned": fact_sales_weather_versioned,
    "fact_sales_weather_nested": fact_sales_weather_nested,
    "fact_sales_weather_unmatched": fact_sales_weather_unmatched,
    "sales_without_weather": sales_without_weather,
    "current_weather": current_weather,
    "scd2_history": scd2_history,
    "scd2_current": scd2_current,
    "scd2_apply_batch": scd2_apply_batch,
    "scd2_apply_batch_strict": scd2_apply_batch_strict,
    "scd2_invariants": scd2_invariants,
    "fact_asof_daily": fact_asof_daily,
    "asof_unmatched": asof_unmatched,
    "asof_unmatched_nested": asof_unmatched_nested,
    "asof_overlapping": _rough_asof(1000, False),
    "asof_overlapping_deep": _rough_asof(3, True),
    "cdc_keep_latest": cdc_keep_latest,
    "cdc_keep_latest_rank": cdc_keep_latest_rank,
    "cdc_incremental": cdc_incremental,
    "cdc_drop_deletes": cdc_drop_deletes,
    "cdc_deleted_last": cdc_deleted_last,
    "merge_orders": merge_orders,
    "merge_insert_only": merge_insert_only,
    "decode_datetime": decode_datetime,
    "silver_orders": silver_orders,
    "silver_orders_deletes": silver_orders_deletes,
    "silver_order_details": silver_order_details,
    "silver_products": silver_products,
    "silver_products_deletes": silver_products_deletes,
    "silver_stores": silver_stores,
    "normalize_openweather": _normalizer("openweather"),
    "normalize_openmeteo": _normalizer("openmeteo"),
    "normalize_tomorrowio": _normalizer("tomorrowio"),
    "silver_weather": silver_weather,
    "bronze_roundtrip": bronze_roundtrip,
    "active_dims": active_dims,
    "published_consensus": published_consensus,
    "preview_fact": preview_fact,
    "revenue_by_condition": revenue_by_condition,
    "delivery_ratio": delivery_ratio,
    "hourly_volume": hourly_volume,
    "hourly_volume_versioned": hourly_volume_versioned,
    "top_categories": top_categories,
    "status_scorecard": status_scorecard,
    "not_null_gold": not_null_gold,
    "unique_gold": unique_gold,
    "consensus_rules": consensus_rules,
    "order_stats_rules": order_stats_rules,
    "cdc_read_batch": cdc_read_batch,
    "table_append": table_append,
    "materialized_order_stats": materialized_order_stats,
    "registered_sources": registered_sources,
    "ingest_stamp": ingest_stamp,
    "city_slugs": city_slugs,
    "envelope_json": envelope_json,
    "weather_route_counts": weather_route_counts,
    "merge_orders_table_two_batches": merge_orders_table_two_batches,
    "merge_orders_moved_creation": merge_orders_moved_creation,
    "order_details_many_batches": order_details_many_batches,
    "stream_merge": stream_merge,
    "stream_merge_deletes": stream_merge_deletes,
    "stream_products_deletes": stream_products_deletes,
    "stream_order_stats": stream_order_stats,
    "stream_order_details": stream_order_details,
    "stream_products": stream_products,
    "stream_stores": stream_stores,
    "stream_weather": stream_weather,
    "stream_weather_left_out": stream_weather_left_out,
    "stream_dedup": stream_dedup,
    "stream_consensus": stream_consensus,
    "stream_consensus_late": stream_consensus_late,
    "stream_enrich": stream_enrich,
    "stream_current_weather": stream_current_weather,
    "lakehouse_fact": lakehouse_fact,
    "lakehouse_current_weather": lakehouse_current_weather,
}


def plain_timestamps(df: DataFrame) -> DataFrame:
    """Timestamps without a time zone (UTC wall time), as other engines hold them."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df


def registered(query: Query) -> Query:
    return lambda spark, sf_dir: plain_timestamps(query(configure(spark), sf_dir))


def queries() -> dict[str, Query]:
    return {name: registered(query) for name, query in QUERIES.items()}
