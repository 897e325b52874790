"""The test tables in the roles of this engine: Spark expressions over the given Parquet files.

cities = region, stores = nation, products = part, order lines = lineitem, weather
readings and change events = events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainledger.functions.columns import ts_to_datetime_struct
from rainledger.schemas import cdc_schema

SPLIT = "2024-01-20 00:00:00"
DETAILS_SPLIT = "2024-01-01 12:00:00"
START = "2024-01-01 00:00:00"
MOVED = "2024-01-11 00:00:00"
RECLASSIFIED = "2024-01-16 00:00:00"
CHANGED = "2024-01-21 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _source():
    third = F.col("event_id") % 3
    return F.when(third == 0, "openweather").when(third == 1, "openmeteo").otherwise("tomorrowio")


def _city():
    return F.col("user_id") % 5


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        _city().cast("int").alias("city_id"),
        F.concat(F.lit("CITY_"), _city()).alias("city_name"),
        _source().alias("source"),
        F.col("ts").alias("fetched_at"),
        F.col("value").alias("temperature"),
        (F.col("event_id") % 100).cast("int").alias("humidity"),
        (F.col("user_id") % 40 + 980).cast("double").alias("pressure"),
        (F.col("event_id") % 30 / F.lit(4.0)).alias("wind_speed"),
        F.col("event_type").alias("condition"),
    )


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads in three dialects; every fiftieth openweather one has no conditions."""
    third, humidity = F.col("event_id") % 3, (F.col("event_id") % 100).cast("string")
    temperature = F.col("value").cast("string")
    conditions = F.when(F.col("event_id") % 50 == 0, "[]").otherwise(
        F.concat(F.lit('[{"main":"'), "event_type", F.lit('"}]'))
    )
    openweather = F.concat(
        F.lit('{"main":{"temp":'), temperature, F.lit(',"humidity":'), humidity,
        F.lit(',"pressure":1013},"wind":{"speed":3.5},"weather":'), conditions, F.lit("}"),
    )
    openmeteo = F.concat(
        F.lit('{"current":{"temperature_2m":'), temperature, F.lit(',"relative_humidity_2m":'), humidity,
        F.lit(',"surface_pressure":1009.5,"wind_speed_10m":36.0,"weather_code":'), humidity, F.lit("}}"),
    )
    tomorrowio = F.concat(
        F.lit('{"data":{"values":{"temperature":'), temperature, F.lit(',"humidity":'), humidity,
        F.lit('.9,"pressureSurfaceLevel":1008.25,"windSpeed":2.25,"weatherCode":'),
        (F.col("event_id") % 9 * 1000).cast("string"), F.lit("}}}"),
    )
    return events(spark, sf_dir).select(
        _city().alias("city_id"),
        F.concat(F.lit("CITY_"), _city()).alias("city_name"),
        _source().alias("source"),
        F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("+00:00")).alias("fetched_at"),
        F.when(third == 0, openweather).when(third == 1, openmeteo).otherwise(tomorrowio).alias("raw_json"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders re-timed to January 2024, minute grain; the store is the customer's nation."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    minute = (F.col("o_orderkey") * 7919) % 43200
    created = F.timestamp_seconds(F.unix_seconds(F.lit(START).cast("timestamp")) + minute * 60)
    return table(spark, sf_dir, "orders").join(customers, "o_custkey").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("c_nationkey").alias("store_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), "Delivery").otherwise("Dine-in").alias("order_type"),
        F.when(status == "F", "Completed").when(status == "O", "Pending").otherwise("Cancelled").alias("status"),
        F.col("o_totalprice").alias("total_amount"),
        created.alias("created_at"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("subtotal"),
    )


def _always(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "valid_from": F.lit(START).cast("timestamp"),
            "valid_to": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
        }
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One open version per part."""
    return _always(
        table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_type").alias("category"))
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One open version per nation."""
    return _always(
        table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").alias("store_id"), F.col("n_regionkey").alias("city_id")
        )
    )


def _two_versions(df: DataFrame, before: dict, after: dict, at: str) -> DataFrame:
    """Each row as a version closed at ``at`` and an open one from then on."""
    start, change = F.lit(START).cast("timestamp"), F.lit(at).cast("timestamp")
    versions = F.array(
        F.struct(*[c.alias(n) for n, c in before.items()], start.alias("valid_from"), change.alias("valid_to"),
                 F.lit(False).alias("is_current")),
        F.struct(*[c.alias(n) for n, c in after.items()], change.alias("valid_from"),
                 F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current")),
    )
    return df.select(F.inline(versions))


def versioned_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts change category from type to brand in mid-month."""
    key = F.col("p_partkey")
    return _two_versions(
        table(spark, sf_dir, "part"),
        {"product_id": key, "category": F.col("p_type")},
        {"product_id": key, "category": F.col("p_brand")},
        RECLASSIFIED,
    )


def versioned_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations move to the next region on the eleventh."""
    key, city = F.col("n_nationkey"), F.col("n_regionkey")
    return _two_versions(
        table(spark, sf_dir, "nation"),
        {"store_id": key, "city_id": city},
        {"store_id": key, "city_id": ((city + 1) % 5).cast("int")},
        MOVED,
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("city_id"), F.col("r_name").alias("city_name")
    )


def cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat change events of a product per user: signup inserts, error deletes, the rest update."""
    kind = F.col("event_type")
    return events(spark, sf_dir).select(
        F.col("event_id").alias("uuid"),
        F.col("ts").alias("source_timestamp"),
        F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").otherwise("UPDATE").alias("change_type"),
        F.col("user_id").cast("int").alias("product_id"),
        kind.alias("category"),
        F.col("value").alias("price"),
        (F.col("event_id") % 2).cast("int").alias("is_active"),
    )


def category_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc(spark, sf_dir).filter("change_type <> 'DELETE'")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The errors of a product's users: facts that are no version of it."""
    return cdc(spark, sf_dir).filter("change_type = 'DELETE'").select(
        "product_id", F.col("source_timestamp").alias("happened_at"), F.col("price").alias("amount")
    )


def gap_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category events of which every third has no category."""
    known = F.when(F.col("uuid") % 3 != 0, F.col("category"))
    return category_events(spark, sf_dir).select("product_id", known.alias("category"), "source_timestamp", "uuid")


def rough_versions(spark: SparkSession, sf_dir: str, keys: int) -> DataFrame:
    """Versions as they should not be: overlapping, empty, negative and several open ones, for so many keys."""
    hours = F.col("event_id") % 7 - 2
    end = F.timestamp_micros(F.unix_micros("ts") + hours * F.lit(3_600_000_000))
    return events(spark, sf_dir).filter("event_type <> 'error'").select(
        (F.col("user_id") % keys).cast("int").alias("product_id"),
        F.col("event_type").alias("category"),
        F.col("ts").alias("valid_from"),
        F.when(F.col("event_id") % 97 != 0, end).alias("valid_to"),
        (F.col("event_id") % 97 == 0).alias("is_current"),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order updates, every tenth of which carries an old update time."""
    stale = F.col("event_id") % 10 == 0
    month_ago = F.timestamp_micros(F.unix_micros("ts") - F.lit(30 * 86_400_000_000))
    return events(spark, sf_dir).select(
        F.col("user_id").alias("order_id"),
        F.col("event_type").alias("status"),
        F.col("value").alias("total_amount"),
        "event_id",
        F.when(stale, month_ago).otherwise(F.col("ts")).alias("updated_at"),
        F.col("ts").alias("source_timestamp"),
    )


def _envelope(df: DataFrame, name: str, uuid, ts, op, payload: dict) -> DataFrame:
    """Rows as change events with the table's payload."""
    schema = cdc_schema(name)
    fields = schema["payload"].dataType
    body = F.struct(*[payload[f.name].cast(f.dataType).alias(f.name) for f in fields])
    null = F.lit(None)
    columns = {
        "uuid": uuid.cast("string"),
        "read_timestamp": ts,
        "source_timestamp": ts,
        "object": F.lit(name),
        "source_metadata": F.struct(op.alias("change_type")),
        "payload": body,
    }
    return df.select(*[columns.get(f.name, null).cast(f.dataType).alias(f.name) for f in schema])


def order_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three steps of every order: inserted as Pending, then its final status half an hour
    later, then, for low-priority customers' dine-in orders, a delete."""
    base = orders(spark, sf_dir)
    minutes = lambda n: F.timestamp_seconds(F.unix_seconds("created_at") + 60 * n)
    steps = F.array(
        F.struct(F.lit("INSERT").alias("op"), F.col("created_at").alias("at"), F.lit("Pending").alias("step_status"),
                 F.lit(0.0).alias("amount")),
        F.struct(F.lit("UPDATE").alias("op"), minutes(30).alias("at"), F.col("status").alias("step_status"),
                 F.col("total_amount").alias("amount")),
        F.struct(F.when(F.col("store_id") < 5, "DELETE").alias("op"), minutes(60).alias("at"),
                 F.col("status").alias("step_status"), F.col("total_amount").alias("amount")),
    )
    rows = base.select("order_id", "store_id", "customer_id", "order_type", "created_at", F.inline(steps))
    return _envelope(
        rows.filter("op IS NOT NULL"), "orders", F.concat_ws("-", "order_id", "op"), F.col("at"), F.col("op"),
        {
            "order_id": F.col("order_id"), "store_id": F.col("store_id"), "customer_id": F.col("customer_id"),
            "order_type": F.col("order_type"), "status": F.col("step_status"), "total_amount": F.col("amount"),
            "created_at": ts_to_datetime_struct(F.col("created_at")), "updated_at": ts_to_datetime_struct(F.col("at")),
        },
    )


def order_detail_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as inserts; (order, line number) repeats, so later images of a line exist."""
    at = F.timestamp_seconds(F.unix_seconds(F.lit(START).cast("timestamp")) + F.col("l_partkey") * 60)
    uuid = F.concat_ws(
        "-", *[F.lpad(F.col(c).cast("bigint").cast("string"), 12, "0") for c in ("l_suppkey", "l_quantity")],
        F.col("l_shipdate").cast("date").cast("string"),
    )
    return _envelope(
        table(spark, sf_dir, "lineitem"), "order_details", uuid, at, F.lit("INSERT"),
        {
            "detail_id": F.concat_ws("-", "l_orderkey", "l_linenumber"), "order_id": F.col("l_orderkey"),
            "product_id": F.col("l_partkey"), "quantity": F.col("l_quantity"), "unit_price": F.col("l_tax"),
            "subtotal": F.col("l_extendedprice"),
        },
    )


def product_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = cdc(spark, sf_dir)
    return _envelope(
        flat, "products", F.col("uuid"), F.col("source_timestamp"), F.col("change_type"),
        {c: F.col(c) for c in ("product_id", "category", "price")} | {"is_active": F.col("is_active") == 1},
    )


def store_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = cdc(spark, sf_dir)
    return _envelope(
        flat, "stores", F.col("uuid"), F.col("source_timestamp"), F.col("change_type"),
        {"store_id": F.col("product_id") % 50, "city_id": F.col("uuid") % 3, "is_active": F.col("is_active") == 1},
    )


def _two_events(df: DataFrame, table: str, key, before: dict, after: dict) -> DataFrame:
    """Every row inserted at the start and updated after the split, as change events."""
    step = lambda op, at, payload: F.struct(
        F.lit(op).alias("op"), F.lit(at).cast("timestamp").alias("at"), *[c.alias(n) for n, c in payload.items()])
    steps = df.select(key.alias("key"), F.explode(F.array(step("INSERT", START, before), step("UPDATE", CHANGED, after))).alias("s"))
    payload = {next(iter(cdc_schema(table)["payload"].dataType)).name: F.col("key")} | {n: F.col(f"s.{n}") for n in before}
    return _envelope(steps, table, F.concat_ws("-", "key", "s.op"), F.col("s.at"), F.col("s.op"), payload)


def part_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a product whose category changes from type to brand."""
    own = {"price": F.col("p_retailprice"), "is_active": F.lit(True)}
    return _two_events(
        table(spark, sf_dir, "part"), "products", F.col("p_partkey"),
        {"category": F.col("p_type"), **own}, {"category": F.col("p_brand"), **own},
    )


def nation_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every nation as a store that moves to the next region."""
    city = F.col("n_regionkey").cast("bigint")
    return _two_events(
        table(spark, sf_dir, "nation"), "stores", F.col("n_nationkey"),
        {"city_id": city, "is_active": F.lit(True)}, {"city_id": (city + 1) % 5, "is_active": F.lit(True)},
    )


def master_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product master data; the smallest sizes are no longer sold."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size") > 5).cast("int").alias("is_active"),
    )


def master_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store master data; the last region is closed."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("store_id"),
        F.col("n_regionkey").alias("city_id"),
        (F.col("n_regionkey") < 4).cast("int").alias("is_active"),
    )


def master_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name")
    )


def master_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City master data, all active."""
    return cities(spark, sf_dir).withColumns(
        {"lat": F.col("city_id") * 10.5, "lon": F.col("city_id") * 20.25, "is_active": F.lit(1)}
    )
