"""Explicit schemas, so that empty or missing input still has columns."""

from pyspark.sql import types as T

_NAMED = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(), "money": T.DecimalType(10, 2),
}


def struct(**fields: str | T.DataType) -> T.StructType:
    """A struct type from field names and types, or short names of types."""
    return T.StructType([T.StructField(n, _NAMED[t] if isinstance(t, str) else t) for n, t in fields.items()])


DATETIME = struct(date="date", time="bigint")

# payload columns as the source database sends them
PAYLOADS = {
    "orders": struct(
        order_id="string", store_id="bigint", customer_id="bigint", order_type="string", status="string",
        total_amount="money", created_at=DATETIME, updated_at=DATETIME,
    ),
    "order_details": struct(
        detail_id="string", order_id="string", product_id="bigint", quantity="bigint", unit_price="money",
        subtotal="money",
    ),
    "products": struct(product_id="bigint", category="string", price="money", is_active="boolean"),
    "stores": struct(store_id="bigint", city_id="bigint", is_active="boolean"),
}


def cdc_schema(table: str) -> T.StructType:
    """The change-event envelope around one table's payload."""
    return struct(
        uuid="string", read_timestamp="timestamp", source_timestamp="timestamp", object="string",
        read_method="string", stream_name="string", schema_key="string", sort_keys=T.ArrayType(T.StringType()),
        source_metadata=struct(change_type="string"), payload=PAYLOADS[table],
    )


BRONZE_WEATHER = struct(city_id="bigint", city_name="string", source="string", fetched_at="string", raw_json="string")
BRONZE_PARTITIONS = struct(source="string", year="int", month="int", day="int")

_VERSION = {"valid_from": "timestamp", "valid_to": "timestamp", "is_current": "boolean"}

SILVER_ORDERS = struct(
    order_id="string", store_id="int", customer_id="int", order_type="string", status="string",
    total_amount="double", created_at="timestamp", updated_at="timestamp",
)
SILVER_ORDER_DETAILS = struct(
    detail_id="string", order_id="string", product_id="int", quantity="int", unit_price="double", subtotal="double"
)
SILVER_PRODUCTS = struct(product_id="int", category="string", price="double", is_active="int", **_VERSION)
SILVER_STORES = struct(store_id="int", city_id="int", is_active="int", **_VERSION)
SILVER_WEATHER = struct(
    city_id="int", city_name="string", source="string", fetched_at="timestamp", temperature="double",
    humidity="int", pressure="double", wind_speed="double", condition="string", ingested_at="timestamp",
)
