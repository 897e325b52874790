"""Change events to Silver tables: flatten, keep the latest, merge or version.

The ``silver_*`` functions are pure: ``(target, events) -> new target``. The
``*_table`` functions apply the same to Parquet tables: orders by rewriting the days a batch
touches, versions and lines by appending.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger.functions.columns import datetime_struct_to_ts
from rainledger.operators.latest import deleted_keys, drop_deletes, incremental, keep_latest
from rainledger.operators.merge import merge_delete, merge_images, merge_insert_only, merge_upsert, not_in
from rainledger.operators.scd2 import current, scd2_apply, scd2_close, scd2_deltas
from rainledger.schemas import SILVER_ORDER_DETAILS, SILVER_ORDERS, SILVER_WEATHER, struct
from rainledger.sources.keyed import KeyedLog
from rainledger.sources.paths import exists, read_or_empty
from rainledger.sources.tables import (
    ORDERS_PARTITIONS,
    WEATHER_PARTITIONS,
    Batch,
    drop_partitions,
    in_values,
    partition_names,
    persisted,
    replace_partitions,
    staged,
    touched_values,
    with_partitions,
)

KEYS = {"orders": "order_id", "order_details": "detail_id", "products": "product_id", "stores": "store_id"}
TRACKED = {"products": ["category", "price", "is_active"], "stores": ["city_id", "is_active"]}
ORDER_UPDATES = ["status", "total_amount", "updated_at"]

# payload column -> Silver type; datetime structs are decoded
CASTS = {
    "orders": {"order_id": "string", "store_id": "int", "customer_id": "int", "order_type": "string",
               "status": "string", "total_amount": "double", "created_at": "datetime", "updated_at": "datetime"},
    "order_details": {"detail_id": "string", "order_id": "string", "product_id": "int", "quantity": "int",
                      "unit_price": "double", "subtotal": "double"},
    "products": {"product_id": "int", "category": "string", "price": "double", "is_active": "int"},
    "stores": {"store_id": "int", "city_id": "int", "is_active": "int"},
}


def _payload(name: str, to: str) -> Column:
    col = F.col(f"payload.{name}")
    return (datetime_struct_to_ts(col) if to == "datetime" else col.cast(to)).alias(name)


def flatten(events: DataFrame, table: str) -> DataFrame:
    """The table's columns out of the payload, plus what ordering and deletes need."""
    return events.select(
        *[_payload(name, to) for name, to in CASTS[table].items()],
        "source_timestamp",
        F.col("uuid").alias("__uuid"),
        F.col("source_metadata.change_type").alias("__op"),
    )


def latest_changes(events: DataFrame, table: str, lo=None, hi=None, ties: str = "one") -> DataFrame:
    """The newest non-delete event per key within ``(lo, hi]``."""
    rows = flatten(drop_deletes(incremental(events, "source_timestamp", lo, hi)), table)
    return keep_latest(rows, KEYS[table], "source_timestamp", ("__uuid",), ties).drop("__uuid", "__op")


def deletes(events: DataFrame, table: str, lo=None, hi=None) -> DataFrame:
    """Keys whose newest event within ``(lo, hi]`` is a delete."""
    rows = flatten(incremental(events, "source_timestamp", lo, hi), table)
    return deleted_keys(rows, KEYS[table], "source_timestamp", "__op")


def silver_orders(target: DataFrame, events: DataFrame, lo=None, hi=None, apply_deletes: bool = False) -> DataFrame:
    """Orders: newer events update status, amount and update time; nothing else ever changes.

    Deletes are skipped, as a key then keeps its last other image; ``apply_deletes``
    removes keys whose newest event is a delete.
    """
    source = latest_changes(events, "orders", lo, hi).drop("source_timestamp")
    merged = merge_upsert(target, source, "order_id", "updated_at", ORDER_UPDATES)
    return merge_delete(merged, deletes(events, "orders", lo, hi), "order_id") if apply_deletes else merged


def silver_order_details(target: DataFrame, events: DataFrame, lo=None, hi=None,
                         apply_deletes: bool = False) -> DataFrame:
    """Order lines: inserted once, never changed."""
    source = latest_changes(events, "order_details", lo, hi).drop("source_timestamp")
    merged = merge_insert_only(target, source, "detail_id")
    return merge_delete(merged, deletes(events, "order_details", lo, hi), "detail_id") if apply_deletes else merged


def _silver_dimension(table: str, target: DataFrame, events: DataFrame, lo, hi, apply_deletes: bool,
                      strict_ref: bool) -> DataFrame:
    incoming = latest_changes(events, table, lo, hi)
    versions = scd2_apply(target, incoming, KEYS[table], TRACKED[table], strict_ref=strict_ref)
    if not apply_deletes:
        return versions
    return scd2_close(versions, deletes(events, table, lo, hi), KEYS[table], "source_timestamp")


def silver_products(target: DataFrame, events: DataFrame, lo=None, hi=None, apply_deletes: bool = False,
                    strict_ref: bool = False) -> DataFrame:
    """Product versions by category, price and active flag."""
    return _silver_dimension("products", target, events, lo, hi, apply_deletes, strict_ref)


def silver_stores(target: DataFrame, events: DataFrame, lo=None, hi=None, apply_deletes: bool = False,
                  strict_ref: bool = False) -> DataFrame:
    """Store versions by city and active flag."""
    return _silver_dimension("stores", target, events, lo, hi, apply_deletes, strict_ref)


# --- Parquet tables, changed by partition or appended to by key ----------------------------

PLACES = struct(order_id="string", created_date="date", at="timestamp", deleted="boolean")


def read_orders(spark: SparkSession, path: str, schema=SILVER_ORDERS) -> DataFrame:
    return read_or_empty(spark, path, with_partitions(spark.createDataFrame([], schema), ORDERS_PARTITIONS).schema)


def order_places(path: str) -> KeyedLog:
    """Where each order of the table lies: the day it was created on, or that it was deleted, since ``at``."""
    return KeyedLog(f"{path.rstrip('/')}_places", "order_id", PLACES, compact=_newest_place)


def _newest_place(places: DataFrame) -> DataFrame:
    return keep_latest(places, "order_id", "at", ("deleted",))


def merge_orders_table(path: str, source: DataFrame, staging: str, batch: Batch, schema=SILVER_ORDERS,
                       deleted: DataFrame | None = None,
                       before: Callable[[DataFrame, DataFrame], None] | None = None) -> DataFrame:
    """Upsert a batch (one row per key) into the orders table and return its changed days.

    Orders lie in the day they were created on, whatever later events say of it. That day is looked up in the
    table's places, so a batch reads and writes the days of its own keys only. The batch's rows are staged, then new keys are
    placed, then the rows move to the table: a batch that is repeated in between finds what it staged and keys where it put them.
    All that is read from the places is used before they are written, as Spark computes it anew after that.

    ``deleted`` has keys whose newest event is a delete, with its ``source_timestamp``. Their rows go and a tombstone stays
    among the places, so no event up to that time brings a key back, in whatever batch it comes. Events are
    timed by ``source_timestamp`` if the batch has it, else by ``updated_at``.

    ``before(old, new)`` is called with the images of the batch's own keys before anything of the table is replaced.
    A batch that is repeated calls it again, then perhaps on a table that it changed already, so what it keeps has to be ``staged``.
    """
    spark = source.sparkSession
    day = partition_names(ORDERS_PARTITIONS)[0]
    places = order_places(path)
    if not exists(spark, places.path) and exists(spark, path):  # a table from before it had places
        held = read_orders(spark, path, schema).select("order_id", day, F.col("updated_at").alias("at"), F.lit(False).alias("deleted"))
        places.append(held, ["order_id", "at", "deleted"])
    at = "source_timestamp" if "source_timestamp" in source.columns else "updated_at"
    with ExitStack() as kept:
        keep = lambda df: kept.enter_context(persisted(df))
        located = _located(places, keep(source), at)
        rows = keep(located)
        # a key that is NULL is found nowhere, so it gets no place
        fresh = rows.filter("__new AND order_id IS NOT NULL").select("order_id", day, F.col(at).alias("at"), F.lit(False).alias("deleted"))
        touched = touched_values(rows, day)
        gone = None
        if deleted is not None:
            ends = keep(_ends(places, keep(deleted), fresh))
            gone = ends.filter("__buried OR deleted").select("order_id", day)
            touched = list({*touched, *touched_values(gone, day)})
        target = in_values(read_orders(spark, path, schema), day, touched)
        merged = merge_upsert(target, rows, "order_id", "updated_at", ORDER_UPDATES)
        if gone is not None:
            merged = merge_delete(merged, gone, "order_id")
        if before:
            keys = rows.select("order_id")
            old = keep(target.join(keys.union(gone.select("order_id")) if gone is not None else keys, "order_id", "left_semi"))
            new = merge_images(old, rows, "order_id", "updated_at", ORDER_UPDATES)
            before(old, merge_delete(new, gone, "order_id") if gone is not None else new)
        staged(merged, staging, batch)
        stones = None
        if gone is not None:
            is_new = F.col("order_id").isNotNull() & F.col("__buried") & ~(F.coalesce("deleted", F.lit(False)) & F.col("at").eqNullSafe(F.col("__end")))
            stones = ends.filter(is_new).select("order_id", day, F.col("__end").alias("at"), F.lit(True).alias("deleted"))
        places.add(fresh if stones is None else fresh.unionByName(stones))
        replace_partitions(merged, path, [day], staging, batch)
        if gone is not None:
            left = touched_values(read_or_empty(spark, f"{staging}/rows", merged.schema), day)
            drop_partitions(spark, path, day, [d for d in touched if d not in left])
    return in_values(read_orders(spark, path, schema), day, touched)


def _located(places: KeyedLog, source: DataFrame, at: str) -> DataFrame:
    """The events that count, with the day their order lies in and whether it has no place yet (``__new``)."""
    day = partition_names(ORDERS_PARTITIONS)[0]
    known = _newest_place(places.lookup(source, null_safe=False)).select(
        F.col("order_id").alias("__key"), F.col(day).alias("__day"), F.col("at").alias("__at"), F.col("deleted").alias("__deleted"))
    joined = with_partitions(source, ORDERS_PARTITIONS).join(known, F.col("order_id") == F.col("__key"), "left")
    back = F.col("__deleted") & (F.col(at).isNull() | (F.col(at) <= F.col("__at")))
    lies = F.col("__deleted").isNotNull() & ~F.col("__deleted")
    return joined.filter(~F.coalesce(back, F.lit(False))).select(
        *source.columns, F.when(lies, F.col("__day")).otherwise(F.col(day)).alias(day), (~F.coalesce(lies, F.lit(False))).alias("__new"))


def _ends(places: KeyedLog, deleted: DataFrame, fresh: DataFrame) -> DataFrame:
    """The deleted keys with their newest place, those of this batch included, and whether the delete buries them (``__buried``).

    A delete buries a key that has no place or got it no later. A key whose place is a tombstone already is deleted too."""
    ends = deleted.select("order_id", F.col("source_timestamp").alias("__end"))
    own = fresh.join(ends.select("order_id"), "order_id", "left_semi")
    held = _newest_place(places.lookup(deleted, null_safe=False).unionByName(own))
    return ends.join(held, "order_id", "left").withColumn("__buried", F.col("at").isNull() | (F.col("__end") >= F.col("at")))


def open_versions(path: str, schema: T.StructType) -> KeyedLog:
    """The versions and tombstones that began, by key, the first column; a key's newest one counts."""
    key = schema.names[0]
    return KeyedLog(f"{path}/open", key, schema, compact=lambda rows: keep_latest(rows, key, "valid_from"))


def closed_versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The versions that ended, by the month they ended in."""
    return read_or_empty(spark, f"{path}/closed", T.StructType([*schema.fields, T.StructField("closed_in", T.IntegerType())]))


def scd2_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A versioned table: the newest version of each key that is not deleted, and all that ended."""
    newest = keep_latest(open_versions(path, schema).rows(spark), schema.names[0], "valid_from")
    return current(newest).unionByName(closed_versions(spark, path, schema).select(*schema.names))


def apply_scd2_table(path: str, schema: T.StructType, incoming: DataFrame, key: str, tracked: list[str],
                     deleted: DataFrame | None = None) -> int:
    """Apply a batch (one row per key) to a versioned table; how many late events it ignored.

    Only adds rows: versions that end, in the month they end in, and versions that begin, in the hash part
    of their key. So what a batch writes follows the batch. Ended versions are written first; a batch that is
    repeated, after a loss at any point, finds what it wrote and adds the rest.

    ``deleted`` has keys whose newest event is a delete, with its ``source_timestamp``: their open versions end and
    tombstones begin, so no event up to that time brings a key back.
    """
    late = _append_versions(path, schema, incoming, key, tracked, False)
    if deleted is not None:
        late += _append_versions(path, schema, deleted, key, tracked, True)
    return late


def _append_versions(path: str, schema: T.StructType, incoming: DataFrame, key: str, tracked: list[str], deletes: bool) -> int:
    spark = incoming.sparkSession
    log = open_versions(path, schema)
    begin = [key, "valid_from"]
    with persisted(incoming) as events:
        held = keep_latest(log.lookup(events), key, "valid_from")
        with persisted(scd2_deltas(held, events, key, tracked, deletes=deletes)) as steps:
            month = F.date_format("valid_to", "yyyyMM").cast("int")
            ended = steps.filter("ended IS NOT NULL").select("ended.*").withColumn("closed_in", month)
            # a row per month: the months to look into, and how many events are late, in one job
            months = steps.groupBy(F.date_format("ended.valid_to", "yyyyMM").cast("int").alias("closed_in")).agg(
                F.count_if("late").alias("late")).collect()
            before = in_values(closed_versions(spark, path, schema), "closed_in", [m.closed_in for m in months if m.closed_in is not None])
            fresh = not_in(ended, before, begin, null_safe=True)
            fresh.hint("rebalance", "closed_in").write.mode("append").partitionBy("closed_in").parquet(f"{path}/closed")
            log.append(steps.filter("begun IS NOT NULL").select("begun.*"), begin)
    return sum(m.late for m in months)


def order_details_log(path: str) -> KeyedLog:
    return KeyedLog(path, "detail_id", SILVER_ORDER_DETAILS)


def read_order_details(spark: SparkSession, path: str) -> DataFrame:
    return order_details_log(path).rows(spark)


def append_order_details(path: str, rows: DataFrame) -> None:
    """Append the lines of a batch (one row per key) that the table does not hold yet.

    A repeated batch finds what it appended before, in whole or in part, and a line
    without a key too. Only the hash parts the batch's keys fall into are searched, and their number grows with the table.
    """
    with persisted(rows) as lines:
        order_details_log(path).append(lines, ["detail_id"])


def append_weather(path: str, rows: DataFrame) -> list:
    """Append weather readings, each (source, city, fetch time) once, and give the days touched.

    Only the days of the batch are searched for readings already held; a reading without a
    city or source is told from others like any. Readings without a time cannot be told
    apart from their copies and are left out.
    """
    spark = rows.sparkSession
    names = partition_names(WEATHER_PARTITIONS)
    key = ["source", "city_id", "fetched_at"]
    # parsed once, read three times: for its days, to look up held readings, to write
    timed = rows.filter(F.col("fetched_at").isNotNull())
    with persisted(with_partitions(keep_latest(timed, key, "ingested_at"), WEATHER_PARTITIONS)) as readings:
        days = touched_values(readings, "fetched_date")
        held = in_values(read_weather(spark, path), "fetched_date", days)
        fresh = not_in(readings, held, key, null_safe=True)
        fresh.hint("rebalance", *names).write.mode("append").partitionBy(*names).parquet(path)
    return days


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, with_partitions(spark.createDataFrame([], SILVER_WEATHER), WEATHER_PARTITIONS).schema)
