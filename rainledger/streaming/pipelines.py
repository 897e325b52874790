"""Streaming forms of the pipelines. They call the batch operators and give the same results."""

from __future__ import annotations

from contextlib import nullcontext

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rainledger.operators.asof import asof_scd2
from rainledger.operators.latest import latest_state
from rainledger.operators.quality import observed
from rainledger.plans.gold import STATS_GROUP, STATS_SUMS, added_sums, order_sums, signed_orders, stats_of_sums, weather_consensus
from rainledger.plans.silver import (
    KEYS,
    TRACKED,
    append_order_details,
    append_weather,
    apply_scd2_table,
    deletes,
    latest_changes,
    merge_orders_table,
    read_orders,
    read_weather,
)
from rainledger.plans.weather import counted_by_route, silver_weather
from rainledger.schemas import SILVER_PRODUCTS, SILVER_STORES, SILVER_WEATHER
from rainledger.sources.paths import exists, read_or_empty
from rainledger.sources.tables import Batch, drop_partitions, in_values, persisted, replace_partitions, staged, touched_values
from rainledger.streaming.runner import drain_batches, drain_to_parquet

DIMENSIONS = {"products": SILVER_PRODUCTS, "stores": SILVER_STORES}
STATS_DAY = "order_date"
CONSENSUS_DAY = "consensus_date"
STATE_PART = "part"  # the current state of all cities is one small partition
STATE = ["condition", "temperature", "wind_speed", "humidity"]


def stream_orders(events: DataFrame, table: str, work: str, stats: str | None = None,
                  apply_deletes: bool = False) -> None:
    """Upsert order events batch by batch; with ``stats``, keep the order statistics fresh too.

    An order stays in the day it was created on, whatever a later event says of that.
    Deletes are skipped; ``apply_deletes`` removes the order, and no older event brings it back.
    """
    drain_batches(events, lambda rows, batch: merge_orders_batch(rows, batch, table, work, stats, apply_deletes), f"{work}/checkpoint")


def merge_orders_batch(rows: DataFrame, batch: Batch, table: str, work: str, stats: str | None = None, apply_deletes: bool = False) -> None:
    """One batch of ``stream_orders``.

    A status change moves an order between groups: the batch's keys are taken from the statistics as they were and added
    as they are now. Both images are staged before the table changes and the statistics change once per
    batch, so a batch that is lost anywhere and repeated counts once. No other order is read for them, but for
    statistics that are not there yet, which begin with the whole table; so every run on a table has to name its statistics.
    """
    changes = []

    def keep(old: DataFrame, new: DataFrame) -> None:
        sums = added_sums(signed_orders(old, -1).unionByName(signed_orders(new)))
        changes.append(staged(sums, f"{work}/staged/changes", batch))

    # read several times below: to find the days, to merge, for the statistics
    with persisted(latest_changes(rows, "orders")) as source:
        gone = deletes(rows, "orders") if apply_deletes else None
        merge_orders_table(table, source, f"{work}/staged/orders", batch, deleted=gone, before=keep if stats else None)
    if stats:
        add_to_stats(changes[0], stats, table, f"{work}/staged/stats", batch)


def add_to_stats(changes: DataFrame, stats: str, table: str, staging: str, batch: Batch) -> None:
    """Add signed sums to the statistics of their days; days that no order is left for go."""
    spark = changes.sparkSession
    if exists(spark, stats):
        days = touched_values(changes, STATS_DAY)
        schema = stats_of_sums(changes).schema
        held = in_values(read_or_empty(spark, stats, schema), STATS_DAY, days)
        sums = added_sums(held.select(*STATS_GROUP, *STATS_SUMS).unionByName(changes))
    else:
        days, sums = [], order_sums(read_orders(spark, table))
    rows = stats_of_sums(sums)
    replace_partitions(rows, stats, [STATS_DAY], staging, batch)
    left = touched_values(read_or_empty(spark, f"{staging}/rows", rows.schema), STATS_DAY)
    drop_partitions(spark, stats, STATS_DAY, [d for d in days if d not in left])


def stream_order_details(events: DataFrame, table: str, work: str) -> None:
    """Insert unseen order lines batch by batch."""

    def insert(rows: DataFrame, batch: Batch) -> None:
        append_order_details(table, latest_changes(rows, "order_details").drop("source_timestamp"))

    drain_batches(events, insert, f"{work}/checkpoint")


def stream_dimension(events: DataFrame, name: str, table: str, work: str, apply_deletes: bool = False) -> int:
    """Apply product or store events to their versioned table batch by batch; how many came too late to count.

    Deletes are skipped; ``apply_deletes`` ends the open version, and no older event opens another.
    """
    late = []

    def apply(rows: DataFrame, batch: Batch) -> None:
        gone = deletes(rows, name) if apply_deletes else None
        late.append(apply_scd2_table(table, DIMENSIONS[name], latest_changes(rows, name), KEYS[name], TRACKED[name], gone))

    drain_batches(events, apply, f"{work}/checkpoint")
    return sum(late)


def stream_weather(bronze: DataFrame, table: str, work: str, run_ts: str | None = None, consensus: str | None = None,
                   state: str | None = None) -> dict[str, int]:
    """Normalize landed payloads and append each reading once, whenever its copies arrive.

    With ``consensus`` the hours a batch touches are voted on again, with ``state`` the
    latest weather of its cities is kept. Gives the rows of unknown sources and the readings
    without a time, none of which reach the table.
    """
    lost = {"unknown_source": 0, "no_time": 0}

    def add(rows: DataFrame, batch: Batch) -> None:
        routed, sources = counted_by_route(rows, "sources")
        parsed, times = observed(silver_weather(routed, run_ts), "times", no_time=F.count_if(F.col("fetched_at").isNull()))
        # read once, to append, unless the state is kept too
        with persisted(parsed) if state else nullcontext(parsed) as readings:
            _add_readings(readings, batch, table, work, consensus, state)
        # counted by the job that first went over the batch
        lost["unknown_source"] += sources.get["unknown"]
        lost["no_time"] += times.get["no_time"]

    drain_batches(bronze, add, f"{work}/checkpoint")
    return lost


def stream_consensus(weather: DataFrame, table: str, consensus: str, work: str) -> None:
    """Append normalized readings to ``table`` and keep the hourly consensus of all it holds fresh.

    The hours a batch touches are computed again from the table, so no reading is too late.
    """

    def add(rows: DataFrame, batch: Batch) -> None:
        _add_readings(rows, batch, table, work, consensus, None)

    drain_batches(weather, add, f"{work}/checkpoint")


def _add_readings(readings: DataFrame, batch: Batch, table: str, work: str, consensus: str | None, state: str | None) -> None:
    spark = readings.sparkSession
    days = append_weather(table, readings)
    if consensus and days:
        held = read_weather(spark, table)
        if exists(spark, consensus):  # else the table may hold days from before there was a consensus
            held = in_values(held, "fetched_date", days)
        voted = weather_consensus(held).withColumn(CONSENSUS_DAY, F.to_date("date_hour"))
        replace_partitions(voted, consensus, [CONSENSUS_DAY], f"{work}/staged/consensus", batch)
    if state:
        refresh_state(readings, state, f"{work}/staged/state", batch)


def refresh_state(readings: DataFrame, state: str, staging: str, batch: Batch) -> None:
    """Keep the latest reading of each city by reading time, whichever source it came from: one row per city."""
    cols = ["city_name", *STATE]
    fields = [f for f in SILVER_WEATHER if f.name in ("city_id", "fetched_at", *cols)]
    rows = readings.select(*[f.name for f in fields])
    schema = rows.withColumn(STATE_PART, F.lit(0)).schema
    held = read_or_empty(readings.sparkSession, state, schema).drop(STATE_PART)
    newest = latest_state(held.unionByName(rows), "city_id", "fetched_at", cols)
    replace_partitions(newest.withColumn(STATE_PART, F.lit(0)), state, [STATE_PART], staging, batch)


def stream_current_state(weather: DataFrame, state: str, work: str) -> None:
    """The latest weather per city from a stream of normalized readings."""

    def put(rows: DataFrame, batch: Batch) -> None:
        refresh_state(rows, state, f"{work}/staged", batch)

    drain_batches(weather, put, f"{work}/checkpoint")


def deduplicated(weather: DataFrame, delay: str) -> DataFrame:
    """Readings once per (source, city, fetch time), with state kept only for ``delay``.

    A copy that arrives later than the delay behind the newest reading is dropped as late.
    """
    return weather.withWatermark("fetched_at", delay).dropDuplicatesWithinWatermark(
        ["source", "city_id", "fetched_at"]
    )


def stream_dedup(weather: DataFrame, path: str, work: str, delay: str) -> int:
    """Append each reading once; how many readings came too late and were dropped."""
    return drain_to_parquet(deduplicated(weather, delay), path, f"{work}/checkpoint")


def stream_enrich(orders: DataFrame, stores: DataFrame, consensus: DataFrame, path: str, work: str) -> None:
    """Add the store's city at order time and the hour's weather to each order."""
    placed = asof_scd2(orders, stores.select("store_id", "city_id", "valid_from", "valid_to"), "store_id", "created_at")
    weather = consensus.select("city_id", "date_hour", F.col("majority_condition").alias("weather_condition"))
    enriched = placed.withColumn("date_hour", F.date_trunc("hour", "created_at")).join(
        weather, ["city_id", "date_hour"], "left"
    )
    drain_to_parquet(enriched, path, f"{work}/checkpoint")
