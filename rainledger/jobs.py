"""The lakehouse jobs: Bronze to Silver, Silver to Gold.

Each run takes in what has landed since the last one (the stream checkpoints are the
bookmark) and may be repeated. Submit as::

    spark-submit rainledger/jobs.py silver --bronze <folder> --lake <folder> [--format avro] [--max-files n] [--since time]
    spark-submit rainledger/jobs.py gold   --lake <folder>

with the package on the Python path.

Below ``--bronze`` lie ``weather/source=/year=/month=/day=`` and one change-event folder
per table, ``cdc/orders`` and so on. Folders must be shared by all executors.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger.operators import quality
from rainledger.operators.latest import incremental
from rainledger.plans import gold, silver
from rainledger.schemas import (
    BRONZE_PARTITIONS,
    BRONZE_WEATHER,
    SILVER_PRODUCTS,
    SILVER_STORES,
    SILVER_WEATHER,
)
from rainledger.session import build_session
from rainledger.sources.cdc import read_cdc_stream
from rainledger.sources.paths import exists
from rainledger.sources.tables import ChecksFailed, publish
from rainledger.streaming import pipelines

CDC_TABLES = ["orders", "order_details", "products", "stores"]
STATS_GRAIN = ["order_hour", "store_id", "order_type", "status"]
# A key without an open version is one that was deleted; every other rule has to hold.
DIMENSION_RULES = ["several_open", "overlap", "bad_interval"]


def silver_weather(spark: SparkSession, bronze: str, lake: str, run_ts: str | None = None,
                   max_files: int | None = None, since: str | None = None) -> dict[str, int]:
    """Normalize the weather payloads that landed, keep the latest weather per city and the hourly consensus fresh;
    the rows that were left out."""
    if not exists(spark, f"{bronze}/weather"):
        return {}
    fields = [f for f in BRONZE_WEATHER if f.name != "source"] + list(BRONZE_PARTITIONS)
    reader = spark.readStream.schema(T.StructType(fields))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    landed = reader.parquet(f"{bronze}/weather").select(*BRONZE_WEATHER.names)
    if since:
        landed = landed.filter(F.try_to_timestamp("fetched_at") > F.lit(since).cast("timestamp"))
    return pipelines.stream_weather(
        landed, f"{lake}/silver/weather", f"{lake}/work/weather", run_ts, f"{lake}/silver/consensus", f"{lake}/silver/current_state"
    )


def hourly_consensus(spark: SparkSession, lake: str) -> DataFrame:
    """The consensus the Silver job keeps fresh; voted on from all readings where there is none yet."""
    path = f"{lake}/silver/consensus"
    if exists(spark, path):
        return spark.read.parquet(path).drop(pipelines.CONSENSUS_DAY)
    return gold.weather_consensus(silver_tables(spark, lake)["weather"])


def silver_cdc(spark: SparkSession, bronze: str, lake: str, fmt: str = "avro", max_files: int | None = None,
               since: str | None = None, apply_deletes: bool = False) -> dict[str, int]:
    """Apply the change events that landed, and keep the order statistics fresh.

    A table whose folder is not there yet is left for a later run. ``max_files`` splits a
    large backlog into several batches; ``since`` leaves out events up to that time. Gives
    the events per dimension that came too late to count. ``apply_deletes`` removes deleted orders and
    ends deleted products and stores; order lines are never removed.
    """
    late = {}
    for table in CDC_TABLES:
        if not exists(spark, f"{bronze}/cdc/{table}"):
            continue
        events = read_cdc_stream(spark, f"{bronze}/cdc/{table}", table, fmt, max_files=max_files)
        events = incremental(events, "source_timestamp", lo=since)
        path, work = f"{lake}/silver/{table}", f"{lake}/work/{table}"
        if table == "orders":
            pipelines.stream_orders(events, path, work, f"{lake}/gold/realtime_order_stats", apply_deletes)
        elif table == "order_details":
            pipelines.stream_order_details(events, path, work)
        else:
            late[table] = pipelines.stream_dimension(events, table, path, work, apply_deletes)
    return late


def silver_tables(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    """The Silver tables as DataFrames; one that was never written has no rows."""
    return {
        "orders": silver.read_orders(spark, f"{lake}/silver/orders"),
        "order_details": silver.read_order_details(spark, f"{lake}/silver/order_details"),
        "products": silver.scd2_table(spark, f"{lake}/silver/products", SILVER_PRODUCTS),
        "stores": silver.scd2_table(spark, f"{lake}/silver/stores", SILVER_STORES),
        "weather": silver.read_weather(spark, f"{lake}/silver/weather").select(*SILVER_WEATHER.names),
    }


def register_silver(spark: SparkSession, lake: str, prefix: str = "silver_") -> None:
    """Give the Silver tables names for SQL in this session."""
    for name, df in silver_tables(spark, lake).items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def check_silver(spark: SparkSession, lake: str) -> None:
    """Raise if an order or a line is there twice, a dimension has overlapping or several open versions, or the
    order statistics a repeated group."""
    tables = silver_tables(spark, lake)
    for name in ("orders", "order_details"):
        key = silver.KEYS[name]
        _require(quality.check_unique(tables[name].filter(F.col(key).isNotNull()), [key]), name)
    for name in pipelines.DIMENSIONS:
        rules = quality.check_scd2(tables[name], silver.KEYS[name]).filter(F.col("rule").isin(DIMENSION_RULES))
        _require(rules, name)
    if exists(spark, f"{lake}/gold/realtime_order_stats"):
        stats = spark.read.parquet(f"{lake}/gold/realtime_order_stats")
        _require(quality.table_rules(stats, ["order_hour", "order_count"], STATS_GRAIN), "realtime_order_stats")


def _require(rules: DataFrame, name: str) -> None:
    broken = rules.filter("violations > 0").collect()  # a row per rule
    if broken:
        raise ChecksFailed(f"{name}: {'; '.join(str(r.asDict()) for r in broken)}")


def build_gold(spark: SparkSession, lake: str, prefix: str = "", cities: DataFrame | None = None) -> dict[str, str]:
    """Rebuild, check and publish the Gold models; gives the new version's folder per model.

    A model whose checks fail raises, and its readers keep the version before. ``cities`` are
    the cities that have current weather; without them, all that were ever read.
    """
    check_silver(spark, lake)
    tables = silver_tables(spark, lake)
    consensus = publish(
        hourly_consensus(spark, lake), f"{prefix}weather_consensus", f"{lake}/gold",
        lambda df: quality.table_rules(df, ["city_id", "date_hour"], ["city_id", "date_hour"]),
    )
    fact = gold.fact_sales_weather(
        tables["orders"], tables["order_details"], tables["products"], tables["stores"],
        spark.table(f"{prefix}weather_consensus"),
    )
    versions = {
        "weather_consensus": consensus,
        "fact_sales_weather": publish(
            fact, f"{prefix}fact_sales_weather", f"{lake}/gold",
            lambda df: quality.table_rules(df, [*gold.FACT_GRAIN, "total_revenue"], gold.FACT_GRAIN),
        ),
    }
    if exists(spark, f"{lake}/silver/current_state"):
        state = spark.read.parquet(f"{lake}/silver/current_state")
        known = state.select("city_id", "city_name") if cities is None else cities
        versions["current_weather"] = publish(
            gold.current_weather(state.drop("city_name"), known), f"{prefix}current_weather", f"{lake}/gold",
            lambda df: quality.table_rules(df, ["city_id", "condition"], ["city_id"]),
        )
    return versions


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    steps = parser.add_subparsers(dest="step", required=True)
    to_silver, to_gold = steps.add_parser("silver"), steps.add_parser("gold")
    to_silver.add_argument("--bronze", required=True)
    to_silver.add_argument("--format", default="avro")
    to_silver.add_argument("--max-files", type=int)
    to_silver.add_argument("--since", help="leave out what happened up to this time (UTC)")
    to_silver.add_argument("--deletes", action="store_true", help="apply delete events")
    for step in (to_silver, to_gold):
        step.add_argument("--lake", required=True)
    args = parser.parse_args()
    spark = build_session(f"rainledger-{args.step}")
    if args.step == "silver":
        left_out = silver_weather(spark, args.bronze, args.lake, max_files=args.max_files, since=args.since)
        late = silver_cdc(spark, args.bronze, args.lake, args.format, args.max_files, args.since, args.deletes)
        print(f"left out: {left_out}; late events: {late}")
    else:
        build_gold(spark, args.lake)


if __name__ == "__main__":
    main()
