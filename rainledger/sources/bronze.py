"""Raw weather payloads at rest: Parquet below ``source=/year=/month=/day=``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger.operators.latest import incremental
from rainledger.schemas import BRONZE_PARTITIONS, BRONZE_WEATHER
from rainledger.sources.paths import read_or_empty

ENVELOPE = BRONZE_WEATHER.fieldNames()
PARTITIONS = BRONZE_PARTITIONS.fieldNames()
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def bronze_envelope(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Wrap responses: a timestamp becomes an ISO string, a struct payload becomes JSON text."""
    raw = F.col(payload) if isinstance(df.schema[payload].dataType, T.StringType) else F.to_json(payload)
    fetched = df.schema["fetched_at"].dataType
    iso = F.col("fetched_at") if isinstance(fetched, T.StringType) else F.date_format("fetched_at", ISO_FORMAT)
    return df.select(
        F.col("city_id").cast("bigint").alias("city_id"),
        "city_name",
        "source",
        iso.alias("fetched_at"),
        raw.alias("raw_json"),
    )


def write_bronze_weather(envelopes: DataFrame, base: str) -> None:
    """Append envelopes to their source and day.

    The rebalance hint gathers each day's rows into few files and lets AQE split a
    source or day that holds much of the data.
    """
    at = F.try_to_timestamp("fetched_at")
    dated = envelopes.withColumns({"year": F.year(at), "month": F.date_format(at, "MM"), "day": F.date_format(at, "dd")})
    dated.hint("rebalance", *PARTITIONS).write.partitionBy(*PARTITIONS).mode("append").parquet(base)


def read_bronze_weather(spark: SparkSession, base: str, lo=None, hi=None) -> DataFrame:
    """Envelopes fetched in ``(lo, hi]``.

    The base folder is read, not its files, so the day folders stay partition columns;
    the bounds' dates prune them before any file is opened.
    """
    fields = [f for f in BRONZE_WEATHER if f.name != "source"] + list(BRONZE_PARTITIONS)
    raw = read_or_empty(spark, base, T.StructType(fields))
    day = F.make_date("year", "month", "day")
    if lo is not None:
        raw = raw.filter(day >= F.to_date(F.lit(lo).cast("timestamp")))
    if hi is not None:
        raw = raw.filter(day <= F.to_date(F.lit(hi).cast("timestamp")))
    if lo is None and hi is None:
        return raw.select(*ENVELOPE)
    timed = raw.withColumn("__at", F.try_to_timestamp("fetched_at"))
    return incremental(timed, "__at", lo, hi).select(*ENVELOPE)
