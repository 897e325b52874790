"""Bronze weather payloads to one Silver schema.

Each provider's dialect is a JSON schema and the expressions that read it. The
schemas have no top-level field in common, so one ``from_json`` with their union
parses every row once, whatever its source, in a single pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger.functions.columns import code_to_condition, whole_number
from rainledger.functions.conditions import DEFAULT_CONDITION, KMH_PER_MS, TOMORROW_CONDITIONS, WMO_CONDITIONS
from rainledger.operators.quality import observed
from rainledger.schemas import struct

READINGS = ["temperature", "humidity", "pressure", "wind_speed", "condition"]


@dataclass(frozen=True)
class Dialect:
    """A provider's JSON schema and how its parsed form gives the READINGS.

    All numbers are read as doubles: a JSON ``65.0`` would be NULL in an int field.
    """

    schema: T.StructType
    readings: Callable[[Column], dict[str, Column]]


def _openweather(p: Column) -> dict[str, Column]:
    return {
        "temperature": p["main"]["temp"],
        "humidity": p["main"]["humidity"],
        "pressure": p["main"]["pressure"],
        "wind_speed": p["wind"]["speed"],
        "condition": F.get(p["weather"], F.lit(0))["main"],
    }


def _openmeteo(p: Column) -> dict[str, Column]:
    now = p["current"]
    return {
        "temperature": now["temperature_2m"],
        "humidity": now["relative_humidity_2m"],
        "pressure": now["surface_pressure"],
        "wind_speed": now["wind_speed_10m"] / F.lit(KMH_PER_MS),
        "condition": code_to_condition(whole_number(now["weather_code"]), WMO_CONDITIONS, DEFAULT_CONDITION),
    }


def _tomorrowio(p: Column) -> dict[str, Column]:
    now = p["data"]["values"]
    return {
        "temperature": now["temperature"],
        "humidity": now["humidity"],
        "pressure": now["pressureSurfaceLevel"],
        "wind_speed": now["windSpeed"],
        "condition": code_to_condition(whole_number(now["weatherCode"]), TOMORROW_CONDITIONS, DEFAULT_CONDITION),
    }


# Extension point: one entry per provider.
NORMALIZERS: dict[str, Dialect] = {
    "openweather": Dialect(
        struct(
            main=struct(temp="double", humidity="double", pressure="double"),
            wind=struct(speed="double"),
            weather=T.ArrayType(struct(main="string")),
        ),
        _openweather,
    ),
    "openmeteo": Dialect(
        struct(
            current=struct(
                temperature_2m="double", relative_humidity_2m="double", surface_pressure="double",
                wind_speed_10m="double", weather_code="double",
            )
        ),
        _openmeteo,
    ),
    "tomorrowio": Dialect(
        struct(
            data=struct(
                values=struct(
                    temperature="double", humidity="double", pressureSurfaceLevel="double", windSpeed="double",
                    weatherCode="double",
                )
            )
        ),
        _tomorrowio,
    ),
}


def union_schema(dialects: dict[str, Dialect]) -> T.StructType:
    """All dialects' fields in one schema; a name used with two types is an error."""
    fields: dict[str, T.StructField] = {}
    for name, dialect in dialects.items():
        for field in dialect.schema:
            if fields.setdefault(field.name, field) != field:
                raise ValueError(f"dialect {name!r} redefines the JSON field {field.name!r}")
    return T.StructType(list(fields.values()))


def _by_source(dialects: dict[str, Dialect], parsed: Column, reading: str) -> Column:
    result = None
    for name, dialect in dialects.items():
        value = dialect.readings(parsed)[reading]
        here = F.col("source") == name
        result = F.when(here, value) if result is None else result.when(here, value)
    return result


def silver_weather(
    bronze: DataFrame,
    run_ts: str | None = None,
    dialects: dict[str, Dialect] = NORMALIZERS,
) -> DataFrame:
    """Bronze envelopes of all known sources in the Silver schema; other sources are dropped.

    ``run_ts`` fixes the ingest stamp. Malformed JSON and timestamps give NULLs.
    """
    known = bronze.filter(F.col("source").isin(*dialects))
    parsed = known.withColumn("__p", F.from_json("raw_json", union_schema(dialects)))
    reading = {r: _by_source(dialects, F.col("__p"), r) for r in READINGS}
    stamp = F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp()
    return parsed.select(
        F.col("city_id").cast("int").alias("city_id"),
        "city_name",
        "source",
        F.try_to_timestamp("fetched_at").alias("fetched_at"),
        reading["temperature"].alias("temperature"),
        reading["humidity"].try_cast("int").alias("humidity"),
        reading["pressure"].alias("pressure"),
        reading["wind_speed"].alias("wind_speed"),
        reading["condition"].alias("condition"),
        stamp.alias("ingested_at"),
    )


def normalize(bronze: DataFrame, source: str, run_ts: str | None = None) -> DataFrame:
    """One provider's envelopes, parsed with its own schema only."""
    return silver_weather(bronze, run_ts, {source: NORMALIZERS[source]})


def counted_by_route(bronze: DataFrame, name: str):
    """The input with an observation that counts rows of unknown sources as ``unknown``."""
    return observed(bronze, name, unknown=F.count_if(~known_sources()))


def known_sources(dialects: dict[str, Dialect] = NORMALIZERS) -> Column:
    """True for rows of the sources that have a dialect; NULL is none of them."""
    return F.coalesce(F.col("source").isin(*dialects), F.lit(False))


def route_counts(bronze: DataFrame) -> DataFrame:
    """Rows per source, and whether they reach Silver."""
    return bronze.groupBy("source", known_sources().alias("is_known")).agg(F.count(F.lit(1)).alias("row_count"))
