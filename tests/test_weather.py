import json

import pytest
from pyspark.sql import functions as F

from rainledger.functions.conditions import TOMORROW_CONDITIONS, WMO_CONDITIONS
from rainledger.plans.weather import NORMALIZERS, Dialect, counted_by_route, normalize, silver_weather, union_schema
from rainledger.schemas import BRONZE_WEATHER, SILVER_WEATHER, struct
from tests.helpers import plan, rows, ts

AT = "2024-01-01T07:00:00+07:00"


def envelope(spark, *payloads, source="openweather", fetched_at=AT):
    texts = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
    return spark.createDataFrame([(1, "Hanoi", source, fetched_at, t) for t in texts], BRONZE_WEATHER)


def openmeteo(**fields):
    return {"current": fields}


def tomorrow(**fields):
    return {"data": {"values": fields}}


def test_openweather(spark):
    df = envelope(spark, {"main": {"temp": 25.5, "humidity": 65, "pressure": 1013}, "wind": {"speed": 3.5},
                          "weather": [{"main": "Rain"}, {"main": "Fog"}]})
    got = rows(silver_weather(df, "2024-02-01"), "city_id", "fetched_at", "temperature", "humidity", "pressure",
               "wind_speed", "condition", "ingested_at")
    assert got == [(1, ts("01 00:00"), 25.5, 65, 1013.0, 3.5, "Rain", ts("01 00:00").replace(month=2))]


def test_schema_is_silver(spark):
    df = silver_weather(envelope(spark, {}))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SILVER_WEATHER]


def test_missing_parts_are_null(spark):
    df = envelope(spark, "not json", "", {}, {"weather": []}, {"main": {"temp": "warm"}, "wind": {"speed": 1}})
    got = rows(silver_weather(df), "temperature", "humidity", "wind_speed", "condition")
    assert got == sorted([(None, None, None, None)] * 4 + [(None, None, 1.0, None)], key=repr)


def test_openmeteo_wind_and_codes(spark):
    df = envelope(spark, *[openmeteo(wind_speed_10m=36.0, weather_code=c) for c in (0, 45, 65.0, 65.5, 12345, None)],
                  source="openmeteo")
    assert rows(normalize(df, "openmeteo"), "wind_speed", "condition") == sorted(
        (10.0, c) for c in ("Clear", "Fog", "Rain", "Clouds", "Clouds", "Clouds"))


def test_humidity_with_fraction_is_truncated(spark):
    df = envelope(spark, tomorrow(humidity=65.9, weatherCode=4001), source="tomorrowio")
    assert rows(normalize(df, "tomorrowio"), "humidity", "condition") == [(65, "Rain")]
    df = envelope(spark, openmeteo(relative_humidity_2m=65.0), source="openmeteo")
    assert rows(silver_weather(df), "humidity") == [(65,)]


def test_code_tables(spark):
    assert (len(WMO_CONDITIONS), len(TOMORROW_CONDITIONS)) == (21, 16)
    df = envelope(spark, *[tomorrow(weatherCode=c) for c in TOMORROW_CONDITIONS], source="tomorrowio")
    assert rows(silver_weather(df), "condition") == sorted((c,) for c in TOMORROW_CONDITIONS.values())


@pytest.mark.parametrize("bad", ["yesterday", None])
def test_malformed_time_is_null(spark, bad):
    assert rows(silver_weather(envelope(spark, {}, fetched_at=bad)), "fetched_at") == [(None,)]


def test_unknown_sources_are_dropped_and_counted(spark):
    df = envelope(spark, {}).union(envelope(spark, {}, source="other")).union(envelope(spark, {}, source=None))
    counted, observation = counted_by_route(df, "route")
    assert silver_weather(counted).count() == 1
    assert observation.get == {"rows": 3, "unknown": 2}


def test_json_is_parsed_once_per_row(spark):
    text = plan(silver_weather(envelope(spark, {}).repartition(2)))
    assert text.count("from_json(") == 1


def test_new_dialect_and_clash(spark):
    extra = Dialect(struct(t="double"), lambda p: {
        "temperature": p["t"], "humidity": F.lit(None).cast("double"), "pressure": F.lit(None).cast("double"),
        "wind_speed": F.lit(None).cast("double"), "condition": F.lit("Clear")})
    df = envelope(spark, {"t": 3}, source="buoy")
    assert rows(silver_weather(df, dialects={**NORMALIZERS, "buoy": extra}), "temperature", "condition") == [(3.0, "Clear")]
    with pytest.raises(ValueError, match="main"):
        union_schema({**NORMALIZERS, "x": Dialect(struct(main="string"), lambda p: {})})
