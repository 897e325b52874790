"""Column expressions shared by the plans. All stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def datetime_struct_to_ts(col: Column) -> Column:
    """``struct<date: date, time: bigint>`` (micros since midnight, UTC) as a timestamp.

    Integer arithmetic throughout, so microseconds are exact; NULL if either field is.
    """
    return F.timestamp_micros(
        F.unix_date(col["date"]).cast("bigint") * F.lit(MICROS_PER_DAY) + col["time"]
    )


def ts_to_datetime_struct(col: Column) -> Column:
    """The inverse of :func:`datetime_struct_to_ts`."""
    ts = col.cast("timestamp")
    day = F.to_date(ts)
    micros = F.unix_micros(ts) - F.unix_date(day).cast("bigint") * F.lit(MICROS_PER_DAY)
    return F.struct(day.alias("date"), micros.alias("time"))


def code_to_condition(code: Column, names: dict[int, str], default: str = "Clouds") -> Column:
    """Look an integer weather code up in a fixed map; unknown and NULL give ``default``."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[code], F.lit(default))


def whole_number(value: Column) -> Column:
    """A JSON number as an int when it has no fraction, else NULL."""
    return F.when(value == F.floor(value), value.try_cast("int"))


def slug(col: Column) -> Column:
    """Lower case, spaces to underscores."""
    return F.replace(F.lower(col), F.lit(" "), F.lit("_"))


def money(col: Column) -> Column:
    """Exact two-digit decimal, so that sums do not depend on row order."""
    return col.cast("decimal(18,2)")


def money_sum(col: Column) -> Column:
    return F.sum(money(col)).cast("double")


def hour_of(ts: Column) -> Column:
    return F.date_trunc("hour", ts.cast("timestamp"))


def differs(pairs: list[tuple[Column, Column]]) -> Column:
    """True if any pair differs, with NULL equal to NULL only."""
    return reduce(Column.__or__, [~left.eqNullSafe(right) for left, right in pairs])
