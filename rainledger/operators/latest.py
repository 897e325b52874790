"""Keep-latest deduplication, incremental bounds and delete handling for change events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger.operators.keys import as_list, null_safe_semi_join


def incremental(df: DataFrame, ts_col: str, lo=None, hi=None) -> DataFrame:
    """Rows with ``lo < ts <= hi``; either bound may be left out.

    The bounds take the column's own type (with or without time zone), so the
    comparison reaches the Parquet reader as a pushed filter.
    """
    ts = F.col(ts_col)
    ts_type = df.select(ts).schema[0].dataType
    if lo is not None:
        df = df.filter(ts > F.lit(lo).cast(ts_type))
    if hi is not None:
        df = df.filter(ts <= F.lit(hi).cast(ts_type))
    return df


def drop_deletes(df: DataFrame, col: str = "source_metadata.change_type", op: str = "DELETE") -> DataFrame:
    """Drop delete events; rows with a NULL change type go too."""
    return df.filter(F.col(col) != op)


def _orderable(field: T.StructField) -> bool:
    return not isinstance(field.dataType, (T.MapType, T.VariantType))


def keep_latest(
    df: DataFrame,
    key: str | list[str],
    ts_col: str,
    tie_cols: tuple[str, ...] = (),
    ties: str = "one",
) -> DataFrame:
    """The newest row of each key.

    ``ties="one"`` keeps one row, decided by ``tie_cols`` and then by all other
    columns, so a retried task picks the same one. Spark limits each key to its
    first row before the shuffle (WindowGroupLimit), so a hot key sends at most
    one row per input task.

    ``ties="all"`` keeps every row that shares the newest timestamp. That group has
    no bound, so it is found by a map-side combined ``max`` and a semi join on key and
    time, which AQE can split, and never collected into one window.
    """
    keys = as_list(key)
    if ties == "all":
        newest = df.groupBy(*keys).agg(F.max(ts_col).alias(ts_col))
        return null_safe_semi_join(df, newest, [*keys, ts_col])
    used = {*keys, ts_col, *tie_cols}
    rest = [f.name for f in df.schema if f.name not in used and _orderable(f)]
    order = [F.col(c).desc_nulls_last() for c in (ts_col, *tie_cols, *rest)]
    newest_first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(newest_first)).filter("__rn = 1").drop("__rn")


def latest_state(df: DataFrame, key: str | list[str], ts_col: str, cols: list[str]) -> DataFrame:
    """The newest values per key as one map-side combined aggregate (also valid on streams).

    Equal timestamps are decided by the values themselves, largest first.
    """
    keys = as_list(key)
    newest = F.max(F.struct(F.col(ts_col), *[F.col(c) for c in cols])).alias("__state")
    return df.filter(F.col(ts_col).isNotNull()).groupBy(*keys).agg(newest).select(*keys, "__state.*")


def deleted_keys(df: DataFrame, key: str | list[str], ts_col: str, op_col: str = "change_type",
                 op: str = "DELETE") -> DataFrame:
    """Keys whose newest event is a delete, with the time of it."""
    last = latest_state(df, key, ts_col, [op_col])
    return last.filter(F.col(op_col) == op).select(*as_list(key), ts_col)
