"""Data quality checks. Each returns counts of violations as rows; none collects."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from rainledger.operators.keys import as_list

FAR_FUTURE = "9999-12-31 00:00:00"


def observed(df: DataFrame, name: str, **metrics) -> tuple[DataFrame, Observation]:
    """Count rows (and more, if given) while another action runs, instead of a job of its own."""
    observation = Observation(name)
    extra = [column.alias(alias) for alias, column in metrics.items()]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *extra), observation


def _as_rows(counts: DataFrame, label: str) -> DataFrame:
    return counts.unpivot([], counts.columns, label, "violations")


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column_name, violations)`` per column, in one pass."""
    return _as_rows(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]), "column_name")


def check_unique(df: DataFrame, grain: list[str]) -> DataFrame:
    """One row: how many rows and groups there are, and how many groups hold more than one row."""
    groups = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("__n"))
    return groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint").alias("row_count"),
        F.count(F.lit(1)).alias("group_count"),
        F.count_if(F.col("__n") > 1).alias("violations"),
    )


def table_rules(df: DataFrame, not_null: list[str], grain: list[str]) -> DataFrame:
    """``(rule, violations)`` of the checks a Gold table has to pass."""
    nulls = check_not_null(df, not_null).select(F.concat(F.lit("null "), "column_name").alias("rule"), "violations")
    repeats = check_unique(df, grain).select(F.lit("repeated " + ", ".join(grain)).alias("rule"), "violations")
    return nulls.unionByName(repeats)


def check_scd2(dim: DataFrame, key: str | list[str], bucket: str = "hour") -> DataFrame:
    """``(rule, violations)`` for the invariants of a versioned dimension.

    several_open / no_open: keys with more than one or without an open version.
    overlap: versions that start before an earlier one ends.
    bad_interval: versions without a start, or that end before they start.

    The running maximum of ends works inside (key, time bucket) with one carried row
    per bucket, so a key with a long history is spread over many tasks.
    """
    keys = as_list(key)
    opens = dim.groupBy(*keys).agg(F.count_if("is_current").alias("__n"))
    per_key = opens.agg(
        F.count_if(F.col("__n") > 1).alias("several_open"), F.count_if(F.col("__n") == 0).alias("no_open")
    )

    bad = F.col("valid_from").isNull() | (F.col("valid_to") < F.col("valid_from"))
    versions = dim.select(
        *keys,
        "valid_from",
        F.coalesce("valid_to", F.lit(FAR_FUTURE).cast("timestamp")).alias("__end"),
        F.coalesce(bad, F.lit(False)).alias("__bad"),
        F.date_trunc(bucket, "valid_from").alias("__bucket"),
    )
    slot = [*keys, "__bucket"]
    earlier = Window.partitionBy(*slot).orderBy("valid_from", "__end").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    seen = versions.withColumn("__seen", F.max("__end").over(earlier))
    # from the same shuffle as the rows
    edges = (
        seen.groupBy(*slot)
        .agg(F.max(F.greatest("__end", "__seen")).alias("__last"))
        .withColumn("__carry", F.max("__last").over(before))
        .select(*slot, "__carry")
    )
    reached = F.greatest("__seen", "__carry")
    per_row = seen.join(edges, slot, "left").agg(
        F.count_if(reached > F.col("valid_from")).alias("overlap"), F.count_if("__bad").alias("bad_interval")
    )
    return _as_rows(per_key, "rule").unionByName(_as_rows(per_row, "rule"))
