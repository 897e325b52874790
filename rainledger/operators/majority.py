"""Majority vote and top-k per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rainledger.operators.keys import as_list


def majority(df: DataFrame, keys: str | list[str], value: str, alias: str = "majority") -> DataFrame:
    """The most frequent value per key, with its count as ``votes``.

    NULL counts as a value; ties go to the smallest, NULL last. Two map-side combined
    aggregates, so neither a hot key nor many distinct values gather in one task.
    """
    keys = as_list(keys)
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    first = F.min(F.struct((-F.col("__n")).alias("neg"), F.col(value).isNull().alias("missing"),
                           F.col(value).alias("value")))
    return counted.groupBy(*keys).agg(first.alias("__b")).select(
        *keys, F.col("__b.value").alias(alias), (-F.col("__b.neg")).alias("votes")
    )


def top_k(df: DataFrame, by: str | list[str], metric: str, k: int, tie: str | list[str]) -> DataFrame:
    """The ``k`` rows with the largest metric per group, numbered by ``rank``.

    Spark keeps only k rows per group and input task before the shuffle.
    """
    order = Window.partitionBy(*as_list(by)).orderBy(
        F.col(metric).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in as_list(tie)]
    )
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
