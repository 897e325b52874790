"""Small helpers for key lists and NULL-safe joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_list(key: str | list[str] | tuple[str, ...]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def null_safe_semi_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``left`` whose key is in ``right`` (or is not, by ``left_anti``); NULL keys match each other, as in grouping.

    Spark plans ``<=>`` as a hash or sort-merge join.
    """
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") for c in on])
    condition = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on])
    return left.join(renamed, condition, how)


def all_present(cols: list[str]) -> Column:
    """No column is NULL. Written out, so that Spark sees the same filter on both sides of a
    later join of the rows with their own summary and computes the shared part once."""
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in cols])
