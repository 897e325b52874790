"""Merges as plain joins: ``(target, source) -> new target``.

The target is streamed through a left join, so a small source is broadcast by
Spark's own size check and the target is not shuffled at all; a large source
becomes a sort-merge join on the key. Both sides hold a key at most once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rainledger.operators.keys import as_list, null_safe_semi_join


def not_in(source: DataFrame, target: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Source rows whose key the target does not hold.

    The target is first cut down to the source's keys, reading its key columns
    only, so that the side which the anti join shuffles is as small as the source.
    NULL keys never match, as in MERGE; ``null_safe`` lets them match each other, which
    appending needs so that a repeated batch finds all it appended before.
    """
    if null_safe:
        held = null_safe_semi_join(target.select(*keys), source, keys)
        return null_safe_semi_join(source, held, keys, "left_anti")
    held = target.select(*keys).join(source.select(*keys), keys, "left_semi")
    return source.join(held, keys, "left_anti")


def merge_insert_only(target: DataFrame, source: DataFrame, key: str | list[str]) -> DataFrame:
    """Insert unseen keys; rows already present never change."""
    keys = as_list(key)
    return target.unionByName(not_in(source, target, keys).select(*target.columns))


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    key: str | list[str],
    when_newer: str,
    update_cols: list[str],
) -> DataFrame:
    """Conditional upsert.

    Matched and ``source.when_newer > target.when_newer``: take ``update_cols`` from the
    source. Matched otherwise (older, equal or NULL): unchanged. Not matched: insert.
    """
    keys = as_list(key)
    changes = source.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in dict.fromkeys([*update_cols, when_newer])])
    newer = F.col(f"__s_{when_newer}") > F.col(when_newer)
    updated = target.join(changes, keys, "left").select(
        *[
            F.when(newer, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) if c in update_cols else F.col(c)
            for c in target.columns
        ]
    )
    return updated.unionByName(not_in(source, target, keys).select(*target.columns))


def merge_images(old: DataFrame, source: DataFrame, key: str | list[str], when_newer: str, update_cols: list[str]) -> DataFrame:
    """``merge_upsert`` of the source's own rows of the target: both are as small as the source, so they meet once."""
    keys = as_list(key)
    renamed = source.select(*[F.col(c).alias(f"__s_{c}") for c in old.columns], F.lit(True).alias("__s"))
    joined = old.withColumn("__o", F.lit(True)).join(renamed, reduce(Column.__and__, [F.col(k) == F.col(f"__s_{k}") for k in keys]), "full")
    inserted = F.col("__o").isNull()
    newer = inserted | (F.col(f"__s_{when_newer}") > F.col(when_newer))
    return joined.select(
        *[F.when(newer if c in update_cols else inserted, F.col(f"__s_{c}")).otherwise(F.col(c)).alias(c) for c in old.columns]
    )


def merge_delete(target: DataFrame, deleted: DataFrame, key: str | list[str]) -> DataFrame:
    """Remove the given keys."""
    keys = as_list(key)
    return target.join(deleted.select(*keys), keys, "left_anti")


def merge_into_catalog(
    source: DataFrame,
    table: str,
    key: str | list[str],
    when_newer: str | None = None,
    update_cols: list[str] = (),
) -> None:
    """The same merges on a table whose catalog supports MERGE (row-level operations).

    Without ``when_newer`` this is the insert-only merge.
    """
    keys = as_list(key)
    on = reduce(Column.__and__, [F.col(f"{table}.{c}") == F.col(f"s.{c}") for c in keys])
    merge = source.alias("s").mergeInto(table, on)
    if when_newer:
        newer = F.col(f"s.{when_newer}") > F.col(f"{table}.{when_newer}")
        merge = merge.whenMatched(newer).update({c: F.col(f"s.{c}") for c in update_cols})
    merge.whenNotMatched().insertAll().merge()
