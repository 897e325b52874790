"""Shards by jump consistent hashing, and places without gaps inside each shard.

Only DataFrame functions. A shard depends on a row's key and the number of shards alone; with one
more shard, a row either stays or moves into the new one. The hash is the published one by Lamping
and Veach: a 64-bit linear congruential generator seeded with the key chooses the next jump, and
the last jump below the number of shards is the answer. ANSI mode forbids overflow, so the
generator multiplies in 16-bit parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rainledger.llm.common import free_name

_MULTIPLIER = 2862933555777941757
_M_HI, _M_LO = _MULTIPLIER >> 32, _MULTIPLIER & 0xFFFFFFFF
_LOW32 = 0xFFFFFFFF


def _times(x: Column, m: int) -> Column:
    """A number below 2^49 that equals ``x * m`` modulo 2^32, for both below 2^32."""
    upper = F.shiftright(x, 16) * F.lit(m)
    return upper.bitwiseAND(F.lit(0xFFFF)) * F.lit(1 << 16) + x.bitwiseAND(F.lit(0xFFFF)) * F.lit(m)


def jump_hash(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a 64-bit integer key. A null key counts as 0.

    Each step is one jump. A row needs about ln(shards) of them and never more than ``shards``,
    so that many are laid out and the rest leave the state as it is.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))

    def step(state: Column, _: Column) -> Column:
        hi, lo = state["hi"], state["lo"]
        lower = _times(lo, _M_LO) + F.lit(1)
        carry = F.shiftright(lower, 32) + F.shiftright(F.shiftright(lo, 16) * F.lit(_M_LO), 16)
        new_lo = lower.bitwiseAND(F.lit(_LOW32))
        new_hi = (carry + _times(hi, _M_LO) + _times(lo, _M_HI)).bitwiseAND(F.lit(_LOW32))
        ratio = F.lit(float(1 << 31)) / (F.shiftright(new_hi, 1) + F.lit(1)).cast("double")
        ahead = F.floor((state["next"] + F.lit(1)).cast("double") * ratio)
        jumped = F.struct(
            state["next"].alias("at"), ahead.cast("long").alias("next"), new_hi.alias("hi"), new_lo.alias("lo")
        )
        return F.when(state["next"] < F.lit(shards), jumped).otherwise(state)

    start = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.lit(0).cast("long").alias("next"),
        F.shiftrightunsigned(key, 32).alias("hi"),
        key.bitwiseAND(F.lit(_LOW32)).alias("lo"),
    )
    steps = F.sequence(F.lit(1), F.lit(shards))
    return F.aggregate(steps, start, step, lambda state: state["at"].cast("int"))


def numbered(df: DataFrame, group: str, order: list[str], name: str, buckets: int = 1024) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in an order that only the values decide.

    No task holds a group: rows are dealt to ``buckets`` buckets by a hash of ``order`` and
    numbered inside each; each bucket starts where the ones before it end. The counts
    have a row per group and bucket, however large the table is.
    """
    bucket, first = free_name(df, "bucket"), free_name(df, "first")
    dealt = df.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(group, bucket).agg(F.count(F.lit(1)).alias(first))
    starts = counts.withColumn(first, F.coalesce(F.sum(first).over(before), F.lit(0)))
    inside = Window.partitionBy(group, bucket).orderBy(*order)
    ranked = dealt.withColumn(name, F.row_number().over(inside).cast("long") - 1)
    joined = ranked.join(F.broadcast(starts), [group, bucket])  # a row per group and bucket
    return joined.withColumn(name, F.col(name) + F.col(first)).drop(bucket, first)


def shard_table(df: DataFrame, key: str, shards: int, order: list[str] | None = None, buckets: int = 1024) -> DataFrame:
    """``df`` with ``shard``, ``grown_shard`` (with one shard more) and ``slot`` (place in the shard).

    The key is an integer column; rows with a null key go together. Rows that are equal in
    ``order`` (all columns by default) may swap places. An empty table gives no rows. Columns of these three names are replaced.
    """
    df = df.drop("shard", "grown_shard", "slot")
    order = order or df.columns
    placed = df.withColumn("shard", jump_hash(F.col(key), shards)).withColumn(
        "grown_shard", jump_hash(F.col(key), shards + 1)
    )
    return numbered(placed, "shard", order, "slot", buckets)
