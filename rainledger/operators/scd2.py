"""Slowly changing dimensions, type 2: batch apply, full history, invariants.

Validity is half open, ``[valid_from, valid_to)``; ``valid_to IS NULL`` marks the open version.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rainledger.functions.columns import differs
from rainledger.operators.keys import all_present, as_list
from rainledger.operators.merge import not_in

SCD2_COLS = ["valid_from", "valid_to", "is_current"]


def current(df: DataFrame, flag: str = "is_current") -> DataFrame:
    """The open versions."""
    return df.filter(F.col(flag))


def scd2_open(incoming: DataFrame, ts_col: str) -> DataFrame:
    """Incoming rows as open versions that start at their event time."""
    return incoming.withColumnsRenamed({ts_col: "valid_from"}).withColumns(
        {"valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)}
    )


def scd2_changes(
    open_rows: DataFrame,
    incoming: DataFrame,
    key: str | list[str],
    tracked: list[str],
    ts_col: str = "source_timestamp",
    strict_ref: bool = False,
) -> DataFrame:
    """What the open versions become: untouched, or closed plus a new open version.

    The open versions are streamed through a left join, so a small batch is broadcast and
    they are not shuffled; ``incoming`` holds a key at most once. A key without an open
    version is new. A changed key closes the open version at the
    event time. Events not later than the open version's start are ignored.

    ``strict_ref=True`` classifies by value instead of by match: a key counts as new
    when the open version's first tracked value is NULL, changes from or to NULL go
    unseen, and late events are applied.
    """
    keys = as_list(key)
    attrs = [c for c in open_rows.columns if c not in keys]
    # structs tell a missing side from a side full of NULLs
    old = open_rows.select(*keys, F.struct(*attrs).alias("__old"))
    starts = scd2_open(incoming, ts_col)
    joined = old.join(starts.select(*keys, F.struct(*attrs).alias("__new")), keys, "left")

    o, n = F.col("__old"), F.col("__new")
    pairs = [(n[c], o[c]) for c in tracked]
    if strict_ref:
        first = o[tracked[0]]
        not_equal = reduce(Column.__or__, [new != held for new, held in pairs])
        is_added = n.isNotNull() & first.isNull()
        is_changed = n.isNotNull() & first.isNotNull() & F.coalesce(not_equal, F.lit(False))
    else:
        is_added = F.lit(False)
        is_changed = n.isNotNull() & differs(pairs) & (n["valid_from"] > o["valid_from"])

    closed = o.withField("valid_to", n["valid_from"]).withField("is_current", F.lit(False))
    versions = (
        F.when(is_added, F.array(o, n)).when(is_changed, F.array(closed, n)).otherwise(F.array(o))
    )
    kept = joined.select(*keys, F.inline(versions)).select(*open_rows.columns)
    return kept.unionByName(not_in(starts, open_rows, keys).select(*open_rows.columns))


def scd2_apply(
    target: DataFrame,
    incoming: DataFrame,
    key: str | list[str],
    tracked: list[str],
    ts_col: str = "source_timestamp",
    strict_ref: bool = False,
) -> DataFrame:
    """The whole table after one batch: closed history passes through without a shuffle."""
    history = target.filter(~F.col("is_current"))
    changes = scd2_changes(current(target), incoming, key, tracked, ts_col, strict_ref)
    return history.unionByName(changes)


def scd2_close(target: DataFrame, deleted: DataFrame, key: str | list[str], ts_col: str) -> DataFrame:
    """End the open version of each deleted key at the time of its delete event."""
    keys = as_list(key)
    ends = deleted.select(*keys, F.col(ts_col).alias("__end"))
    ended = F.col("is_current") & (F.col("__end") > F.col("valid_from"))
    history = target.filter(~F.col("is_current"))
    open_rows = current(target).join(ends, keys, "left").withColumns(
        {
            "valid_to": F.when(ended, F.col("__end")).otherwise(F.col("valid_to")),
            "is_current": F.col("is_current") & ~F.coalesce(ended, F.lit(False)),
        }
    )
    return history.unionByName(open_rows.select(*target.columns))


def late_events(open_rows: DataFrame, incoming: DataFrame, key: str | list[str],
                ts_col: str = "source_timestamp") -> DataFrame:
    """Events :func:`scd2_changes` ignores because the open version starts at or after them."""
    keys = as_list(key)
    started = open_rows.select(*keys, F.col("valid_from").alias("__from"))
    return incoming.join(started, keys).filter(F.col(ts_col) <= F.col("__from")).drop("__from")


def scd2_deltas(
    held: DataFrame,
    incoming: DataFrame,
    key: str,
    tracked: list[str],
    ts_col: str = "source_timestamp",
    deletes: bool = False,
) -> DataFrame:
    """What each event does to the newest row of its key: ``begun``, ``ended`` (rows like ``held``, or NULL) and ``late``.

    ``held`` has a key's newest version, or the tombstone of its deletion: a row that is not current and ends where it
    starts. Both sides hold a key at most once. An event newer than that row begins a version if there
    is none, the key was deleted, or a tracked value differs, and ends the one that is open; with ``deletes``
    each event ends the open version and leaves a tombstone. Events that are not newer do nothing, so none brings a
    deleted key back; they are ``late`` unless they are the very event that began the row.
    """
    attrs = [c for c in held.columns if c != key]
    old = held.select(F.col(key).alias("__key"), F.struct(*held.columns).alias("__old"))
    begun = {ts_col: "valid_from"}
    starts = incoming.withColumnsRenamed(begun).withColumn("is_current", F.lit(not deletes))
    end = F.col("valid_from") if deletes else F.lit(None).cast("timestamp")
    starts = starts.withColumn("valid_to", end)
    if deletes:
        kept = [c for c in attrs if c not in SCD2_COLS]
        starts = starts.withColumns({c: F.lit(None).cast(held.schema[c].dataType) for c in kept})
    joined = starts.select(F.struct(*held.columns).alias("__new")).join(old, F.col(f"__new.{key}") == F.col("__key"), "left")

    o, n = F.col("__old"), F.col("__new")
    newer = o.isNull() | (n["valid_from"] > o["valid_from"])
    other = o.isNull() | (o["is_current"] if deletes else ~o["is_current"] | differs([(n[c], o[c]) for c in tracked]))
    begins = newer & other
    closed = o.withField("valid_to", n["valid_from"]).withField("is_current", F.lit(False))
    same = n["valid_from"].eqNullSafe(o["valid_from"]) & ~other
    return joined.select(
        F.when(begins, n).alias("begun"),
        F.when(begins & o.isNotNull() & o["is_current"], closed).alias("ended"),
        (o.isNotNull() & ~newer & ~same).alias("late"),
    )


def scd2_history(
    events: DataFrame,
    key: str | list[str],
    tracked: list[str],
    ts_col: str = "source_timestamp",
    tie_cols: tuple[str, ...] = (),
    bucket: str = "hour",
) -> DataFrame:
    """Every version of every key, from all events and whatever batches they came in.

    A key's history has no bound, so no task ever sorts all of it. Events are first
    reduced to one per (key, instant), which collapses copies before the shuffle.
    Comparing neighbours then happens inside (key, time bucket), and one summary row
    per (key, bucket) carries the values over the bucket's edges. ``bucket`` is any
    ``date_trunc`` unit; a finer one splits a hot key further.
    """
    keys = as_list(key)
    values = F.struct(*[F.col(c) for c in tracked])
    newest = F.max_by(values, F.struct(*[F.col(c) for c in tie_cols], values)) if tie_cols else F.max(values)
    instants = (
        events.filter(all_present([*keys, ts_col]))
        .groupBy(*keys, F.col(ts_col).cast("timestamp").alias("valid_from"))
        .agg(newest.alias("__v"))
        .withColumn("__bucket", F.date_trunc(bucket, "valid_from"))
        .filter(all_present(["__bucket"]))
    )
    slot = [*keys, "__bucket"]
    inside = Window.partitionBy(*slot).orderBy("valid_from")
    steps = instants.withColumn("__prev", F.lag("__v").over(inside)).withColumn(
        "__step", F.col("__prev").isNotNull() & ~F.col("__v").eqNullSafe(F.col("__prev"))
    )

    # one row per (key, bucket): its first and last values and its first inner change
    across = Window.partitionBy(*keys).orderBy("__bucket")
    later = Window.partitionBy(*keys).orderBy(F.desc("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        steps.groupBy(*slot)
        .agg(
            F.min("valid_from").alias("__head_at"),
            F.min_by("__v", "valid_from").alias("__head"),
            F.max_by("__v", "valid_from").alias("__last"),
            F.min(F.when(F.col("__step"), F.col("valid_from"))).alias("__inner"),
        )
        .withColumn("__carry", F.lag("__last").over(across))
        .withColumn("__head_step", F.col("__carry").isNull() | ~F.col("__head").eqNullSafe(F.col("__carry")))
        .withColumn("__first", F.when(F.col("__head_step"), F.col("__head_at")).otherwise(F.col("__inner")))
        .withColumn("__next_bucket", F.last("__first", ignorenulls=True).over(later))
        .select(*slot, "__head_step", "__next_bucket")
    )

    starts = steps.join(edges, slot).filter(
        F.col("__step") | (F.col("__prev").isNull() & F.col("__head_step"))
    )
    valid_to = F.coalesce(F.lead("valid_from").over(inside), F.col("__next_bucket"))
    return (
        starts.withColumn("valid_to", valid_to)
        .withColumn("is_current", F.col("valid_to").isNull())
        .select(*keys, "__v.*", *SCD2_COLS)
    )
