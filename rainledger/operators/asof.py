"""As-of joins of facts to the dimension version valid at their time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rainledger.operators.keys import all_present, as_list
from rainledger.operators.scd2 import SCD2_COLS

BLOCK = 256  # versions that are skipped or tried together


def attributes(dim: DataFrame, key: str | list[str]) -> list[str]:
    return [c for c in dim.columns if c not in (*as_list(key), *SCD2_COLS)]


def asof_scd2(
    left: DataFrame,
    dim: DataFrame,
    key: str | list[str],
    at: str,
    how: str = "inner",
    nested: bool = False,
) -> DataFrame:
    """``left`` with the attributes of every version valid at ``at``.

    ``how`` is inner, left, left_semi or left_anti. An equi join on the key whose residual
    condition is the validity range: a broadcast join without a shuffle when Spark finds
    the dimension small enough. Versions may overlap, and then a row matches each of
    them; intervals that are empty or negative match nothing.

    That compares each row with all versions of its key. For keys with long histories
    ``nested`` lays each version into units as long as itself (:func:`laid_out`), and a row
    meets those of the units it lies in only. The result is the same. Matches of a row are made
    where it meets the versions and are not shuffled, however many versions overlap.
    """
    keys = as_list(key)
    attrs = attributes(dim, keys)
    versions = dim.select(
        *[F.col(c).alias(f"__k_{c}") for c in keys],
        F.col("valid_from").cast("timestamp").alias("__from"),
        F.col("valid_to").cast("timestamp").alias("__to"),
        *attrs,
    )
    same_key = reduce(Column.__and__, [F.col(c) == F.col(f"__k_{c}") for c in keys])
    valid = (F.col(at) >= F.col("__from")) & (F.col("__to").isNull() | (F.col(at) < F.col("__to")))
    if not nested:
        joined = left.join(versions, same_key & valid, how)
    elif how == "inner":
        joined = _met(left, laid_out(versions), same_key & valid, at)
    else:
        of_key = [f"__k_{c}" for c in keys]
        # rows without a match must come back once: instants meet the time the versions cover, rows meet the instants
        instants = left.filter(all_present([*keys, at])).select(*keys, F.col(at).alias("__at")).distinct()
        valid_then = (F.col("__at") >= F.col("__from")) & (F.col("__to").isNull() | (F.col("__at") < F.col("__to")))
        covered = laid_out(merged(versions, of_key))
        found = _met(instants, covered, same_key & valid_then, "__at", "left_semi")
        found = found.withColumnsRenamed({c: f"__k_{c}" for c in keys})
        matched = same_key & (F.col(at) == F.col("__at"))
        if how == "left":
            # the matches may be very many, so none is shuffled: rows without one are found apart and added
            lost = left.join(found, matched, "left_anti")
            shares = open_shares(versions, of_key)
            units = laid_out(versions, shares)
            near = (F.col(at) >= F.col("__since")) & (F.col("__until").isNull() | (F.col(at) < F.col("__until")))
            blocks = _met(left, in_blocks(units, of_key), same_key & near, at, levels_of=versions, shares=shares)
            every = blocks.select(*left.columns, "__versions").unionByName(lost, allowMissingColumns=True)
            tried = every.select(*left.columns, F.inline_outer("__versions"))
            joined = tried.filter(F.col("__from").isNull() | valid)
        else:
            joined = left.join(found, matched, how)
    return joined.select(*left.columns, *([] if how in ("left_semi", "left_anti") else attrs))


def _node(micros: Column, level: Column) -> Column:
    """The unit of 16^level microseconds that holds an instant; level 0 is all of time."""
    return F.when(level == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftright", micros, 4 * level))


def _leveled(versions: DataFrame) -> DataFrame:
    """The versions that hold any time, with the lowest level whose units are no shorter than they as ``__level``."""
    length = F.try_subtract(F.unix_micros("__to"), F.unix_micros("__from"))  # NULL: open, or longer than a long can say
    digits = F.length(F.hex(length - 1))  # one hexadecimal digit a level
    level = F.when(length.isNull(), 0).otherwise(F.least(digits, F.lit(15)))
    kept = versions.filter(F.col("__from").isNotNull() & (F.col("__to").isNull() | (F.col("__to") > F.col("__from"))))
    return kept.withColumn("__level", level)


def laid_out(versions: DataFrame, shares: Column | None = None) -> DataFrame:
    """Each version (``__from``, ``__to``) with the units it lies in, as ``__level`` and ``__node``.

    Units of a level are 16 times as long as those below. A version goes to the lowest level
    whose units are no shorter than itself, so it touches two of them at most, however long it is,
    and a unit holds a key's versions of its own scale only: 17 if none overlap. Open
    versions share level 0; empty and negative ones are in no unit. With ``shares`` level 0 has so many
    units, an open version lies in each of them and a row in one.
    """
    first = F.unix_micros("__from")
    last = F.coalesce(F.unix_micros("__to") - 1, first)
    nodes = F.sequence(_node(first, F.col("__level")), _node(last, F.col("__level")))
    if shares is not None:
        nodes = F.when(F.col("__level") == 0, F.sequence(F.lit(0).cast("long"), shares - 1)).otherwise(nodes)
    return _leveled(versions).withColumn("__node", F.explode(nodes))


def open_shares(versions: DataFrame, keys: list[str]) -> Column:
    """How many units level 0 needs: one for each ``BLOCK`` open versions that a key has on average, 16 at most.

    No time cuts these versions, so all rows of a key would meet them in one task.
    """
    per_key = _leveled(versions).filter("__level = 0").groupBy(*keys).count()
    mean = F.coalesce(F.avg("count"), F.lit(0))
    return per_key.agg(F.greatest(F.least(F.ceil(mean / BLOCK), F.lit(16)), F.lit(1)).cast("long")).scalar()


def merged(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Versions that cover the same time of each key, but few where very many overlap.

    A version is longer than the units a level below its own, so those that begin in the same
    one of these all hold the end of it (on level 0: all times to come, or the epoch) and together are one
    version. So a key has one of them at most per level and such unit.
    """
    level, micros = F.col("__level"), F.unix_micros("__from")
    begun = F.when(level == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftright", micros, 4 * (level - 1)))
    groups = _leveled(versions).groupBy(*keys, "__level", begun, F.col("__to").isNull())
    return groups.agg(F.min("__from").alias("__from"), F.max("__to").alias("__to")).select(*keys, "__from", "__to")


def _met(rows: DataFrame, units: DataFrame, condition: Column, at: str, how: str = "inner",
         levels_of: DataFrame | None = None, shares: Column | None = None) -> DataFrame:
    """Each row with each version that meets ``condition`` in one of the units the row's time lies in.

    A row is tried on the levels that hold any version, sixteen at most; finding them is a subquery
    over the versions, so nothing runs before the join does. A version that holds the row's time is
    in exactly one of the units tried, so no pair comes twice. With ``how`` left_semi a row comes back
    once per level that holds such a version.
    """
    levels = (units if levels_of is None else _leveled(levels_of)).agg(F.collect_set("__level")).scalar()
    node = _node(F.unix_micros(F.col(at).cast("timestamp")), F.col("__tried"))
    if shares is not None:
        node = F.when(F.col("__tried") == 0, F.pmod(F.xxhash64(at), shares)).otherwise(node)
    tried = rows.withColumn("__tried", F.explode(levels)).withColumn("__in", node)
    same_unit = (F.col("__tried") == F.col("__level")) & (F.col("__in") == F.col("__node"))
    return tried.join(units, condition & same_unit, how).drop("__tried", "__in", "__level", "__node")


def in_blocks(units: DataFrame, keys: list[str]) -> DataFrame:
    """Laid out versions in rows of up to ``BLOCK`` that begin one after the other in a unit, as ``__versions``.

    A row that is not in ``[__since, __until)`` matches none of them, so it need not try each.
    """
    unit = [*keys, "__level", "__node"]
    place = F.row_number().over(Window.partitionBy(*unit).orderBy("__from")) - 1
    numbered = units.withColumn("__block", F.floor(place / BLOCK))
    return numbered.groupBy(*unit, "__block").agg(
        F.min("__from").alias("__since"),
        F.when(F.count("__to") == F.count(F.lit(1)), F.max("__to")).alias("__until"),
        F.collect_list(F.struct(*[c for c in units.columns if c not in unit])).alias("__versions"),
    )


def unmatched(left: DataFrame, dim: DataFrame, key: str | list[str], at: str,
              nested: bool = False) -> DataFrame:
    """Rows an inner as-of join loses: no version of their key is valid at their time."""
    return asof_scd2(left, dim, key, at, "left_anti", nested)
