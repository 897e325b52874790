"""Append-only tables that are looked up by key, in hash parts whose number grows with the table.

Rows lie in ``depth=<d>/part=<k>``, where ``k`` is the key's hash modulo ``2 ** d``. A batch reads the parts its keys fall into
and writes its own rows, sorted by key, so what it writes follows the batch, whatever the table holds. When parts
would become too large, the table and the batch are written together with twice as many of them or more; as it has to double before that
happens again, all rewriting together is about as much as the table. Every part is a folder that has to be listed and a file
that each batch has to write, so their number stops at ``2 ** MAX_DEPTH`` and the parts themselves grow from there on. The new
depth counts once it stands in the directory, a small table of its own, so a lost rewrite changes nothing; the depth before is
kept for running readers until the next one.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger.operators.keys import null_safe_semi_join
from rainledger.operators.merge import not_in
from rainledger.schemas import struct
from rainledger.sources.paths import exists, read_or_empty
from rainledger.sources.tables import hash_part, in_values, persisted, touched_values

PART_ROWS = 2_000_000  # of a part, on average, before the table grows
MAX_DEPTH = 10  # more folders cost a batch more than they spare it: one of over 1,024 keys reads nearly all of them anyway
DIRECTORY = struct(depth="int")


class KeyedLog(NamedTuple):
    """A table of ``schema`` below ``path``, found by the column ``key``.

    ``compact`` cuts rows down to those that still count when the table is rewritten.
    """

    path: str
    key: str
    schema: T.StructType
    part_rows: int = PART_ROWS
    compact: Callable[[DataFrame], DataFrame] | None = None

    def depth(self, spark: SparkSession) -> int:
        """How many bits of the hash tell parts apart."""
        return read_or_empty(spark, f"{self.path}/_directory", DIRECTORY).agg(F.max("depth")).first()[0] or 0

    def _folder(self, depth: int) -> str:
        return f"{self.path}/depth={depth}"

    def _read(self, spark: SparkSession, depth: int) -> DataFrame:
        return read_or_empty(spark, self._folder(depth), T.StructType([*self.schema.fields, T.StructField("part", T.IntegerType())]))

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows, in the order of no column."""
        return self._read(spark, self.depth(spark)).select(*self.schema.names)

    def _parts(self, rows: DataFrame, depth: int) -> DataFrame:
        return rows.withColumn("part", hash_part(self.key, 1 << depth))

    def _touched(self, keys: DataFrame, depth: int) -> list[int]:
        return touched_values(self._parts(keys.select(self.key), depth), "part") if depth else [0]

    def candidates(self, keys: DataFrame) -> DataFrame:
        """The rows of the parts that the keys of ``keys`` fall into; no other folder is read."""
        depth = self.depth(keys.sparkSession)
        return in_values(self._read(keys.sparkSession, depth), "part", self._touched(keys, depth))

    def lookup(self, keys: DataFrame, null_safe: bool = True) -> DataFrame:
        """The rows whose key ``keys`` has; a NULL key finds NULL keys, unless ``null_safe`` is off, which spares shuffles
        as the rows then lie by the key itself."""
        candidates = self.candidates(keys)
        if not null_safe:
            return candidates.join(keys.select(self.key), self.key, "left_semi").select(*self.schema.names)
        return null_safe_semi_join(candidates, keys, [self.key]).select(*self.schema.names)

    def append(self, rows: DataFrame, unique: list[str]) -> None:
        """Add the rows whose ``unique`` columns, compared NULL-safely, no row has yet.

        A batch that is repeated finds what it added before, in whole or in part. ``unique`` holds the key, and
        ``rows`` has each of its values once.
        """
        spark = rows.sparkSession
        depth = self.depth(spark)
        if not exists(spark, self._folder(depth)):
            return self.add(rows)
        parts = self._touched(rows, depth)
        held = in_values(self._read(spark, depth), "part", parts)
        fresh = not_in(rows.select(*self.schema.names), held, unique, null_safe=True)
        if self._depth_with(rows.count(), spark, depth, parts) == depth:
            return self._write(fresh, depth, "append")
        with persisted(fresh) as kept:  # of a repeated batch fewer are fresh
            self._add(kept, depth, parts)

    def add(self, rows: DataFrame) -> None:
        """Add rows that the table is known not to hold.

        A table that holds nothing gets as many parts as the rows need at once, so they are written a single time.
        """
        spark = rows.sparkSession
        depth = self.depth(spark)
        if depth or exists(spark, self._folder(depth)):
            return self._add(rows.select(*self.schema.names), depth, self._touched(rows, depth))
        first = self._deeper(0, rows.count())
        if first:
            self._write(rows, first, "overwrite")
            self._begin(spark, first)
        else:
            self._write(rows, 0, "append")

    def _add(self, rows: DataFrame, depth: int, parts: list[int]) -> None:
        """Write ``rows`` beside the others, or all of them into more parts if those the batch touches would hold too many."""
        spark = rows.sparkSession
        deeper = self._depth_with(rows.count(), spark, depth, parts)
        if deeper == depth:
            return self._write(rows, depth, "append")
        every = self._read(spark, depth).select(*self.schema.names).unionByName(rows.select(*self.schema.names))
        self._write(self.compact(every) if self.compact else every, deeper, "overwrite")
        self._begin(spark, deeper)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        for old in range(depth):
            folder = hadoop.Path(self._folder(old))
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

    def _write(self, rows: DataFrame, depth: int, mode: str) -> None:
        (
            self._parts(rows.select(*self.schema.names), depth).hint("rebalance", "part").sortWithinPartitions("part", self.key)
            .write.mode(mode).partitionBy("part").parquet(self._folder(depth))
        )

    def _begin(self, spark: SparkSession, depth: int) -> None:
        """From here on the table is the folder of this depth."""
        spark.range(1).select(F.lit(depth).alias("depth")).coalesce(1).write.mode("append").parquet(f"{self.path}/_directory")

    def _deeper(self, depth: int, mean: float) -> int:
        """The depth at which parts that hold ``mean`` rows now hold ``part_rows`` at most, on average."""
        return depth if mean <= self.part_rows else min(MAX_DEPTH, depth + max(1, math.ceil(math.log2(mean / self.part_rows))))

    def _depth_with(self, more: int, spark: SparkSession, depth: int, parts: list[int]) -> int:
        """The depth for the table with so many more rows in ``parts``: the hash makes these speak for all."""
        if not parts or depth >= MAX_DEPTH:
            return depth
        held = in_values(self._read(spark, depth), "part", parts).count()  # out of the files' footers
        return self._deeper(depth, (held + more) / len(parts))
