"""Tables: create, append, rebuild, publish, and replace only the partitions a change touches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from rainledger.schemas import struct
from rainledger.sources.paths import read_or_empty

# A partition column is a plain column name, or (new column, date_trunc unit, timestamp column), or
# (new column, number of hash parts, column).
PartitionBy = list[str | tuple[str, str | int, str]]


class Batch(NamedTuple):
    """One batch of one stream: the stream's own identity, which a new checkpoint changes, and the batch's number."""

    run: str
    number: int


MARK = struct(run="string", number="bigint")

ORDERS_PARTITIONS: PartitionBy = [("created_date", "day", "created_at")]
WEATHER_PARTITIONS: PartitionBy = ["source", ("fetched_date", "day", "fetched_at")]


def partition_names(partition_by: PartitionBy) -> list[str]:
    return [p if isinstance(p, str) else p[0] for p in partition_by]


def with_partitions(df: DataFrame, partition_by: PartitionBy) -> DataFrame:
    """Add the derived partition columns (first day of the unit, UTC, or part of the hash)."""
    derived = {p[0]: hash_part(p[2], p[1]) if isinstance(p[1], int) else F.to_date(F.date_trunc(p[1], p[2]))
               for p in partition_by if not isinstance(p, str)}
    return df.withColumns(derived) if derived else df


def hash_part(column: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(parts)).cast("int")


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: PartitionBy = ()) -> None:
    """Create the database and the Parquet table unless they are there."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    derived = [f"{p[0]} {'INT' if isinstance(p[1], int) else 'DATE'}" for p in partition_by if not isinstance(p, str)]
    columns = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in schema] + derived)
    partitioned = f" PARTITIONED BY ({', '.join(partition_names(partition_by))})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{partitioned}")


def append(df: DataFrame, name: str, partition_by: PartitionBy = ()) -> None:
    """Append rows, matched to the table by column name."""
    spark = df.sparkSession
    rows = with_partitions(df, partition_by).select(*spark.table(name).columns)
    if partition_by:
        rows = rows.hint("rebalance", *partition_names(partition_by))
    rows.write.insertInto(name)


def materialize(df: DataFrame, name: str) -> None:
    """Rebuild a table from a model."""
    df.write.mode("overwrite").saveAsTable(name)


def register_sources(spark: SparkSession, base: str, tables: list[str]) -> None:
    """Give the tables below ``base`` names that SQL models can use."""
    for table in tables:
        spark.read.parquet(f"{base}/{table}.parquet").createOrReplaceTempView(table)


class ChecksFailed(ValueError):
    """A new version broke its rules; readers still see the one before."""


def publish(df: DataFrame, name: str, base: str, checks: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Write a new full version, check it, then point the view at it.

    Readers see the old version or the new one, never a mixture, and a failed write or
    check changes nothing. ``checks`` takes the version as written and gives rows with a
    ``violations`` column.
    """
    version = f"{base}/{name.replace('.', '/')}/version={uuid.uuid4().hex}"
    df.write.parquet(version)
    if checks:
        broken = checks(df.sparkSession.read.schema(df.schema).parquet(version)).filter("violations > 0").collect()
        if broken:
            raise ChecksFailed(f"{name}: {'; '.join(str(r.asDict()) for r in broken)}")
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{version}`")
    return version


def staged(rows: DataFrame, staging: str, batch: Batch) -> DataFrame:
    """``rows`` as they were when this batch first came here, whatever has changed since.

    They are written to ``staging`` and marked complete with the stream's identity and the batch's number. A batch
    that is repeated after a loss finds its mark and what it wrote; any other batch, of this stream or of
    one that starts from a new checkpoint, is computed. One staging folder serves all
    batches of a stream in turn and belongs beside the stream's checkpoint.
    """
    spark = rows.sparkSession
    data, mark = f"{staging}/rows", f"{staging}/complete"
    marks = read_or_empty(spark, mark, MARK)
    if marks.filter((F.col("run") == batch.run) & (F.col("number") == batch.number)).isEmpty():
        rows.write.mode("overwrite").parquet(data)
        spark.range(1).select(*[F.lit(v).alias(n) for n, v in batch._asdict().items()]).coalesce(1).write.mode("overwrite").parquet(mark)
    return read_or_empty(spark, data, rows.schema).select(*rows.columns)


def replace_partitions(rows: DataFrame, path: str, partition_cols: list[str], staging: str, batch: Batch) -> None:
    """Replace exactly the partitions ``rows`` falls into; all others stay as they are.

    ``rows`` may be computed from the table itself: they are ``staged`` first, so a repeated batch
    only moves the same rows again and never computes from half-replaced partitions.
    """
    (
        staged(rows, staging, batch).hint("rebalance", *partition_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def touched_values(rows: DataFrame, column: str) -> list:
    """The distinct partition values of a batch: calendar months or days, never data keys."""
    return [row[0] for row in rows.select(column).distinct().collect()]


def in_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows of the given partitions, NULL included; literals prune folders at planning."""
    known = [v for v in values if v is not None]
    match = F.col(column).isin(known)
    return df.filter(match | F.col(column).isNull() if None in values else match)


def drop_partitions(spark: SparkSession, path: str, column: str, values: list) -> None:
    """Remove the folders of the given partitions, which no row is left for; one that is gone already is no error."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for value in values:
        folder = hadoop.Path(f"{path}/{column}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` kept for the jobs inside, and let go whatever happens to them; what the caller keeps already stays kept.

    Spark forgets what is kept once a job writes to a folder it was read from, so whatever needs it comes before that.
    """
    if df.storageLevel != StorageLevel.NONE:
        yield df
        return
    kept = df.persist()
    try:
        yield kept
    finally:
        kept.unpersist()
