"""Master data of the order database: active stores, customers, active products, active cities."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# table -> (columns, whether only active rows count)
MASTER_TABLES = {
    "stores": (["store_id", "city_id"], True),
    "customers": (["customer_id"], False),
    "products": (["product_id", "category", "price"], True),
    "cities": (["city_id", "city_name", "lat", "lon"], True),
}

Reader = Callable[[str], DataFrame]


def jdbc_reader(spark: SparkSession, url: str, partitioning: dict[str, dict[str, str]] | None = None,
                **options: str) -> Reader:
    """Read tables over JDBC. ``partitioning`` gives large tables their partitionColumn,
    lowerBound, upperBound and numPartitions, so that they load in parallel."""

    def read(table: str) -> DataFrame:
        extra = (partitioning or {}).get(table, {})
        return spark.read.format("jdbc").options(url=url, dbtable=table, **options, **extra).load()

    return read


def parquet_reader(spark: SparkSession, base: str) -> Reader:
    return lambda table: spark.read.parquet(f"{base}/{table}")


def active(df: DataFrame, flag: str = "is_active") -> DataFrame:
    """Rows flagged active; the comparison is pushed into the source."""
    return df.filter(F.col(flag) == 1)


def load_dims(reader: Reader) -> dict[str, DataFrame]:
    """The master tables, with only the columns and rows in use read from the source."""
    dims = {}
    for table, (columns, only_active) in MASTER_TABLES.items():
        rows = active(reader(table)) if only_active else reader(table)
        dims[table] = rows.select(*columns)
    return dims
