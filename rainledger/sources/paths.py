"""Reading folders that may not exist yet."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options) -> DataFrame:
    """The folder's rows, or no rows with the same schema when there is no such folder."""
    try:
        return spark.read.format(fmt).schema(schema).options(**options).load(path)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return no_rows(spark, schema)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, known to be none at planning: joins with them are left out."""
    return spark.range(1).filter(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema("id bigint").parquet(path)
    except AnalysisException as error:
        if not _missing(error):
            raise
        return False
    return True
