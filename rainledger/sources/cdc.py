"""Change events landed as files, in batch and as a stream.

The format is a parameter: avro where the spark-avro package is deployed, parquet or
json otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rainledger.schemas import cdc_schema
from rainledger.sources.paths import read_or_empty


def _typed(df: DataFrame) -> DataFrame:
    """Accept source_timestamp as a long of microseconds too."""
    if isinstance(df.schema["source_timestamp"].dataType, T.LongType):
        return df.withColumn("source_timestamp", F.timestamp_micros("source_timestamp"))
    return df


def read_cdc(spark: SparkSession, path: str, table: str, fmt: str = "avro",
             schema: T.StructType | None = None) -> DataFrame:
    """All events below ``path``, at any depth; no rows if the folder is not there yet."""
    return _typed(read_or_empty(spark, path, schema or cdc_schema(table), fmt, recursiveFileLookup="true"))


def read_cdc_stream(spark: SparkSession, path: str, table: str, fmt: str = "avro",
                    schema: T.StructType | None = None, max_files: int | None = None) -> DataFrame:
    """The same as a stream: the checkpoint of the query that reads it is the bookmark."""
    reader = spark.readStream.format(fmt).schema(schema or cdc_schema(table)).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _typed(reader.load(path))
