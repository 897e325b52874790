"""What several operators need: scratch tables, free column names, words, Arrow columns."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rainledger.session import scratch

# A-Z to a-z; all other ASCII but digits and a-z to a space; bytes of other characters stay.
_ALNUM = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)


def alnum_words(text: bytes) -> list[bytes]:
    """Lower-cased runs of ASCII letters, ASCII digits and characters beyond ASCII."""
    return text.translate(_ALNUM).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Work that several later jobs need runs once, its lineage ends, and lost executors
    cost nothing that is stored. zstd halves what such tables take.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    for made in _collectors:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


_collectors: list[list[str]] = []


@contextmanager
def collected(made: list[str]) -> Iterator[None]:
    """Add the folders of all tables that are ``stored`` inside to ``made``, for ``discard``."""
    _collectors.append(made)
    try:
        yield
    finally:
        _collectors.remove(made)


def discard(spark: SparkSession, made: list[str]) -> None:
    """Delete tables that no result needs any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    while made:
        path = hadoop.Path(made.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores before it if ``df`` has such a column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes; null is empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def chunks(sizes: list[int], limit: int):
    """Ranges (start, end) of neighbours whose sizes add up to about ``limit``; a larger one stands alone."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as ``spark-submit --py-files`` would, once per session."""
    context = spark.sparkContext
    if any(name.endswith("/rainledger.zip") for name in context.listFiles):
        return
    package = Path(__file__).resolve().parent.parent
    into = Path(tempfile.mkdtemp(prefix="rainledger-ship-"))  # the driver's own; Spark serves the file
    context.addPyFile(shutil.make_archive(str(into / "rainledger"), "zip", package.parent, package.name))


def bitmap(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """``bits`` bits, of which bit ``value mod bits`` is set for every value of a long column.

    What it says of a value that is not there may be wrong, of one that is there never; its size does not
    depend on the data. Tasks make pieces of it, so no value reaches the driver.
    """
    at = F.pmod(F.col(column), F.lit(bits)) + 1
    pieces = values.groupBy(F.bitmap_bucket_number(at).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for r in pieces.collect():
        out[(r.piece - 1) * 4096 : r.piece * 4096] = np.frombuffer(r.bits, np.uint8)[: len(out)]
    return out


def in_bitmap(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which longs (or unsigned) the ``bitmap`` may hold; its number of bits is a power of two."""
    at = values.view(np.uint64) & np.uint64(len(bits) * 8 - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
