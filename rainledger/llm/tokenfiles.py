"""Token ids in Parquet files made for selective reads.

Documents are sorted by id over the whole table, so each file and each page holds a narrow range of
ids and the page indexes let a reader skip the rest. Ids of common tokens repeat, so the token
column is dictionary encoded; numbers that grow or change little are delta encoded. Row groups and
pages are small, and metadata columns can be read without a token.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rainledger.llm.common import chunks
from rainledger.llm.tokens import encoder

TEXT_BATCH = 1 << 20  # characters that are encoded at a time
FILE_SCHEMA = "doc_id bigint, shard int, shard_start bigint, n_tokens bigint, ids array<int>"
#: Dictionaries for the ids only; format version 2 delta-encodes the other integer columns.
WRITER = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.page.size": str(256 << 10),
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "1",
}


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int) -> DataFrame:
    """Documents in ascending order of id with their ids; ``shard`` counts the sorted partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).encode, np.array([end_id], "<u4").tobytes()
        shard, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in chunks([len(t) for t in texts], TEXT_BATCH):
                coded = [ids + end for ids in encode(texts[a:b])]
                ends = np.cumsum([0] + [len(c) // 4 for c in coded])
                values = pa.array(np.frombuffer(b"".join(coded), "<u4").astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(np.full(b - a, shard, np.int32)),
                        pa.array(start + ends[:-1]),
                        pa.array(np.diff(ends)),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values),
                    ],
                    names,
                )
                start += int(ends[-1])

    names = [c.split()[0] for c in FILE_SCHEMA.split(", ")]
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return ordered.mapInArrow(run, FILE_SCHEMA)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 0,
    row_group_bytes: int = 16 << 20,
) -> None:
    """Write ids of whole texts, each followed by ``end_id``, as sorted Parquet files below ``path``.

    A null text counts as empty and so leaves the end id alone. Documents with a null id come
    first; rows with equal ids stay apart, ordered by a hash of their texts. Other columns are
    not looked at. An empty table writes files without rows.
    """
    encoded = encode_documents(docs, tokenizer, id_col, text_col, end_id)
    options = WRITER | {"parquet.block.size": str(row_group_bytes)}
    encoded.write.options(**options).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, n_tokens, start, ids``. Spark reads ``ids`` only if they are asked for, and filters
    on ``doc_id`` skip row groups and pages. ``start`` counts the ids of all documents before."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    # a row per file
    sizes = files.groupBy("shard").agg(F.max(F.col("shard_start") + F.col("n_tokens")).alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    return files.join(F.broadcast(starts), "shard").select(
        "doc_id", "n_tokens", (F.col("before") + F.col("shard_start")).alias("start"), "ids"
    )


def with_crc32(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of what is stored: the length too is that of the read ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(2)
            values, cuts = ids.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes(), ids.offsets.to_numpy()
            spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([b - a for a, b in spans], pa.int64()),
                    pa.array([zlib.crc32(values[4 * a : 4 * b]) for a, b in spans], pa.int64()),
                ],
                ["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return tokens.select("doc_id", "start", "ids").mapInArrow(run, schema)
