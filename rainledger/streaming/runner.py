"""Running streams to the end of their available input.

Every query uses ``availableNow``: it processes what has landed since its checkpoint
and stops, so the checkpoint takes the place of a hand-kept bookmark. Checkpoints,
staged writes and tables belong in the shared work folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from rainledger.session import configure
from rainledger.sources.tables import Batch

BatchFn = Callable[[DataFrame, Batch], None]


def drain_batches(stream: DataFrame, batch_fn: BatchFn, checkpoint: str) -> None:
    """Apply ``batch_fn(rows, batch)`` to each micro-batch.

    A batch may be delivered again after a failure; batch functions here are
    idempotent for equal ``batch``. The identity in it is the one Spark keeps in the
    checkpoint, so a stream that starts over is another one.

    Streams switch adaptive execution off in their own session; it is switched on again
    for the joins inside the batch.
    """

    def apply(rows: DataFrame, number: int) -> None:
        spark = configure(rows.sparkSession)
        run = spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
        batch_fn(rows, Batch(run, number))

    query = (
        stream.writeStream.foreachBatch(apply)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def drain_to_parquet(stream: DataFrame, path: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> int:
    """Append a stream's rows to Parquet; the file sink's log makes it exactly-once.

    Gives the number of rows that came too late for the stream's state and were dropped.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    states = [state for progress in query.recentProgress for state in progress.stateOperators]
    return sum(state.numRowsDroppedByWatermark for state in states)
