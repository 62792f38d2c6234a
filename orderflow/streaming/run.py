"""Start streaming queries with their checkpoint and state settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from orderflow.session import settings

OnBatch = Callable[[DataFrame, int], None]


def start(
    stream: DataFrame,
    on_batch: OnBatch,
    checkpoint: str,
    mode: str = "append",
    interval: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start a query that hands every micro-batch to ``on_batch``.

    With an ``interval`` the query runs on until stopped; without one it takes
    what is there now, in as many batches as the source's limits make of it.
    ``state_partitions`` is for state whose keys are bounded (weekdays, hours); it
    holds for the life of the checkpoint, and is the session's setting if left out.
    """
    spark = stream.sparkSession
    partitions = state_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(on_batch)
    )
    if interval:
        writer = writer.trigger(processingTime=interval)
    else:
        writer = writer.trigger(availableNow=True)
    # A query copies the session's settings when it starts.
    with settings(spark, {"spark.sql.shuffle.partitions": str(partitions)}):
        return writer.start()


def run_to_end(
    stream: DataFrame,
    on_batch: OnBatch,
    checkpoint: str,
    mode: str = "append",
    state_partitions: int | None = None,
) -> None:
    """Process all that is available and wait for it."""
    start(stream, on_batch, checkpoint, mode, state_partitions=state_partitions).awaitTermination()


def to_console(stream: DataFrame, mode: str = "update", rows: int = 20) -> StreamingQuery:
    """Print every batch, for looking at a stream while developing."""
    return (
        stream.writeStream.outputMode(mode)
        .format("console")
        .option("numRows", rows)
        .option("truncate", "false")
        .start()
    )
