"""Running metrics over a stream of orders, each kept in a result folder.

Every function starts a query over typed facts, runs it over what the source
holds, and returns the view of its result folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderflow.sinks import batches
from orderflow.streaming.run import run_to_end

Sink = Callable[[DataFrame, int], None]


def folder_sink(folder: str, deliveries: int = 1) -> Sink:
    """Publish each batch to ``folder``; more deliveries act out a replay.

    Rows are dealt anew by size before they are written: the partitions of a state store would leave a tiny file
    each. A batch that is delivered several times is computed once.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        even = rows.hint("rebalance")
        if deliveries > 1:
            even = even.persist()
        try:
            for _ in range(deliveries):
                batches.write_batch(even, folder, batch_id)
        finally:
            if deliveries > 1:
                even.unpersist()

    return write


def touched_keys(
    spark: SparkSession,
    running: DataFrame,
    folder: str,
    state_partitions: int | None = None,
    deliveries: int = 1,
) -> DataFrame:
    """Running sums whose batches hold only the keys that changed.

    Returns the history: every row a batch has written. A query that lost its checkpoint begins from nothing, and
    ``batches.running_totals`` adds up the newest sums of all runs.
    """
    run_to_end(
        running, folder_sink(folder, deliveries), f"{folder}/checkpoint", "update", state_partitions
    )
    return batches.read_batches(spark, folder)


def all_keys(
    spark: SparkSession, running: DataFrame, folder: str, state_partitions: int | None = None, keys: tuple[str, ...] = ()
) -> DataFrame:
    """Running sums of bounded keys whose batches hold every key. Returns the last batch.

    With ``keys``, the last batches of all runs are added up: a query that lost its checkpoint begins from nothing.
    """
    run_to_end(running, folder_sink(folder), f"{folder}/checkpoint", "complete", state_partitions)
    if keys:
        return batches.counter_sums(batches.newest_snapshots(spark, folder), *keys)
    return batches.newest_snapshot(spark, folder)


def increments(
    spark: SparkSession,
    stream: DataFrame,
    per_batch: Callable[[DataFrame], DataFrame],
    folder: str,
    deliveries: int = 1,
) -> DataFrame:
    """What each batch adds on its own, with no state. Returns the history."""
    write = folder_sink(folder, deliveries)
    run_to_end(stream, lambda rows, n: write(per_batch(rows), n), f"{folder}/checkpoint")
    return batches.read_batches(spark, folder)
