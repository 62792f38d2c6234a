"""Running sums in state of their own: state that ends, and state that begins from earlier totals.

Increments are summed up within each task before they are shuffled, so a key that holds a third of a
batch is one row a task where it meets its state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: These operators need the state store that keeps state outside of the heap.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


def task_sums(increments: DataFrame, keys: tuple[str, ...], measures: tuple[str, ...]) -> DataFrame:
    """Increments summed by key within each Arrow batch of a task; stateless, so it stands before any state."""

    def summed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.groupby(list(keys), dropna=False, sort=False, as_index=False)[list(measures)].sum()

    rows = increments.select(*keys, *[F.col(m).cast("bigint").alias(m) for m in measures])
    return rows.mapInPandas(summed, rows.schema)


class _Sums(StatefulProcessor):
    """Sums of one key; a batch's touched keys give their new sums."""

    def __init__(self, keys: tuple[str, ...], measures: tuple[str, ...]):
        self.keys, self.measures = keys, measures

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", T.StructType([T.StructField(m, T.LongType()) for m in self.measures]))

    def add(self, rows: Iterator[pd.DataFrame]) -> tuple[int, ...]:
        total = list(self.sums.get() or (0,) * len(self.measures))
        for frame in rows:
            total = [old + int(frame[m].sum()) for old, m in zip(total, self.measures)]
        self.sums.update(tuple(total))
        return tuple(total)

    def row(self, key: tuple, total: tuple[int, ...], **more: object) -> pd.DataFrame:
        values = {**dict(zip(self.keys, key)), **dict(zip(self.measures, total)), **more}
        return pd.DataFrame({name: [value] for name, value in values.items()})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        yield self.row(key, self.add(rows))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.add(iter([initialState]))

    def close(self) -> None:
        pass


class _ClosingSums(_Sums):
    """Sums whose key goes when the watermark passes the last value of the key, milliseconds."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if not self.sums.exists():
            self.handle.registerTimer(int(key[-1]))
        yield self.row(key, self.add(rows), closed=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        total = tuple(self.sums.get())
        self.sums.clear()
        yield self.row(key, total, closed=True)


def running_sums(
    increments: DataFrame, keys: tuple[str, ...], measures: tuple[str, ...], totals: DataFrame | None = None
) -> DataFrame:
    """Stream of the keys that a batch touches with their sums so far (update mode).

    totals: what earlier queries have counted (``keys`` and ``measures``, a row for each key). A query without a checkpoint
    goes on from there; one that has a checkpoint has them already and leaves them aside.
    """
    schema = T.StructType([increments.schema[k] for k in keys] + [T.StructField(m, T.LongType()) for m in measures])
    seed = None
    if totals is not None:
        seed = totals.select(*keys, *[F.col(m).cast("bigint").alias(m) for m in measures]).groupBy(*keys)
    return (
        task_sums(increments, keys, measures)
        .groupBy(*keys)
        .transformWithStateInPandas(_Sums(keys, measures), schema, "Update", "None", initialState=seed)
    )


def closing_sums(increments: DataFrame, keys: tuple[str, ...], measures: tuple[str, ...], ends: str, delay: str) -> DataFrame:
    """Stream of touched keys with their sums, and of each key a last row, ``closed``, when its state goes.

    ends: the key column that holds the time at which a key ends (a timestamp). The watermark follows it, ``delay`` behind the latest:
    a key closes with the batch after the one that saw a key which ends ``delay`` later, and increments for it are
    dropped from the next batch on.
    """
    fields = [increments.schema[k] for k in keys] + [T.StructField(m, T.LongType()) for m in measures]
    schema = T.StructType([*fields, T.StructField("closed", T.BooleanType())])
    marked = increments.withColumn("_ends", F.unix_millis(ends))
    return (
        task_sums(marked, (*keys, "_ends"), measures)
        .withWatermark(ends, delay)
        .groupBy(*keys, "_ends")
        .transformWithStateInPandas(_ClosingSums(keys, measures), schema, "Update", "EventTime")
    )
