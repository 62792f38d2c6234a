"""Volume per province and time slot that accounts for late orders.

A batch's watermark is the latest start of an order in the batches before it, less the lateness. Orders of a slot
that ended by then are late: they are summed up beside the others, so that counted and late orders
are all orders. Results are increments of a batch, so there is no state to grow or to lose.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.sinks import batches
from orderflow.sinks.batches import Fold
from orderflow.streaming.run import run_to_end

FOLDS = {"volume": Fold("sum", ("slot_start", "province_code", "late")), "seen": Fold("newest")}


class LateVolume:
    """Writes a batch's volume to a result folder, the latest start next to it."""

    def __init__(self, spark: SparkSession, folder: str, length: str, lateness: dt.timedelta, deliveries: int = 1):
        self.folder, self.length, self.lateness, self.deliveries = folder, length, lateness, deliveries
        self._latest: dict[int, dt.datetime | None] | None = None
        self._spark = spark

    def _before(self, batch_id: int, run: str) -> dt.datetime | None:
        """Latest start in the batches before this one, whoever wrote them."""
        if self._latest is None:
            self._latest, state = {}, batches.published(self._spark, self.folder)
            if "seen" in state.results:
                seen = batches.read_batches(self._spark, self.folder, "seen")
                own = state.begun.get(run)
                place = F.col("batch_id") - (own * batches.BATCHES_PER_RUN if own is not None else 1 << 62)
                for row in seen.select(place.alias("place"), "latest").collect():
                    self._latest[row["place"]] = row["latest"]
        return max((x for k, x in self._latest.items() if k < batch_id and x is not None), default=None)

    def __call__(self, facts: DataFrame, batch_id: int) -> None:
        spark = facts.sparkSession
        before = self._before(batch_id, batches.current_run(spark))
        slot = F.window("start_ts", self.length)
        rolled = (
            facts.groupBy(slot.alias("slot"), "province_code")
            .agg(F.sum("orders").alias("orders"), F.sum("fee_all").alias("fee_total"), F.max("start_ts").alias("latest"))
            .persist()
        )
        late = F.lit(False) if before is None else F.col("slot.end") <= F.lit(before - self.lateness)
        seen = rolled.agg(F.max("latest").alias("latest"))
        volume = rolled.select(F.col("slot.start").alias("slot_start"), "province_code", late.alias("late"), "orders", "fee_total")
        try:
            for _ in range(self.deliveries):
                batches.publish({"volume": volume, "seen": seen}, self.folder, batch_id)
            self._latest[batch_id] = seen.first()["latest"]
        finally:
            rolled.unpersist()


def slot_volume(spark: SparkSession, folder: str) -> DataFrame:
    """``slot_start``, ``province_code``, and orders and money of the slot, in time and late."""
    late = F.col("late")
    sums = {"orders": ~late, "fee_total": ~late, "late_orders": late, "late_fee": late}
    source = {"late_orders": "orders", "late_fee": "fee_total"}
    zero = F.lit(0).cast("bigint")
    return (
        batches.read_batches(spark, folder, "volume")
        .groupBy("slot_start", "province_code")
        .agg(*[F.sum(F.when(kind, F.col(source.get(name, name))).otherwise(zero)).alias(name) for name, kind in sums.items()])
    )


def volume_with_late(
    facts: DataFrame, folder: str, length: str, lateness: dt.timedelta, deliveries: int = 1
) -> DataFrame:
    """Run over what the stream holds; returns the view of ``slot_volume``."""
    spark = facts.sparkSession
    sink = LateVolume(spark, folder, length, lateness, deliveries)
    run_to_end(facts, sink, f"{folder}/checkpoint")
    return slot_volume(spark, folder)
