import datetime as dt

import pytest
from builders import as_set
from pyspark.sql import functions as F

from orderflow.session import settings
from orderflow.sinks import batches
from orderflow.streaming import metrics as running
from orderflow.streaming import state
from orderflow.streaming.run import start

FIELDS = "ends timestamp, province string, orders bigint"


def land(spark, folder, *batch_rows):
    for rows in batch_rows:
        frame = spark.createDataFrame([(dt.datetime(2024, 1, day), province, n) for day, province, n in rows], FIELDS)
        frame.coalesce(1).write.mode("append").parquet(folder)


def run(spark, stream, out, checkpoint):
    with settings(spark, state.STATE_STORE):
        query = start(stream, running.folder_sink(out), f"{out}/{checkpoint}", "update", state_partitions=2)
        query.awaitTermination()
    return [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]


def read(spark, folder):
    return spark.readStream.schema(FIELDS).option("maxFilesPerTrigger", 1).parquet(folder)


def history(spark, out):
    return [
        (r.batch_id % batches.BATCHES_PER_RUN, r.ends.day, r.province, r.orders, r.closed)
        for r in batches.read_batches(spark, out).orderBy("batch_id", "ends", "province").collect()
    ]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Shanghai"])
def test_state_of_a_day_ends(spark, tmp_path, zone):
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    with settings(spark, {"spark.sql.session.timeZone": zone}):
        land(
            spark,
            landed,
            [(2, "a", 1), (2, "a", 2), (2, "b", 5), (3, "a", 1)],
            [(2, "a", 4), (5, "a", 1)],  # day 2 is still open
            [(3, "a", 7), (5, "b", 1)],  # days up to 3 close with this batch
            [(2, "a", 100), (3, "a", 100), (9, "a", 1)],  # too late
        )
        stream = state.closing_sums(read(spark, landed), ("ends", "province"), ("orders",), "ends", "2 days")
        progress = run(spark, stream, out, "checkpoint")
        rows = history(spark, out)
    opened = [r for r in rows if not r[4]]
    closed = [r[1:4] for r in rows if r[4]]
    assert (0, 2, "a", 3, False) in opened and (1, 2, "a", 7, False) in opened
    assert sorted(closed) == [(2, "a", 7), (2, "b", 5), (3, "a", 8), (5, "a", 1), (5, "b", 1)]
    assert not any(r[3] >= 100 for r in rows)
    # Keys that are held: their sum and their timer.
    held = [p["numRowsTotal"] for p in progress]
    assert max(held) > held[-1] and progress[-1]["numRowsRemoved"] > 0


def test_a_day_closes_once_and_only_with_its_sums(spark, tmp_path):
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, landed, *[[(day, "a", 1), (day, "b", 1), (day, "a", 1)] for day in range(1, 12)])
    stream = state.closing_sums(read(spark, landed), ("ends", "province"), ("orders",), "ends", "1 day")
    progress = run(spark, stream, out, "checkpoint")
    closed = [r[1:4] for r in history(spark, out) if r[4]]
    assert sorted(closed) == sorted([(d, "a", 2) for d in range(1, 11)] + [(d, "b", 1) for d in range(1, 11)])
    held = [p["numRowsTotal"] for p in progress]
    assert max(held[2:]) <= max(held[:3])  # days come and go, and what is held stays the same


def test_a_query_without_its_checkpoint_goes_on_from_earlier_totals(spark, tmp_path):
    first, second, out = str(tmp_path / "1"), str(tmp_path / "2"), str(tmp_path / "out")
    land(spark, first, [(1, "a", 3)], [(1, "a", 2), (1, "b", 1)])
    land(spark, second, [(1, "a", 2), (1, "c", 4)], [(1, "a", 1)])
    keys, measures = ("ends", "province"), ("orders",)
    run(spark, state.running_sums(read(spark, first), keys, measures), out, "first")
    totals = batches.newest_per_key(batches.read_batches(spark, out), *keys)
    assert as_set(totals.select("province", "orders")) == {("a", 5), ("b", 1)}
    run(spark, state.running_sums(read(spark, second), keys, measures, totals), out, "second")
    newest = batches.newest_per_key(batches.read_batches(spark, out), *keys)
    assert as_set(newest.select("province", "orders")) == {("a", 8), ("b", 1), ("c", 4)}
    # A restart has its state and doesn't take the totals again.
    land(spark, second, [(1, "a", 10)])
    run(spark, state.running_sums(read(spark, second), keys, measures, totals), out, "second")
    newest = batches.newest_per_key(batches.read_batches(spark, out), *keys)
    assert as_set(newest.select("province", "orders")) == {("a", 18), ("b", 1), ("c", 4)}


def test_running_sums_keep_null_keys_and_null_measures(spark, tmp_path):
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(dt.datetime(2024, 1, 1), None, 1), (dt.datetime(2024, 1, 1), None, None), (dt.datetime(2024, 1, 1), "a", None)]
    spark.createDataFrame(rows, FIELDS).coalesce(1).write.parquet(landed)
    stream = read(spark, landed).withColumn("orders", F.coalesce("orders", F.lit(0)))
    run(spark, state.running_sums(stream, ("ends", "province"), ("orders",)), out, "checkpoint")
    assert as_set(batches.read_batches(spark, out).select("province", "orders")) == {(None, 1), ("a", 0)}


def test_two_aggregations_with_two_checkpoints_add_up(spark, tmp_path):
    """Spark's own running aggregation begins from nothing; the view adds up the newest sums of all runs."""
    first, second, out = str(tmp_path / "1"), str(tmp_path / "2"), str(tmp_path / "out")
    land(spark, first, [(1, "a", 3)], [(1, "a", 2), (1, "b", 1)])
    land(spark, second, [(1, "a", 2)], [(1, "a", 1), (1, "c", 4)])
    for folder, checkpoint in ((first, "first"), (second, "second")):
        sums = read(spark, folder).groupBy("province").agg(F.sum("orders").alias("orders"))
        start(sums, running.folder_sink(out), f"{out}/{checkpoint}", "update", state_partitions=2).awaitTermination()
    view = batches.running_totals(batches.read_batches(spark, out), "province")
    assert as_set(view) == {("a", 8), ("b", 1), ("c", 4)}
