import datetime as dt

from builders import as_set

from orderflow.sinks import batches
from orderflow.streaming.late import FOLDS, LateVolume, slot_volume, volume_with_late

FIELDS = "start_ts timestamp, province_code string, orders bigint, fee_all bigint"
HOURS = dt.timedelta(hours=2)


def at(hour, minute=0, second=0):
    return dt.datetime(2024, 1, 1, hour, minute, second)


def land(spark, folder, *batch_rows):
    for rows in batch_rows:
        spark.createDataFrame([(t, "1", 1, 10) for t in rows], FIELDS).coalesce(1).write.mode("append").parquet(folder)


def read(spark, folder):
    return spark.readStream.schema(FIELDS).option("maxFilesPerTrigger", 1).parquet(folder)


def shown(view):
    return {(r.slot_start.hour, r.slot_start.minute, r.orders, r.late_orders, r.fee_total, r.late_fee) for r in view.collect()}


BATCHES = (
    [at(1), at(3, 30)],
    # The watermark is 1:30: a slot that ended then is late, one that ends a minute later isn't.
    [at(1, 0, 59), at(1, 29, 59), at(1, 30), at(0), at(9)],
    [at(9), at(6, 59), at(7)],
)
WANTED = {(0, 0, 0, 1, 0, 10), (1, 0, 1, 1, 10, 10), (1, 29, 0, 1, 0, 10), (1, 30, 1, 0, 10, 0), (3, 30, 1, 0, 10, 0),
          (6, 59, 0, 1, 0, 10), (7, 0, 1, 0, 10, 0), (9, 0, 2, 0, 20, 0)}


def test_counted_and_late_are_all(spark, tmp_path):
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, landed, *BATCHES)
    view = volume_with_late(read(spark, landed), out, "1 minute", HOURS, deliveries=2)
    assert shown(view) == WANTED
    assert sum(r[2] + r[3] for r in WANTED) == sum(map(len, BATCHES))
    assert batches.fold(spark, out, FOLDS)
    assert shown(slot_volume(spark, out)) == WANTED


def test_a_batch_delivered_again_after_a_restart_is_judged_alike(spark, tmp_path):
    out = str(tmp_path / "out")
    frames = [spark.createDataFrame([(t, "1", 1, 10) for t in rows], FIELDS) for rows in BATCHES]
    for n, frame in enumerate(frames):
        LateVolume(spark, out, "1 minute", HOURS)(frame, n)  # a new process for each batch
    LateVolume(spark, out, "1 minute", HOURS)(frames[1], 1)
    LateVolume(spark, out, "1 minute", HOURS)(frames[2], 2)
    assert shown(slot_volume(spark, out)) == WANTED


def test_empty_batches(spark, tmp_path):
    out = str(tmp_path / "out")
    sink = LateVolume(spark, out, "1 minute", HOURS)
    for n, rows in enumerate([[], [at(5)], [], [at(1)]]):
        sink(spark.createDataFrame([(t, "1", 1, 10) for t in rows], FIELDS), n)
    assert shown(slot_volume(spark, out)) == {(5, 0, 1, 0, 10, 0), (1, 0, 0, 1, 0, 10)}
    assert as_set(batches.read_batches(spark, out, "seen").filter("latest is null").select("latest")) == {(None,)}
