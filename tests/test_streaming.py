import datetime as dt

import pytest
from builders import as_set, dimension, message, records

from orderflow import schema as S
from orderflow.operators import leaders, lookup, metrics, prepare
from orderflow.sinks import batches
from orderflow.sources.messages import landed_messages
from orderflow.streaming import metrics as running
from orderflow.streaming.run import run_to_end, to_console

NAMES = {"1": "North", "2": "South"}


def order(province, hour, result="0000", fee=10, day="20240101"):
    return message(
        **{
            S.REQUEST_ID: f"{day}{hour:02d}000000000001",
            S.NOTIFY_TIME: ...,
            S.PROVINCE_CODE: province,
            S.RESULT: result,
            S.FEE: str(fee),
        }
    )


def land(spark, folder, *batch_texts):
    """One file per batch, in order of time."""
    for n, texts in enumerate(batch_texts):
        rows = records(spark, *[(text, "t", n, i) for i, text in enumerate(texts)])
        rows.coalesce(1).write.mode("append").parquet(folder)


def facts(spark, folder):
    orders = prepare.parse_orders(landed_messages(spark, folder, 1), S.NOTIFY_RULES)
    return metrics.order_facts(lookup.attach_province(orders, dimension(spark, NAMES), "inner"))


@pytest.fixture
def landed(spark, tmp_path):
    folder = str(tmp_path / "landed")
    land(
        spark,
        folder,
        [order("1", 0), order("1", 0, "1001"), order("2", 5)],
        [order("1", 0, "1001")],
        [order("2", 5), order("2", 6), order("9", 6), "nope"],
    )
    return folder


def by_batch(history):
    found = {}
    for row in history.collect():
        values = row.asDict()
        batch = values.pop("batch_id") % batches.BATCHES_PER_RUN
        found.setdefault(batch, set()).add(tuple(values.values()))
    return found


def test_update_batches_hold_touched_keys_only(spark, landed, tmp_path):
    stream = metrics.failures_weekday_hour_province(facts(spark, landed))
    history = running.touched_keys(spark, stream, str(tmp_path / "out"))
    assert by_batch(history) == {
        0: {(1, 0, "North", 1), (1, 5, "South", 0)},
        1: {(1, 0, "North", 2)},
        2: {(1, 5, "South", 0), (1, 6, "South", 0)},
    }


def test_snapshots_of_two_checkpoints_add_up(spark, tmp_path):
    out = str(tmp_path / "out")
    for n, texts in enumerate(([order("1", 0), order("1", 5)], [order("1", 0), order("2", 0)])):
        land(spark, str(tmp_path / f"in{n}"), texts[:1], texts[1:])
        hours = metrics.hourly_success_volume(facts(spark, str(tmp_path / f"in{n}")))
        run_to_end(hours, running.folder_sink(out), f"{out}/checkpoint{n}", "complete", 2)
    assert as_set(batches.counter_sums(batches.newest_snapshots(spark, out), "hour")) == {(0, 3, 30), (5, 1, 10)}


def test_complete_batches_hold_all_keys(spark, landed, tmp_path):
    stream = metrics.hourly_success_volume(facts(spark, landed))
    newest = running.all_keys(spark, stream, str(tmp_path / "out"))
    assert as_set(newest) == {(0, 1, 10), (5, 2, 20), (6, 1, 10)}
    assert by_batch(batches.read_batches(spark, str(tmp_path / "out"))) == {
        0: {(0, 1, 10), (5, 1, 10)},
        1: {(0, 1, 10), (5, 1, 10)},
        2: {(0, 1, 10), (5, 2, 20), (6, 1, 10)},
    }


def test_a_board_is_ranked_anew_in_every_batch(spark, landed, tmp_path):
    board = leaders.province_success_board(facts(spark, landed), k=1)
    running.all_keys(spark, board, str(tmp_path / "out"))
    assert by_batch(batches.read_batches(spark, str(tmp_path / "out"))) == {
        0: {("North", 1, 2, 0.5)},
        1: {("North", 1, 3, 0.333)},
        2: {("North", 1, 3, 0.333)},
    }


def test_increments_carry_no_state(spark, landed, tmp_path):
    history = running.increments(
        spark, facts(spark, landed), metrics.province_totals, str(tmp_path / "out"), deliveries=3
    )
    assert by_batch(history) == {
        0: {("North", 2, 1), ("South", 1, 1)},
        1: {("North", 1, 0)},
        2: {("South", 2, 2)},
    }
    assert as_set(batches.counter_sums(history, "province")) == {("North", 3, 1), ("South", 3, 3)}


def test_a_restart_keeps_the_state(spark, tmp_path):
    folder, out = str(tmp_path / "landed"), str(tmp_path / "out")
    land(spark, folder, [order("1", 0, "1001")])

    def once():
        stream = metrics.failures_weekday_hour_province(facts(spark, folder))
        return running.touched_keys(spark, stream, out)

    once()
    land(spark, folder, [order("1", 0, "1001"), order("1", 0, "1001")])
    assert by_batch(once()) == {0: {(1, 0, "North", 1)}, 1: {(1, 0, "North", 3)}}
    assert by_batch(once()) == {0: {(1, 0, "North", 1)}, 1: {(1, 0, "North", 3)}}


def test_windows_close_and_late_orders_are_left_out(spark, tmp_path):
    folder, out = str(tmp_path / "landed"), str(tmp_path / "out")
    land(
        spark,
        folder,
        [order("1", 0)],
        [order("1", 1), order("1", 0)],
        [order("1", 9)],
        [order("1", 8)],
        [order("1", 0), order("1", 8)],
    )
    volume = metrics.windowed_province_volume(facts(spark, folder), "1 hour", "2 hours")
    history = running.touched_keys(spark, volume, out)
    newest = batches.newest_per_key(history, "slot_start", "province")

    def at(hour):
        return dt.datetime(2024, 1, 1, hour)

    assert as_set(newest) == {
        (at(0), "North", 2, 20),
        (at(1), "North", 1, 10),
        (at(8), "North", 2, 20),
        (at(9), "North", 1, 10),
    }


def test_session_settings_are_put_back(spark, landed, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        run_to_end(
            landed_messages(spark, landed, 9),
            lambda rows, n: None,
            str(tmp_path / "c"),
            state_partitions=3,
        )
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_console(spark, landed, capfd):
    query = to_console(metrics.hourly_success_volume(facts(spark, landed)))
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None
