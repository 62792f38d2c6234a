import json
import time

import pytest
from builders import as_set

from orderflow import schema as S
from orderflow.sources import positions
from orderflow.streaming.run import run_to_end, start


def rows(spark, topic, partition, first, last):
    found = [(str(k), f"text {k}", topic, partition, k) for k in range(first, last)]
    return spark.createDataFrame(found, S.MESSAGE_SCHEMA)


@pytest.fixture
def log(spark, tmp_path):
    folder = str(tmp_path / "log")
    positions.write_log(rows(spark, "t", 0, 0, 35).union(rows(spark, "t", 1, 5, 12)).union(rows(spark, "u", 0, 0, 3)), folder, 10)
    return folder


def read(stream, checkpoint):
    found = []
    run_to_end(stream, lambda batch, _: found.extend((r.topic, r.partition, r.offset) for r in batch.collect()), checkpoint)
    return sorted(found)


def expected(**ranges):
    return sorted((name[0], int(name[1]), k) for name, (low, high) in ranges.items() for k in range(low, high))


def test_a_log_is_read_whole_from_the_first_offsets(spark, log, tmp_path):
    assert read(positions.log_stream(spark, log), str(tmp_path / "c")) == expected(t0=(0, 35), t1=(5, 12), u0=(0, 3))
    assert positions.log_range(spark, log).schema == S.MESSAGE_SCHEMA
    whole = positions.log_range(spark, log)
    assert whole.count() == 45 and as_set(whole.filter("topic = 'u'").select("key", "value")) == {(str(k), f"text {k}") for k in range(3)}


def test_no_file_before_the_start_is_opened(spark, log, tmp_path):
    for partition, below in ((0, 20), (1, 10)):
        for segment in (tmp_path / "log" / "topic=t" / f"partition={partition}").iterdir():
            if int(segment.name.split("=")[1]) < below:
                for file in segment.glob("*.parquet"):
                    file.write_text("not a file that could be read")
    starting = json.dumps({"t": {"0": 23, "1": 10}})
    with pytest.raises(Exception):
        positions.log_range(spark, log, json.dumps({"t": {"0": 19, "1": 10}})).collect()
    assert read(positions.log_stream(spark, log, starting), str(tmp_path / "c")) == expected(t0=(23, 35), t1=(10, 12), u0=(0, 3))


def test_a_range_ends_where_it_is_told(spark, log):
    found = positions.log_range(spark, log, json.dumps({"t": {"0": 8, "1": 100}, "u": {"0": 3}}), json.dumps({"t": {"0": 21}}))
    assert sorted((r.topic, r.partition, r.offset) for r in found.collect()) == expected(t0=(8, 21))
    assert positions.log_range(spark, log, json.dumps({"t": {"0": 99, "1": 99}, "u": {"0": 99}})).count() == 0


def test_a_restart_goes_on_where_the_checkpoint_is(spark, log, tmp_path):
    starting, checkpoint = json.dumps({"t": {"0": 30, "1": 12}, "u": {"0": 3}}), str(tmp_path / "c")
    assert read(positions.log_stream(spark, log, starting), checkpoint) == expected(t0=(30, 35))
    positions.write_log(rows(spark, "t", 0, 35, 52).union(rows(spark, "v", 0, 0, 2)), log, 10)
    assert read(positions.log_stream(spark, log, starting), checkpoint) == expected(t0=(35, 52), v0=(0, 2))
    assert read(positions.log_stream(spark, log, starting), checkpoint) == []


def run_on(stream, checkpoint, count):
    """Run a query until it has so many messages; sizes and last offsets of its batches."""
    sizes, ends = [], {}

    def on_batch(batch, _):
        rows = batch.collect()
        sizes.append(len(rows))
        for r in rows:
            ends.setdefault(r.topic, {})[str(r.partition)] = max(r.offset + 1, ends.get(r.topic, {}).get(str(r.partition), 0))

    query = start(stream, on_batch, checkpoint, interval="0 seconds")
    until = time.time() + 60
    while sum(sizes) < count and time.time() < until and query.isActive:
        time.sleep(0.05)
    query.stop()
    return sizes, ends


def test_a_running_query_takes_a_limited_number_a_batch(spark, log, tmp_path):
    checkpoint = str(tmp_path / "c")
    sizes, ends = run_on(positions.log_stream(spark, log, limit=10), checkpoint, 45)
    assert sum(sizes) == 45 and len(sizes) >= 4 and max(sizes) <= 12
    assert ends == {"t": {"0": 35, "1": 12}, "u": {"0": 3}}
    positions.write_log(rows(spark, "t", 0, 35, 65), log, 10)
    again, _ = run_on(positions.log_stream(spark, log, limit=10), checkpoint, 30)
    assert again == [10, 10, 10]


def test_an_empty_folder_has_no_messages(spark, tmp_path):
    assert positions.log_range(spark, str(tmp_path / "none")).count() == 0
    assert read(positions.log_stream(spark, str(tmp_path / "none")), str(tmp_path / "c")) == []
