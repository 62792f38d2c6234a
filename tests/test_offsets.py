import json

import pytest
from builders import as_set, message, records

from orderflow import schema as S
from orderflow.operators import offsets
from orderflow.sources import fixtures
from orderflow.sources.messages import as_text_messages, kafka_options


def saved(spark, *rows):
    return spark.createDataFrame(rows, "topic string, partition int, saved_offset bigint")


def earliest(spark, *rows):
    return spark.createDataFrame(rows, "topic string, partition int, earliest_offset bigint")


def test_ranges_per_partition(spark):
    text = message()
    batch = records(spark, (text, "t", 0, 5), (text, "t", 0, 7), (text, "t", 4, 1), ("x", "u", 0, 0))
    assert as_set(offsets.offset_ranges(batch)) == {
        ("t", 0, 5, 8),
        ("t", 4, 1, 2),
        ("u", 0, 0, 1),
    }


def test_last_save_by_partition_even_after_a_rewind(spark):
    ledger = spark.createDataFrame(
        [("g", "t", 0, 0, 5, 1), ("g", "t", 0, 5, 9, 2), ("g", "t", 3, 0, 2, 1), ("g", "u", 0, 0, 1, 1)]
        + [("g", "t", 4, 0, 500, 1), ("g", "t", 4, 0, 20, 2), ("other", "t", 0, 0, 99, 9)],
        S.LEDGER_SCHEMA,
    )
    assert as_set(offsets.saved_offsets(ledger, "g", "t")) == {("t", 0, 9), ("t", 3, 2), ("t", 4, 20)}
    assert as_set(offsets.saved_offsets(ledger, "g")) == {("t", 0, 9), ("t", 3, 2), ("t", 4, 20), ("u", 0, 1)}
    assert as_set(offsets.saved_offsets(ledger, "nobody")) == set()


def test_resume_is_clamped_to_what_the_log_holds(spark):
    plan = offsets.resume_plan(
        saved(spark, ("t", 0, 5), ("t", 1, 50), ("t", 2, 7)),
        earliest(spark, ("t", 0, 9), ("t", 1, 10), ("t", 8, 1)),
    )
    assert as_set(plan) == {("t", 0, 5, 9, 9), ("t", 1, 50, 10, 50), ("t", 2, 7, None, 7)}


def test_starting_offsets(spark):
    plan = offsets.resume_plan(
        saved(spark, ("t", 1, 4), ("t", 0, 5), ("u", 2, 1)), earliest(spark)
    )
    text = offsets.starting_offsets_json(plan)
    assert json.loads(text) == {"t": {"0": 5, "1": 4}, "u": {"2": 1}}
    options = kafka_options("h:9092", ["t", "u"], text, 1000)
    assert options["startingOffsets"] == text
    assert options["subscribe"] == "t,u"
    assert options["maxOffsetsPerTrigger"] == "1000"
    assert kafka_options("h:9092", ["t"])["startingOffsets"] == "earliest"
    assert kafka_options("h:9092", ["t"])["failOnDataLoss"] == "true"
    assert kafka_options("h:9092", ["t"], fail_on_data_loss=False)["failOnDataLoss"] == "false"


def test_broker_bytes_become_text(spark):
    raw = spark.createDataFrame(
        [(bytearray(b"k"), bytearray("{\"a\":\"\u5317\"}".encode()), "t", 0, 1)],
        "key binary, value binary, topic string, partition int, offset bigint",
    )
    assert as_set(as_text_messages(raw)) == {("k", '{"a":"\u5317"}', "t", 0, 1)}


@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_numbering_equals_brute_force(spark, block):
    import random

    rng = random.Random(3)
    ids = rng.sample(range(1000), 300)
    rows = [(i, "t" if rng.random() < 0.8 else "u", rng.choice([0, 0, 0, 5])) for i in ids]
    placed = spark.createDataFrame(rows, "event_id bigint, topic string, partition int")
    numbered = fixtures.with_offsets(placed, block).select(
        "event_id", "topic", "partition", "offset"
    )
    expected, seen = set(), {}
    for event_id, topic, partition in sorted(rows):
        place = (topic, partition)
        expected.add((event_id, *place, seen.get(place, 0)))
        seen[place] = seen.get(place, 0) + 1
    assert as_set(numbered) == expected


def test_every_partition_of_the_log_has_a_start(spark):
    """Saved, cut off by the log, never saved, gone from the log, and of a topic that isn't subscribed."""
    plan = offsets.resume_positions(
        saved(spark, ("t", 0, 5), ("t", 1, 50), ("t", 2, 7), ("u", 0, 3)),
        earliest(spark, ("t", 0, 9), ("t", 1, 10), ("t", 8, 1), ("u", 0, 0)),
        ["t"],
    )
    assert as_set(plan) == {
        ("t", 0, 5, 9, 9, "behind"),
        ("t", 1, 50, 10, 50, "saved"),
        ("t", 2, 7, None, None, "vanished"),
        ("t", 8, None, 1, 1, "new"),
    }
    assert json.loads(offsets.starting_offsets_json(plan)) == {"t": {"0": 9, "1": 50, "8": 1}}


def test_a_query_without_a_ledger_begins_at_the_earliest_offsets(spark):
    plan = offsets.resume_positions(saved(spark), earliest(spark, ("t", 0, 9)))
    assert as_set(plan) == {("t", 0, None, 9, 9, "new")}
    assert as_set(offsets.resume_positions(saved(spark), earliest(spark))) == set()
