import datetime as dt

import pytest
from builders import as_set, message, messages

from orderflow import schema as S
from orderflow.operators import prepare


def reasons(spark, rules, *texts):
    rows = prepare.rejected_messages(messages(spark, *texts), rules).collect()
    return {int(row["key"]): row["reason"] for row in rows}


def test_a_good_message_becomes_an_order(spark):
    (order,) = prepare.parse_orders(messages(spark, message()), S.NOTIFY_RULES).collect()
    assert order["is_success"] is True
    assert order["fee"] == 500
    assert order["start_ts"] == dt.datetime(2024, 1, 1, 0, 9, 58, 778000)
    assert order["duration_ms"] == 1222
    assert order["province_code"] == "100"
    assert order["day"] == dt.date(2024, 1, 1)


def test_schema_is_the_published_one(spark):
    orders = prepare.parse_orders(messages(spark, message()), S.ALL_ORDERS_RULES)
    assert [(f.name, f.dataType) for f in orders.schema] == [
        (f.name, f.dataType) for f in S.ORDER_SCHEMA
    ]


@pytest.mark.parametrize(
    ("changes", "reason"),
    [
        ({S.FEE: "12x"}, "bad_fee"),
        ({S.FEE: " 12"}, "bad_fee"),
        ({S.FEE: "12.5"}, "bad_fee"),
        ({S.FEE: "2147483648"}, "bad_fee"),
        ({S.FEE: ...}, "missing_field"),
        ({S.REQUEST_ID: "2024010100095877"}, "bad_start_time"),
        ({S.REQUEST_ID: "2024023100095877800000012"}, "bad_start_time"),
        ({S.REQUEST_ID: "20240101000958x7800000012"}, "bad_start_time"),
        ({S.REQUEST_ID: ...}, "missing_field"),
        ({S.REQUEST_ID: None}, "missing_field"),
        ({S.PROVINCE_CODE: ...}, "missing_field"),
        ({S.RESULT: ...}, "missing_field"),
        ({S.NOTIFY_TIME: ""}, "bad_end_time"),
        ({S.NOTIFY_TIME: "2024010100100000"}, "bad_end_time"),
        ({S.NOTIFY_TIME: "202401010010000001"}, "bad_end_time"),
        ({S.NOTIFY_TIME: ...}, None),
        ({S.NOTIFY_TIME: None}, None),
        ({S.FEE: 500, S.PROVINCE_CODE: 100}, None),
        ({S.FEE: "-3"}, None),
    ],
)
def test_reject_reasons(spark, changes, reason):
    expected = {} if reason is None else {0: reason}
    assert reasons(spark, S.ALL_ORDERS_RULES, message(**changes)) == expected


@pytest.mark.parametrize("text", ["nope", "", "{}", "[1]", "null", message()[:60]])
def test_unreadable_texts(spark, text):
    assert reasons(spark, S.ALL_ORDERS_RULES, text) == {0: "unreadable"}


def test_a_null_text_is_rejected(spark):
    assert reasons(spark, S.ALL_ORDERS_RULES, None) == {0: "unreadable"}


def test_rejected_messages_come_back_whole(spark):
    text = message(**{S.FEE: "12x", "note": "x" * 5000})
    (row,) = prepare.rejected_messages(messages(spark, text), S.NOTIFY_RULES).collect()
    assert row["value"] == text


def test_every_message_is_either_accepted_or_rejected(spark):
    texts = [message(), message(**{S.FEE: "x"}), "nope", message(**{S.NOTIFY_TIME: "x"}), "{}"]
    batch = messages(spark, *texts)
    good = prepare.parse_orders(batch, S.ALL_ORDERS_RULES).count()
    bad = prepare.rejected_messages(batch, S.ALL_ORDERS_RULES).count()
    assert (good, bad) == (1, 4)


def test_missing_end_time_means_no_duration(spark):
    batch = messages(spark, message(**{S.NOTIFY_TIME: ...}), message(**{S.NOTIFY_TIME: None}))
    orders = prepare.parse_orders(batch, S.NOTIFY_RULES).collect()
    assert [o["duration_ms"] for o in orders] == [0, 0]
    assert all(o["end_ts"] == o["start_ts"] for o in orders)


def test_end_before_start_gives_a_negative_duration(spark):
    batch = messages(spark, message(**{S.NOTIFY_TIME: "20240101000957778"}))
    assert prepare.parse_orders(batch, S.NOTIFY_RULES).first()["duration_ms"] == -1000


def test_blanks_are_trimmed_only_for_all_orders(spark):
    batch = messages(spark, message(**{S.RESULT: " 0000 "}))
    assert prepare.parse_orders(batch, S.ALL_ORDERS_RULES).first()["is_success"] is True
    assert prepare.parse_orders(batch, S.NOTIFY_RULES).first()["is_success"] is False
    padded = message(**{S.NOTIFY_TIME: " 20240101001000000 "})
    assert reasons(spark, S.ALL_ORDERS_RULES, padded) == {}
    assert reasons(spark, S.NOTIFY_RULES, padded) == {0: "bad_end_time"}


def test_the_notify_rules_keep_one_service(spark):
    batch = messages(
        spark, message(), message(**{S.SERVICE: "reChargeReq"}), message(**{S.SERVICE: ...})
    )
    assert prepare.parse_orders(batch, S.NOTIFY_RULES).count() == 1
    assert prepare.parse_orders(batch, S.ALL_ORDERS_RULES).count() == 3
    assert reasons(spark, S.NOTIFY_RULES, message(**{S.SERVICE: ...})) == {0: "missing_field"}


def test_the_last_of_a_repeated_field_counts(spark):
    text = message()[:-1] + f', "{S.FEE}": "7"}}'
    assert prepare.parse_orders(messages(spark, text), S.NOTIFY_RULES).first()["fee"] == 7


def test_daily_results_need_three_fields_only(spark):
    batch = messages(
        spark,
        message(**{S.FEE: "12x", S.NOTIFY_TIME: "x", S.REQUEST_ID: "20240229"}),
        message(**{S.REQUEST_ID: "20240231"}),
        message(**{S.REQUEST_ID: "abcdefghij"}),
        message(**{S.REQUEST_ID: "2024023"}),
        message(**{S.PROVINCE_CODE: ...}),
        "nope",
    )
    assert as_set(prepare.parse_day_results(batch)) == {("20240229", "100", "0000", True)}


def test_blanks_are_stripped_up_to_a_space(spark):
    padded = [message(**{S.RESULT: "0000\t"}), message(**{S.RESULT: "\n0000 \x01"})]
    orders = prepare.parse_orders(messages(spark, *padded), S.ALL_ORDERS_RULES)
    assert [o["result_code"] for o in orders.collect()] == ["0000", "0000"]


def test_time_keys(spark):
    sunday = message(**{S.REQUEST_ID: "20240107230509001ab"})
    orders = prepare.parse_orders(messages(spark, sunday), S.NOTIFY_RULES)
    (keys,) = prepare.order_time_keys(orders).collect()
    assert tuple(keys) == ("20240107230509001ab", "2024-01-07", "20240107", 0, 23, 5)
