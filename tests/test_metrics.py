import datetime as dt

import pytest
from builders import as_set, dimension, message, messages

from orderflow import schema as S
from orderflow.operators import leaders, lookup, metrics, prepare

NAMES = {"1": "North", "2": "South", "3": "North"}


def order(province="1", start="20240101000000000", ms=0, result="0000", fee=10):
    end = dt.datetime.strptime(start, "%Y%m%d%H%M%S%f") + dt.timedelta(milliseconds=ms)
    return message(
        **{
            S.REQUEST_ID: start + "00000001",
            S.NOTIFY_TIME: end.strftime("%Y%m%d%H%M%S%f")[:17],
            S.PROVINCE_CODE: province,
            S.RESULT: result,
            S.FEE: str(fee),
        }
    )


def facts(spark, *texts):
    orders = prepare.parse_orders(messages(spark, *texts), S.NOTIFY_RULES)
    return metrics.order_facts(lookup.attach_province(orders, dimension(spark, NAMES)))


@pytest.fixture(scope="module")
def mixed(spark):
    hours = ("00", "05", "23")
    texts = [
        order(
            province=str(1 + i % 4),
            start=f"2024010{1 + i % 3}{hours[i % 3]}{i % 60:02d}00{i:03d}",
            ms=i * 7,
            result="1001" if i % 5 == 0 else "0000",
            fee=i,
        )
        for i in range(200)
    ]
    return facts(spark, *texts).cache()


SUMMED = [
    metrics.daily_overview,
    metrics.global_overview,
    metrics.failures_weekday_hour_province,
    metrics.failures_province_hour,
    metrics.province_orders,
    metrics.province_successes,
    metrics.province_success_join,
    metrics.weekday_hour_volume,
    metrics.hourly_success_volume,
    metrics.province_day_volume,
    metrics.province_day_throughput_literal,
    metrics.province_minute_of_day_success,
    leaders.top_provinces_by_orders,
    leaders.province_success_board,
]


@pytest.mark.parametrize("metric", SUMMED, ids=lambda m: m.__name__)
def test_summed_facts_give_the_same_metric(mixed, metric):
    rolled = metrics.rollup(mixed, "day", "weekday", "hour", "minute", "province")
    assert as_set(metric(rolled)) == as_set(metric(mixed))
    assert as_set(metric(mixed))


def test_daily_overview(spark):
    rows = facts(
        spark,
        order(ms=1000, fee=3),
        order(ms=500, fee=4, result="1001"),
        order(province="9", ms=0, fee=5),
        order(start="20240102000000000", fee=7),
    )
    assert as_set(metrics.daily_overview(rows)) == {
        ("2024-01-01", 3, 8, 2, 1500, 0.66667, 0.5),
        ("2024-01-02", 1, 7, 1, 0, 1.0, 0.0),
    }
    money = {r["day"]: r["fee_total"] for r in metrics.daily_overview(rows, "all").collect()}
    assert money == {"2024-01-01": 12, "2024-01-02": 7}


def test_global_overview_divides_whole(spark):
    rows = facts(spark, order(ms=3, fee=1), order(ms=4, fee=2, result="1"))
    assert as_set(metrics.global_overview(rows)) == {(2, 1, 0.5, 3, 3)}


def test_empty_input(spark):
    rows = facts(spark, "nope")
    assert as_set(metrics.global_overview(rows)) == {(0, 0, None, None, 0)}
    assert metrics.daily_overview(rows).count() == 0
    assert leaders.top_provinces_by_orders(rows).count() == 0


def test_keys_without_failures(spark):
    rows = facts(spark, order(), order(province="2", result="1001"))
    assert as_set(metrics.failures_weekday_hour_province(rows)) == {
        (1, 0, "North", 0),
        (1, 0, "South", 1),
    }
    assert as_set(metrics.failures_province_hour(rows)) == {("South", 0, 1)}


def test_codes_of_one_name_are_one_province(spark):
    rows = facts(spark, order("1"), order("3"), order("2"))
    assert as_set(metrics.province_orders(rows)) == {("North", 2), ("South", 1)}


def test_unknown_provinces_stay_out_of_province_metrics(spark):
    rows = facts(spark, order("9"), order("1"))
    assert as_set(metrics.province_orders(rows)) == {("North", 1)}
    assert metrics.weekday_hour_volume(rows).first()["orders"] == 2


def test_money_above_32_bits(spark):
    rows = facts(spark, *[order(fee=2_000_000_000)] * 3)
    assert metrics.weekday_hour_volume(rows).first()["fee_total"] == 6_000_000_000


def test_literal_throughput_floors(spark):
    rows = facts(spark, order(fee=3599), order(fee=3601), order("2", fee=216000))
    assert as_set(metrics.province_day_throughput_literal(rows)) == {
        ("2024-01-01", "North", 0, 0, 2, 0),
        ("2024-01-01", "South", 0, 0, 60, 1),
    }


def test_ties_on_the_board_go_by_name(spark):
    rows = facts(spark, order("2"), order("1"))
    assert [r["province"] for r in leaders.top_provinces_by_orders(rows, 1).collect()] == ["North"]
    fewest = leaders.province_success_board(rows, 1, largest=False)
    assert [r["province"] for r in fewest.collect()] == ["North"]


def test_failure_leaders(spark):
    daily = spark.createDataFrame(
        [("d1", p, n, 10, 0.1) for p, n in zip("abcd", (5, 4, 4, 9))] + [("d2", "a", 1, 10, 0.1)],
        "day string, province string, failures bigint, orders bigint, failure_rate double",
    )
    top = [(r["day"], r["province"]) for r in leaders.top_failures(daily).collect()]
    assert top == [("d1", "d"), ("d1", "a"), ("d1", "b")]
    per_day = leaders.top_failures_per_day(daily).select("day", "province", "place")
    assert as_set(per_day) == {("d1", "d", 1), ("d1", "a", 2), ("d1", "b", 3), ("d2", "a", 1)}


def test_minute_and_hour_volume(spark):
    rows = facts(
        spark, order(start="20240101000059999"), order(start="20240101000100000", result="1")
    )
    assert metrics.province_minute_volume(rows).count() == 2
    (hour,) = metrics.province_hour_volume(rows).collect()
    assert tuple(hour) == (dt.datetime(2024, 1, 1), "North", 2, 20)
