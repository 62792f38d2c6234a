"""From message text to typed orders, with unusable messages set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow import schema as S
from orderflow.functions import times
from orderflow.functions.numbers import strict_int
from orderflow.functions.texts import is_one_object, json_fields

_FIELDS = {
    S.REQUEST_ID: "request_id",
    S.NOTIFY_TIME: "notify_time",
    S.PROVINCE_CODE: "province_code",
    S.RESULT: "result_code",
    S.FEE: "fee_text",
    S.SERVICE: "service_name",
}


def message_fields(messages: DataFrame, rules: S.MessageRules) -> DataFrame:
    """The six fields of every message as text, next to the message's own columns."""
    fields = messages.select("*", json_fields(F.col("value"), *_FIELDS).alias(*_FIELDS.values()))
    if not rules.trim:
        return fields
    trimmed = ("request_id", "notify_time", "result_code")
    return fields.withColumns({name: stripped(F.col(name)) for name in trimmed})


#: Blanks are all characters up to U+0020.
BLANKS = "".join(map(chr, range(0x21)))


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def _reject_reason(rules: S.MessageRules) -> Column:
    """Why a message cannot become an order, or NULL when it can."""
    required = "request_id IS NULL OR province_code IS NULL OR result_code IS NULL"
    if rules.service is not None:
        required += " OR service_name IS NULL"
    return F.expr(
        f"""CASE
          WHEN coalesce({", ".join(_FIELDS.values())}) IS NULL THEN 'unreadable'
          WHEN NOT one_object THEN 'trailing_text'
          WHEN {required} OR fee_text IS NULL THEN 'missing_field'
          WHEN fee IS NULL THEN 'bad_fee'
          WHEN start_ts IS NULL THEN 'bad_start_time'
          WHEN notify_time IS NOT NULL AND notified_ts IS NULL THEN 'bad_end_time'
        END"""
    )


def check_messages(messages: DataFrame, rules: S.MessageRules) -> DataFrame:
    """Every message with its order columns (``ORDER_SCHEMA``) and ``reason``.

    ``reason`` is NULL for a usable message and says what is wrong with any other.
    The typed columns leave through a one-element ``inline``: a plain projection
    would let the optimizer copy the time parsing into every filter on top of it.
    """
    typed = F.struct(
        is_one_object(F.col("value")).alias("one_object"),
        strict_int(F.col("fee_text")).alias("fee"),
        times.compact_time(F.col("request_id")).alias("start_ts"),
        times.whole_compact_time(F.col("notify_time")).alias("notified_ts"),
    )
    checked = message_fields(messages, rules).select("*", F.inline(F.array(typed)))
    end_ts = F.coalesce("notified_ts", "start_ts")
    return checked.select(
        *messages.columns,
        "request_id",
        "service_name",
        "result_code",
        (F.col("result_code") == S.SUCCESS_CODE).alias("is_success"),
        "fee",
        "start_ts",
        end_ts.alias("end_ts"),
        times.elapsed_ms(F.col("start_ts"), end_ts).alias("duration_ms"),
        "province_code",
        times.day_of(F.col("start_ts")).alias("day"),
        _reject_reason(rules).alias("reason"),
    )


def accepted(checked: DataFrame, rules: S.MessageRules) -> DataFrame:
    """The usable orders, of one service where the rules name one."""
    if rules.service is not None:
        checked = checked.filter(F.col("service_name") == rules.service)
    kept = [c for c in S.ORDER_SCHEMA.names if c in checked.columns]
    return checked.filter("reason IS NULL").select(*kept)


def rejected(checked: DataFrame) -> DataFrame:
    """The unusable messages as they came, with the reason."""
    own = [c for c in checked.columns if c not in S.ORDER_SCHEMA.names]
    return checked.filter("reason IS NOT NULL").select(*own)


def parse_orders(messages: DataFrame, rules: S.MessageRules) -> DataFrame:
    return accepted(check_messages(messages, rules), rules)


def rejected_messages(messages: DataFrame, rules: S.MessageRules) -> DataFrame:
    return rejected(check_messages(messages, rules))


def check_day_results(messages: DataFrame) -> DataFrame:
    """Day, province code and success of each message for the daily report, and ``reason``.

    Only these three fields have to be usable; fee and times are not looked at. The day is the
    first eight characters of the request id and must be a real date.
    """
    fields = messages.select(
        "*",
        json_fields(F.col("value"), S.REQUEST_ID, S.PROVINCE_CODE, S.RESULT).alias(
            "request_id", "province_code", "result_code"
        ),
    )
    day = F.struct(times.compact_day(F.col("request_id")).alias("day"), is_one_object(F.col("value")).alias("one_object"))
    real = times.is_compact_day(F.col("day"))
    reason = (
        F.when(F.coalesce("request_id", "province_code", "result_code").isNull(), "unreadable")
        .when(~F.col("one_object"), "trailing_text")
        .when(
            F.col("request_id").isNull() | F.col("province_code").isNull() | F.col("result_code").isNull(),
            "missing_field",
        )
        .when(~F.coalesce(real, F.lit(False)), "bad_day")
    )
    return fields.select("*", F.inline(F.array(day))).select(
        *messages.columns,
        "day",
        "province_code",
        "result_code",
        (F.col("result_code") == S.SUCCESS_CODE).alias("is_success"),
        reason.alias("reason"),
    )


DAY_COLUMNS = ("day", "province_code", "result_code", "is_success")


def parse_day_results(messages: DataFrame) -> DataFrame:
    return check_day_results(messages).filter("reason IS NULL").select(*DAY_COLUMNS)


def rejected_day_results(checked: DataFrame) -> DataFrame:
    """The messages the daily report can't use as they came, with the reason."""
    return checked.filter("reason IS NOT NULL").drop(*DAY_COLUMNS)


def notify_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("service_name") == S.NOTIFY_SERVICE)


def order_durations(orders: DataFrame) -> DataFrame:
    return orders.select("request_id", "start_ts", "end_ts", "duration_ms")


def order_time_keys(orders: DataFrame) -> DataFrame:
    """Every time key the metrics group by."""
    start = F.col("start_ts")
    return orders.select(
        "request_id",
        times.day_text(start).alias("day"),
        times.compact_day(F.col("request_id")).alias("compact_day"),
        times.weekday(start).alias("weekday"),
        times.hour(start).alias("hour"),
        times.minute(start).alias("minute"),
    )
