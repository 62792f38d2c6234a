"""Time parsing and the keys taken from an order's start time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow.schema import DAY_DIGITS, TIME_DIGITS


def compact_time(text: Column) -> Column:
    """Leading ``yyyyMMddHHmmssSSS`` of a text as a timestamp.

    NULL when the text does not start with 17 digits or they are no real time, or
    the year is before 1000.
    """
    return _digits_time(F.substring(text, 1, TIME_DIGITS))


def whole_compact_time(text: Column) -> Column:
    """As ``compact_time``, but the text must be the time and nothing else."""
    return _digits_time(F.when(F.length(text) == TIME_DIGITS, text))


def _digits_time(text: Column) -> Column:
    """Take the parts off as one number, several times faster than a time pattern.

    A number in the range checked has 17 digits, so 17 characters that make it hold
    neither sign nor blank. ``try_make_timestamp`` refuses months, days and hours that do not
    exist, but takes 60 seconds for a full minute.
    """
    digits = text.try_cast("bigint")

    def part(place: int, width: int = 2) -> Column:
        shifted = F.call_function("div", digits, F.lit(10**place))
        return (shifted % 10**width).cast("int")

    seconds = F.try_make_timestamp(
        part(13, 4), part(11), part(9), part(7), part(5), part(3).cast("decimal(16,6)")
    )
    real = digits.between(10 ** (TIME_DIGITS - 1), 10**TIME_DIGITS - 1) & (part(3) < 60)
    return F.when(real, F.timestamp_add("MILLISECOND", part(0, 3), seconds))


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def day_text(ts: Column) -> Column:
    """Calendar day as ``yyyy-MM-dd``."""
    return F.to_date(ts).cast("string")


def compact_day(request_id: Column) -> Column:
    """First eight characters; NULL when there are fewer."""
    return F.when(F.length(request_id) >= DAY_DIGITS, F.substring(request_id, 1, DAY_DIGITS))


def is_compact_day(text: Column) -> Column:
    """Whether a text is eight digits of a real date."""
    parts = [F.substring(text, a, n).try_cast("int") for a, n in ((1, 4), (5, 2), (7, 2))]
    made = F.call_function("try_make_timestamp", *parts, F.lit(0), F.lit(0), F.lit(0).cast("decimal(16,6)"))
    return text.rlike("^[0-9]{8}$") & made.isNotNull()


def weekday(ts: Column) -> Column:
    """Day of the week, Sunday = 0."""
    return F.dayofweek(ts) - 1


def hour(ts: Column) -> Column:
    return F.hour(ts)


def minute(ts: Column) -> Column:
    return F.minute(ts)


def elapsed_ms(start: Column, end: Column) -> Column:
    return F.unix_millis(end) - F.unix_millis(start)
