"""Ratios, whole division and strict integers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_int(text: Column) -> Column:
    """Digits with an optional sign as a 32-bit integer; NULL for anything else."""
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("int"))


def ratio(part: Column, whole: Column) -> Column:
    """Plain double ratio; NULL when ``whole`` is 0."""
    return part.cast("double") / F.nullif(whole, F.lit(0)).cast("double")


def rounded_ratio(part: Column, whole: Column, digits: int) -> Column:
    """Ratio of two non-negative integers, rounded half up to ``digits`` places.

    Rounding happens on integers, so a tie such as 57/200 at two places does not
    depend on how the double 0.285 is stored.
    """
    scale = 10**digits
    doubled = F.lit(2 * scale).cast("bigint") * part + whole
    return whole_quotient(doubled, F.lit(2) * whole) / F.lit(float(scale))


def whole_quotient(part: Column, whole: Column) -> Column:
    """Integer division, towards zero; NULL when ``whole`` is 0."""
    return F.call_function("div", part.cast("bigint"), F.nullif(whole, F.lit(0)))
