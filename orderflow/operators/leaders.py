"""Leaderboards. Ties are broken by the key, so a result never depends on order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.functions.numbers import ratio
from orderflow.operators import metrics


def top_provinces_by_orders(facts: DataFrame, k: int = 10) -> DataFrame:
    """Provinces with the most orders, and their plain success rate."""
    return rank_by_orders(metrics.province_totals(facts), k)


def rank_by_orders(totals: DataFrame, k: int = 10) -> DataFrame:
    rate = ratio(F.col("successes"), F.col("orders")).alias("success_rate")
    return (
        totals.select("province", "orders", rate).orderBy(F.desc("orders"), "province").limit(k)
    )


def province_success_board(facts: DataFrame, k: int = 10, largest: bool = True) -> DataFrame:
    """Provinces with the most (or fewest) orders, with successes and rate."""
    order = F.desc("orders") if largest else F.asc("orders")
    return (
        metrics.province_success_rates(metrics.province_totals(facts))
        .orderBy(order, "province")
        .limit(k)
    )


def top_failures(daily: DataFrame, k: int = 3) -> DataFrame:
    """The k (day, province) rows with the most failures, over all days."""
    return daily.orderBy(F.desc("failures"), "day", "province").limit(k)


def top_failures_per_day(daily: DataFrame, k: int = 3) -> DataFrame:
    """The k provinces with the most failures of every day.

    Works on one row per day and province, so a day's group is no larger than
    the dimension.
    """
    place = Window.partitionBy("day").orderBy(F.desc("failures"), "province")
    return daily.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= k)
