"""Volume, money, success and failure metrics.

Every metric is a sum over additive measures, so it takes single orders
(``order_facts``) as well as facts summed before (``rollup``), in a batch or on a
stream. Rates come last, from sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.functions import times
from orderflow.functions.numbers import ratio, rounded_ratio, whole_quotient
from orderflow.operators import lookup

MEASURES = ("orders", "successes", "failures", "fee_all", "fee_success", "duration_ms")

_SECONDS_PER_HOUR = 3600
_SECONDS_TIMES_60 = 216000


def order_facts(orders: DataFrame) -> DataFrame:
    """Orders with their time keys and one row's worth of every measure."""
    start = F.col("start_ts")
    ok = F.col("is_success")
    fee = F.col("fee").cast("bigint")
    return orders.withColumns(
        {
            "weekday": times.weekday(start),
            "hour": times.hour(start),
            "minute": times.minute(start),
            **_counts(ok),
            "fee_all": fee,
            "fee_success": F.when(ok, fee).otherwise(F.lit(0).cast("bigint")),
        }
    )


def day_result_facts(results: DataFrame) -> DataFrame:
    """Facts for the daily report, which knows no fees and no times."""
    return results.withColumns(_counts(F.col("is_success")))


def _counts(ok: Column) -> dict[str, Column]:
    return {
        "orders": F.lit(1).cast("bigint"),
        "successes": ok.cast("bigint"),
        "failures": (~ok).cast("bigint"),
    }


def _sums(**measures: str) -> list[Column]:
    return [F.sum(measure).alias(name) for name, measure in measures.items()]


def rollup(facts: DataFrame, *keys: str) -> DataFrame:
    """All measures summed per key; any metric on coarser keys can start from it."""
    return facts.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in MEASURES])


def province_facts(
    facts: DataFrame, dimension: DataFrame, *keys: str, how: str = "inner"
) -> DataFrame:
    """Facts summed by province code and ``keys``, with the province looked up for each sum.

    Single orders are neither joined nor shuffled: the join sees a row for each code and key. A metric
    on these facts sums again, by name.
    """
    return lookup.provinces_of_sums(rollup(facts, "province_code", *keys), dimension, how)


def known_province(facts: DataFrame) -> DataFrame:
    return facts.filter("province IS NOT NULL")


# --- overviews ---------------------------------------------------------------


def daily_totals(facts: DataFrame, fee_scope: str = "success") -> DataFrame:
    """Per day: orders, money, successes and time spent, all additive."""
    return facts.groupBy("day").agg(
        *_sums(
            orders="orders",
            fee_total=_fee(fee_scope),
            successes="successes",
            total_ms="duration_ms",
        )
    )


def daily_rates(totals: DataFrame) -> DataFrame:
    return totals.select(
        F.col("day").cast("string").alias("day"),
        "orders",
        "fee_total",
        "successes",
        "total_ms",
        rounded_ratio(F.col("successes"), F.col("orders"), 5).alias("success_rate"),
        (ratio(F.col("total_ms"), F.col("orders")) / 1000).alias("avg_seconds"),
    )


def daily_overview(facts: DataFrame, fee_scope: str = "success") -> DataFrame:
    """Daily totals with success rate (five places) and average seconds per order."""
    return daily_rates(daily_totals(facts, fee_scope))


def global_totals(facts: DataFrame, fee_scope: str = "all") -> DataFrame:
    measures = dict(
        orders="orders",
        successes="successes",
        total_ms="duration_ms",
        fee_total=_fee(fee_scope),
    )
    zero = F.lit(0).cast("bigint")
    return facts.agg(*[F.coalesce(F.sum(m), zero).alias(n) for n, m in measures.items()])


def global_rates(totals: DataFrame) -> DataFrame:
    return totals.select(
        "orders",
        "successes",
        ratio(F.col("successes"), F.col("orders")).alias("success_rate"),
        whole_quotient(F.col("total_ms"), F.col("orders")).alias("avg_ms"),
        "fee_total",
    )


def global_overview(facts: DataFrame, fee_scope: str = "all") -> DataFrame:
    """One row over everything; the average is in whole milliseconds."""
    return global_rates(global_totals(facts, fee_scope))


def _fee(scope: str) -> str:
    return {"success": "fee_success", "all": "fee_all"}[scope]


# --- failures ----------------------------------------------------------------


def failures_weekday_hour_province(facts: DataFrame) -> DataFrame:
    """Keys that had orders but no failure are kept, with 0."""
    return (
        known_province(facts)
        .groupBy("weekday", "hour", "province")
        .agg(*_sums(failures="failures"))
    )


def failures_province_hour(facts: DataFrame) -> DataFrame:
    """Hour of day over all days; only keys that had a failure."""
    return (
        known_province(facts)
        .filter("failures > 0")
        .groupBy("province", "hour")
        .agg(*_sums(failures="failures"))
    )


def daily_province_failures(facts: DataFrame) -> DataFrame:
    return (
        known_province(facts)
        .groupBy("day", "province")
        .agg(*_sums(failures="failures", orders="orders"))
        .withColumn("failure_rate", rounded_ratio(F.col("failures"), F.col("orders"), 2))
    )


def province_failure_rate(facts: DataFrame) -> DataFrame:
    return (
        known_province(facts)
        .groupBy("province")
        .agg(*_sums(failures="failures", total="orders"))
        .withColumn("failure_rate", rounded_ratio(F.col("failures"), F.col("total"), 5))
    )


# --- provinces ---------------------------------------------------------------


def province_totals(facts: DataFrame) -> DataFrame:
    return (
        known_province(facts)
        .groupBy("province")
        .agg(*_sums(orders="orders", successes="successes"))
    )


def province_orders(facts: DataFrame) -> DataFrame:
    return known_province(facts).groupBy("province").agg(*_sums(orders="orders"))


def province_successes(facts: DataFrame) -> DataFrame:
    """Only provinces that had a success."""
    return (
        known_province(facts)
        .filter("successes > 0")
        .groupBy("province")
        .agg(*_sums(successes="successes"))
    )


def province_success_rates(totals: DataFrame) -> DataFrame:
    """Rate to three places, from ``province_totals``."""
    return totals.select(
        "province",
        "successes",
        "orders",
        rounded_ratio(F.col("successes"), F.col("orders"), 3).alias("success_rate"),
    )


def province_success_join(facts: DataFrame) -> DataFrame:
    """Successes joined with orders by province, as one aggregation.

    The inner join keeps provinces with a success; so does the filter here, and
    the orders are read once.
    """
    return province_success_rates(province_totals(facts).filter("successes > 0"))


# --- volume over time --------------------------------------------------------


def weekday_hour_volume(facts: DataFrame, fee_scope: str = "all") -> DataFrame:
    return facts.groupBy("weekday", "hour").agg(*_sums(orders="orders", fee_total=_fee(fee_scope)))


def hourly_success_volume(facts: DataFrame) -> DataFrame:
    """Successes and their money per hour of day."""
    return (
        facts.filter("successes > 0")
        .groupBy("hour")
        .agg(*_sums(successes="successes", fee_total="fee_success"))
    )


def province_day_volume(facts: DataFrame) -> DataFrame:
    return (
        known_province(facts)
        .groupBy("day", "province")
        .agg(*_sums(orders="orders", fee_total="fee_all"))
    )


def province_day_throughput_literal(facts: DataFrame) -> DataFrame:
    """Day totals divided by 3600 and 216000, whole division.

    The divisors are those of the original report, which calls the first one a
    minute. ``province_minute_volume`` and ``province_hour_volume`` count real
    minutes and hours.
    """
    orders, fee = F.col("orders"), F.col("fee_total")
    return province_day_volume(facts).select(
        F.col("day").cast("string").alias("day"),
        "province",
        whole_quotient(orders, F.lit(_SECONDS_PER_HOUR)).alias("orders_per_3600"),
        whole_quotient(orders, F.lit(_SECONDS_TIMES_60)).alias("orders_per_216000"),
        whole_quotient(fee, F.lit(_SECONDS_PER_HOUR)).alias("fee_per_3600"),
        whole_quotient(fee, F.lit(_SECONDS_TIMES_60)).alias("fee_per_216000"),
    )


def province_minute_volume(facts: DataFrame) -> DataFrame:
    """Orders and money of all results per province and calendar minute."""
    return _province_volume(facts, F.date_trunc("minute", "start_ts"), "minute_start")


def province_hour_volume(facts: DataFrame) -> DataFrame:
    return _province_volume(facts, F.date_trunc("hour", "start_ts"), "hour_start")


def _province_volume(facts: DataFrame, slot: Column, name: str) -> DataFrame:
    return (
        known_province(facts)
        .groupBy(slot.alias(name), "province")
        .agg(*_sums(orders="orders", fee_total="fee_all"))
    )


def windowed_province_volume(facts: DataFrame, length: str, lateness: str) -> DataFrame:
    """Streaming form of the minute and hour volume.

    Minute keys never stop coming, so the state of a window is dropped once
    ``lateness`` has passed since its end; orders later than that are left out.
    """
    return (
        known_province(facts)
        .withWatermark("start_ts", lateness)
        .groupBy(F.window("start_ts", length).alias("slot"), "province")
        .agg(*_sums(orders="orders", fee_total="fee_all"))
        .select(F.col("slot.start").alias("slot_start"), "province", "orders", "fee_total")
    )


def province_minute_of_day_success(facts: DataFrame) -> DataFrame:
    """Successes and their money per province and minute of the day, over all days."""
    return (
        known_province(facts)
        .filter("successes > 0")
        .groupBy("province", "hour", "minute")
        .agg(*_sums(successes="successes", fee_total="fee_success"))
    )
