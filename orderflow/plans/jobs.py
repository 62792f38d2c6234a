"""The jobs: two streaming reports and the daily report.

A streaming job computes one small roll-up per micro-batch and feeds every result
from it, so messages are read and parsed once whatever the number of results. All
results are increments in replay-safe folders; the views add them up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderflow import schema as S
from orderflow.operators import leaders, lookup, metrics, offsets, prepare
from orderflow.sinks import batches
from orderflow.sinks.batches import Fold
from orderflow.streaming.run import start

_KEYS = ("minute_start", "day", "weekday", "hour", "minute")
FOLD_EVERY = 100  # batches
GRACE_SECONDS = 24 * 3600  # for readers of what folds have replaced


class NotifyReport:
    """Results over the orders of the notify service.

    Orders with an unknown province count in the daily and hourly results.
    """

    group = "notify-report"
    rules = S.NOTIFY_RULES
    folds = {
        "daily": Fold("sum", ("day",)),
        "failures": Fold("sum", ("weekday", "hour", "province")),
        "provinces": Fold("sum", ("province",)),
        "batch_top10": Fold("all"),
        "weekday_hours": Fold("sum", ("weekday", "hour")),
        "minutes": Fold("sum", ("minute_start", "province")),
    }

    def increments(self, rolled: DataFrame) -> dict[str, DataFrame]:
        minutes = metrics.known_province(rolled).groupBy("minute_start", "province")
        return {
            "daily": metrics.daily_totals(rolled),
            "failures": metrics.failures_weekday_hour_province(rolled),
            "provinces": metrics.province_totals(rolled),
            "batch_top10": leaders.top_provinces_by_orders(rolled),
            "weekday_hours": metrics.weekday_hour_volume(rolled),
            "minutes": minutes.agg(
                F.sum("orders").alias("orders"), F.sum("fee_all").alias("fee_total")
            ),
        }

    def views(self, spark: SparkSession, folder: str) -> dict[str, DataFrame]:
        minutes = _written(spark, folder, "minutes")
        hours = minutes.withColumn("hour_start", F.date_trunc("hour", "minute_start"))
        days = minutes.withColumn("day", F.to_date("minute_start"))
        return {
            "daily_overview": metrics.daily_rates(_summed(spark, folder, "daily", "day")),
            "failures_weekday_hour_province": _summed(
                spark, folder, "failures", "weekday", "hour", "province"
            ),
            "top10_province_orders": leaders.rank_by_orders(
                _summed(spark, folder, "provinces", "province")
            ),
            "top10_of_last_batches": batches.newest_per_key(
                _written(spark, folder, "batch_top10"), "province"
            ),
            "weekday_hour_volume": _summed(spark, folder, "weekday_hours", "weekday", "hour"),
            "province_minute_volume": batches.counter_sums(minutes, "minute_start", "province"),
            "province_hour_volume": batches.counter_sums(
                hours.drop("minute_start"), "hour_start", "province"
            ),
            "province_day_volume": batches.counter_sums(
                days.drop("minute_start"), "day", "province"
            ),
        }


class AllOrdersReport:
    """Results over the orders of every service whose province is known."""

    group = "all-orders-report"
    rules = S.ALL_ORDERS_RULES
    folds = {
        "global": Fold("sum"),
        "failures": Fold("sum", ("province", "hour")),
        "provinces": Fold("sum", ("province",)),
        "boards": Fold("all"),
        "hours": Fold("sum", ("hour",)),
        "minutes_of_day": Fold("sum", ("province", "hour", "minute")),
    }

    def increments(self, rolled: DataFrame) -> dict[str, DataFrame]:
        known = metrics.known_province(rolled)
        return {
            "global": metrics.global_totals(known),
            "failures": metrics.failures_province_hour(known),
            "provinces": metrics.province_totals(known),
            "boards": leaders.province_success_board(known),
            "hours": metrics.hourly_success_volume(known),
            "minutes_of_day": metrics.province_minute_of_day_success(known),
        }

    def views(self, spark: SparkSession, folder: str) -> dict[str, DataFrame]:
        provinces = metrics.province_success_rates(
            _summed(spark, folder, "provinces", "province")
        )
        return {
            "global_overview": metrics.global_rates(_summed(spark, folder, "global")),
            "failures_province_hour": _summed(spark, folder, "failures", "province", "hour"),
            "top10_province_success": provinces.orderBy(F.desc("orders"), "province").limit(10),
            "top10_of_every_batch": _written(spark, folder, "boards"),
            "hourly_success_volume": _summed(spark, folder, "hours", "hour"),
            "province_minute_of_day_success": _summed(
                spark, folder, "minutes_of_day", "province", "hour", "minute"
            ),
        }


Report = NotifyReport | AllOrdersReport


def _written(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return batches.read_batches(spark, folder, name)


def _summed(spark: SparkSession, folder: str, name: str, *keys: str) -> DataFrame:
    return batches.counter_sums(_written(spark, folder, name), *keys)


def write_increments(
    report: Report,
    messages: DataFrame,
    dimension: DataFrame,
    folder: str,
    batch_id: int,
) -> None:
    """Everything one micro-batch adds: results, rejects and stream positions.

    The batch is parsed once and kept for the passes over it, without the columns
    no result needs and with the text of rejected messages only.
    """
    bad = F.col("reason").isNotNull()
    checked = (
        prepare.check_messages(messages, report.rules)
        .drop("request_id", "result_code", "end_ts")
        .withColumns({c: F.when(bad, F.col(c)) for c in ("key", "value")})
        .persist()
    )
    orders = prepare.accepted(checked, report.rules)
    minutes = metrics.order_facts(orders).withColumn("minute_start", F.date_trunc("minute", "start_ts"))
    rolled = metrics.province_facts(minutes, dimension, *_KEYS, how="left").persist()
    unknown = rolled.filter("province IS NULL").groupBy("province_code")
    results = {
        **report.increments(rolled),
        "unknown_codes": unknown.agg(F.sum("orders").alias("orders")),
        "rejected": prepare.rejected(checked),
        "offsets": offsets.offset_ranges(checked).withColumn("grp", F.lit(report.group)),
    }
    try:
        batches.publish(results, folder, batch_id)
    finally:
        rolled.unpersist()
        checked.unpersist()


def start_report(
    report: Report,
    messages: DataFrame,
    dimension: DataFrame,
    folder: str,
    interval: str | None = "5 seconds",
    checkpoint: str | None = None,
    fold_every: int = FOLD_EVERY,
    grace_seconds: float = GRACE_SECONDS,
) -> StreamingQuery:
    """Start a streaming report on a message stream (``MESSAGE_SCHEMA``).

    A restart with the same ``folder`` goes on where the last run stopped. A new query with
    another ``checkpoint``, started from ``resume_offsets``, adds to the results of the old one. Finished batches are
    folded, and what that replaces is removed after ``grace_seconds``.
    """

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        write_increments(report, rows, dimension, folder, batch_id)
        if batch_id % fold_every == fold_every - 1:
            fold_report(rows.sparkSession, report, folder)
            batches.prune(rows.sparkSession, folder, grace_seconds)

    return start(messages, on_batch, checkpoint or f"{folder}/checkpoint", interval=interval)


def fold_report(spark: SparkSession, report: Report, folder: str) -> bool:
    """Sum up finished batches of a report; rejects and positions keep all they need."""
    rules = {
        **report.folds,
        "unknown_codes": Fold("sum", ("province_code",)),
        "rejected": Fold("all"),
        "offsets": Fold("newest", ("topic", "partition", "grp")),
    }
    return batches.fold(spark, folder, rules)


def saved_positions(spark: SparkSession, report: Report, folder: str) -> DataFrame:
    """The last offsets a report has saved (``topic, partition, saved_offset``)."""
    return offsets.saved_offsets(_written(spark, folder, "offsets"), report.group)


def resume_offsets(
    spark: SparkSession, report: Report, folder: str, earliest: DataFrame, topics: list[str] | None = None, all_listed: bool = False
) -> str:
    """Starting offsets for a new query from the ledger a report has kept, for all partitions of the log.

    ``earliest`` holds the first offset each partition still has (``topic, partition, earliest_offset``);
    ``topics`` are those that the query subscribes. A partition that ``earliest`` lacks keeps its saved offset, unless
    ``all_listed`` says that the log has no others; the Kafka source takes no offset for a partition that is gone.
    """
    saved = saved_positions(spark, report, folder)
    return offsets.starting_offsets_json(offsets.resume_positions(saved, earliest, topics, all_listed))


def daily_facts(results: DataFrame, dimension: DataFrame, how: str = "inner") -> DataFrame:
    """Orders and failures per day and province of usable results, looked up after summing."""
    sums = metrics.day_result_facts(results).groupBy("day", "province_code").agg(
        F.sum("orders").alias("orders"), F.sum("failures").alias("failures")
    )
    return lookup.provinces_of_sums(sums, dimension, how)


def daily_results(facts: DataFrame) -> dict[str, DataFrame]:
    """The daily report: failures per day and province, and their leaders."""
    daily = metrics.daily_province_failures(facts)
    return {
        "daily_province_failures": daily,
        "province_failure_rate": metrics.province_failure_rate(facts),
        "top3_failures": leaders.top_failures(daily),
        "top3_failures_per_day": leaders.top_failures_per_day(daily),
    }


def write_daily_report(
    messages: DataFrame, dimension: DataFrame, folder: str, run_id: int
) -> None:
    """Append the daily report as one run; the same run again replaces itself.

    Messages are read once. Those that can't be used go to ``rejected``, codes without a
    province to ``unknown_codes`` with their orders.
    """
    checked = prepare.check_day_results(messages)
    bad = F.col("reason").isNotNull()
    checked = checked.withColumns({c: F.when(bad, F.col(c)) for c in messages.columns}).persist()
    usable = checked.filter(~bad).select(*prepare.DAY_COLUMNS)
    totals = daily_facts(usable, dimension, "left").persist()
    unknown = totals.filter("province IS NULL").groupBy("province_code")
    results = {
        **daily_results(metrics.known_province(totals)),
        "unknown_codes": unknown.agg(F.sum("orders").alias("orders")),
        "rejected": prepare.rejected_day_results(checked),
    }
    try:
        batches.publish(results, folder, run_id, run="daily")
    finally:
        totals.unpersist()
        checked.unpersist()
