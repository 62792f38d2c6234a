"""The registered queries: each operator over the whole test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow import schema as S
from orderflow.functions.texts import display_key
from orderflow.operators import leaders, lookup, metrics, offsets, prepare
from orderflow.plans import jobs
from orderflow.session import new_folder, settings
from orderflow.sinks import batches, partitions
from orderflow.sources import fixtures
from orderflow.sources.dimension import read_province_dimension
from orderflow.sources.messages import landed_messages, text_messages
from orderflow.sources.positions import earliest_offsets, log_range, log_stream, write_log
from orderflow.streaming import late, state
from orderflow.streaming import metrics as running
from orderflow.streaming.run import run_to_end

Query = Callable[[SparkSession, str], DataFrame]

_TIME = "yyyy-MM-dd HH:mm:ss.SSS"


# --- inputs ------------------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str, rules: S.MessageRules) -> DataFrame:
    return prepare.parse_orders(fixtures.messages(spark, sf_dir), rules)


def _notify_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of the notify service; no province, so no join."""
    return metrics.order_facts(_orders(spark, sf_dir, S.NOTIFY_RULES))


def _province_facts(rules: S.MessageRules, *keys: str) -> Query:
    """Facts by province and ``keys``, summed by code before the province is looked up."""

    def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = metrics.order_facts(_orders(spark, sf_dir, rules))
        return metrics.province_facts(orders, fixtures.provinces(spark, sf_dir), *keys)

    return facts


_NOTIFY, _ALL = S.NOTIFY_RULES, S.ALL_ORDERS_RULES


def _located(spark: SparkSession, sf_dir: str, orders: DataFrame) -> DataFrame:
    """Facts of single orders with their province, for running sums."""
    dimension = fixtures.provinces(spark, sf_dir)
    return metrics.order_facts(lookup.attach_province(orders, dimension, "inner"))


def _daily_report(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    results = prepare.parse_day_results(fixtures.messages(spark, sf_dir))
    return jobs.daily_results(jobs.daily_facts(results, fixtures.provinces(spark, sf_dir)))


def _stream(spark: SparkSession, sf_dir: str, order: str = "event_id") -> DataFrame:
    folder, files_per_batch = fixtures.land(spark, sf_dir, order=order)
    return landed_messages(spark, folder, files_per_batch)


def _notify_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.order_facts(prepare.parse_orders(_stream(spark, sf_dir), S.NOTIFY_RULES))


def _by_code(orders: DataFrame) -> DataFrame:
    """Facts whose province is its code: running sums are kept by code, and published by name (``_named``)."""
    return metrics.order_facts(orders.withColumn("province", F.col("province_code")))


def _named(spark: SparkSession, sf_dir: str, sums: DataFrame) -> DataFrame:
    """Sums by code as sums by province; codes without a province are left out."""
    named = lookup.provinces_of_sums(sums.withColumnRenamed("province", "province_code"), fixtures.provinces(spark, sf_dir), "inner")
    keys = [c for c in sums.columns if c in ("weekday", "hour", "day", "slot_start", "province")]
    return named.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums.columns if c not in keys])


def _notify_province_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_code(prepare.parse_orders(_stream(spark, sf_dir), S.NOTIFY_RULES))


def _all_province_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = prepare.parse_orders(_stream(spark, sf_dir), S.ALL_ORDERS_RULES)
    return _located(spark, sf_dir, orders)


# --- output shapes -----------------------------------------------------------


def _shown_orders(orders: DataFrame) -> DataFrame:
    """Orders with times as text, which compare alike in every engine."""
    return orders.select(
        "request_id",
        "service_name",
        "result_code",
        "is_success",
        "fee",
        F.date_format("start_ts", _TIME).alias("start_time"),
        F.date_format("end_ts", _TIME).alias("end_time"),
        "duration_ms",
        "province_code",
        F.col("day").cast("string").alias("day"),
    )


def _shown_slot(volume: DataFrame, slot: str) -> DataFrame:
    return volume.withColumn(slot, F.date_format(slot, "yyyy-MM-dd HH:mm:ss"))


def _shown_day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("day", F.col("day").cast("string"))


# --- preparation -------------------------------------------------------------


def parse_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_orders(_orders(spark, sf_dir, S.ALL_ORDERS_RULES))


def notify_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_orders(prepare.notify_orders(_orders(spark, sf_dir, S.ALL_ORDERS_RULES)))


def rejected_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.rejected_messages(fixtures.messages(spark, sf_dir), S.ALL_ORDERS_RULES)


def province_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension through its text form."""
    folder = new_folder(spark, "dimension")
    lines = fixtures.provinces(spark, sf_dir).select(
        F.concat_ws(" ", "province_code", "province").alias("value")
    )
    lines.write.text(folder)
    return read_province_dimension(spark, folder)


def offline_orders_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as text lines, read back for the daily report."""
    folder = new_folder(spark, "lines")
    fixtures.messages(spark, sf_dir).select("value").write.text(folder)
    return prepare.parse_day_results(text_messages(spark, folder))


def province_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, S.ALL_ORDERS_RULES)
    joined = lookup.attach_province(orders, fixtures.provinces(spark, sf_dir))
    return joined.select("request_id", "province_code", "province")


def unknown_province_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, S.ALL_ORDERS_RULES)
    return lookup.unknown_province_codes(orders, fixtures.provinces(spark, sf_dir))


def order_time_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.order_time_keys(_orders(spark, sf_dir, S.ALL_ORDERS_RULES))


def order_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    durations = prepare.order_durations(_orders(spark, sf_dir, S.ALL_ORDERS_RULES))
    return durations.select(
        "request_id",
        F.date_format("start_ts", _TIME).alias("start_time"),
        F.date_format("end_ts", _TIME).alias("end_time"),
        "duration_ms",
    )


def daily_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = prepare.check_day_results(fixtures.messages(spark, sf_dir))
    return prepare.rejected_day_results(checked)


def rejected_trailing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that were written behind another one, or before other text, by mistake."""
    nth = F.col("key").cast("bigint") % 1009
    value = F.col("value")
    glued = F.when(nth == 5, F.concat(value, value)).when(nth == 6, F.concat(value, F.lit(" x"))).when(nth == 7, F.concat(value, F.lit(" \n")))
    messages = fixtures.messages(spark, sf_dir).withColumn("value", F.coalesce(glued, value))
    rejects = prepare.rejected_messages(messages, S.ALL_ORDERS_RULES)
    daily = prepare.rejected_day_results(prepare.check_day_results(messages))
    both = rejects.select("key", "reason", F.lit("orders").alias("report")).unionByName(daily.select("key", "reason", F.lit("daily").alias("report")))
    return both.groupBy("report", "reason").agg(F.count("*").alias("messages"))


def daily_unknown_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    results = prepare.parse_day_results(fixtures.messages(spark, sf_dir))
    return lookup.unknown_province_codes(results, fixtures.provinces(spark, sf_dir))


# --- metrics -----------------------------------------------------------------


def daily_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.daily_overview(_notify_facts(spark, sf_dir))


def weekday_hour_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.weekday_hour_volume(_notify_facts(spark, sf_dir))


def province_minute_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = metrics.order_facts(_orders(spark, sf_dir, _NOTIFY)).withColumn(
        "start_ts", F.date_trunc("minute", "start_ts")
    )
    facts = metrics.province_facts(minutes, fixtures.provinces(spark, sf_dir), "start_ts")
    volume = metrics.province_minute_volume(facts)
    return _shown_slot(volume, "minute_start")


def province_hour_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = metrics.order_facts(_orders(spark, sf_dir, _NOTIFY)).withColumn(
        "start_ts", F.date_trunc("hour", "start_ts")
    )
    facts = metrics.province_facts(hours, fixtures.provinces(spark, sf_dir), "start_ts")
    volume = metrics.province_hour_volume(facts)
    return _shown_slot(volume, "hour_start")


def top10_province_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaders.province_success_board(_province_facts(_ALL)(spark, sf_dir))


def bottom10_province_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaders.province_success_board(_province_facts(_ALL)(spark, sf_dir), largest=False)


def _over(facts: Query, metric: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: metric(facts(spark, sf_dir))


def _from_daily_report(name: str) -> Query:
    return lambda spark, sf_dir: _daily_report(spark, sf_dir)[name]


# --- streams -----------------------------------------------------------------


def stream_orders_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parse a message stream into a table of orders, exactly once."""
    folder = new_folder(spark, "orders-ingest")
    orders = prepare.parse_orders(_stream(spark, sf_dir), S.ALL_ORDERS_RULES)
    query = (
        orders.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/rows")
    )
    query.awaitTermination()
    return _shown_orders(spark.read.schema(S.ORDER_SCHEMA).parquet(f"{folder}/rows"))


def stream_failures_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = metrics.failures_weekday_hour_province(_notify_province_stream(spark, sf_dir))
    history = running.touched_keys(spark, failures, new_folder(spark, "failures"))
    return _named(spark, sf_dir, batches.running_totals(history, "weekday", "hour", "province"))


def stream_weekday_hour_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = metrics.weekday_hour_volume(_notify_stream(spark, sf_dir))
    history = running.touched_keys(spark, volume, new_folder(spark, "weekday-hour"))
    return batches.running_totals(history, "weekday", "hour")


def stream_province_day_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = metrics.province_day_volume(_notify_province_stream(spark, sf_dir))
    history = running.touched_keys(spark, volume, new_folder(spark, "province-day"))
    return _shown_day(_named(spark, sf_dir, batches.running_totals(history, "day", "province")))


def _windows(spark: SparkSession, sf_dir: str, length: str, name: str) -> DataFrame:
    """Event-time windows of a stream in time order; state of a window goes two hours after its end."""
    orders = prepare.parse_orders(_stream(spark, sf_dir, "ts"), S.NOTIFY_RULES)
    volume = metrics.windowed_province_volume(_by_code(orders), length, "2 hours")
    history = running.touched_keys(spark, volume, new_folder(spark, "windows"))
    newest = _named(spark, sf_dir, batches.newest_per_key(history, "slot_start", "province"))
    return _shown_slot(newest.withColumnRenamed("slot_start", name), name)


def stream_province_hour_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir, "1 hour", "hour_start")


def stream_province_minute_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir, "1 minute", "minute_start")


def stream_hourly_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = metrics.hourly_success_volume(_all_province_stream(spark, sf_dir))
    return running.all_keys(spark, hours, new_folder(spark, "hours"), keys=("hour",))


def stream_top10_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    board = leaders.province_success_board(_all_province_stream(spark, sf_dir))
    return running.all_keys(spark, board, new_folder(spark, "top10"))


def stream_daily_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _notify_stream(spark, sf_dir)
    folder = new_folder(spark, "daily")
    history = running.increments(spark, facts, metrics.daily_totals, folder)
    return metrics.daily_rates(batches.counter_sums(history, "day"))


def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All results of the all-orders report from one stream, in long form."""
    folder = new_folder(spark, "fanout")
    report = jobs.AllOrdersReport()
    dimension = fixtures.provinces(spark, sf_dir)
    query = jobs.start_report(report, _stream(spark, sf_dir), dimension, folder, interval=None)
    query.awaitTermination()
    views = report.views(spark, folder)
    keys = {
        "global_overview": [],
        "failures_province_hour": ["province", "hour"],
        "hourly_success_volume": ["hour"],
        "province_minute_of_day_success": ["province", "hour", "minute"],
        "top10_province_success": ["province"],
    }
    measures = ("orders", "successes", "failures", "fee_total")

    def long_form(name: str) -> DataFrame:
        rows = views[name]
        kept = [
            (F.col(m) if m in rows.columns else F.lit(None)).cast("bigint").alias(m)
            for m in measures
        ]
        key = display_key(*[F.col(k) for k in keys[name]])
        return rows.select(F.lit(name).alias("result"), key.alias("key"), *kept)

    whole = long_form("global_overview")
    for name in list(keys)[1:]:
        whole = whole.unionByName(long_form(name))
    return whole


#: Logs that this application has written already.
_logs: dict[tuple[str, str], tuple[str, str]] = {}


def _second_half(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The log as segments, and the positions (JSON) at which the second half of every partition begins."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _logs:
        folder = new_folder(spark, "log")
        records = fixtures.records(spark, sf_dir).persist()
        try:
            # Segments are small here, so that the halves are several files each.
            write_log(records, folder, max(1, records.count() // 20))
            middle = records.groupBy("topic", "partition").agg(F.expr("(max(`offset`) + 1) div 2").alias("start_offset"))
            _logs[key] = folder, offsets.starting_offsets_json(middle)
        finally:
            records.unpersist()
    return _logs[key]


def stream_reseed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the log with one query, the rest with a new one that begins where the ledger says.

    The second query has a checkpoint of its own and counts its batches from 0; the results hold both. It opens no
    file before its positions.
    """
    log, middle = _second_half(spark, sf_dir)
    folder = new_folder(spark, "reseed")
    report, dimension = jobs.AllOrdersReport(), fixtures.provinces(spark, sf_dir)
    jobs.start_report(report, log_stream(spark, log, ending=middle), dimension, folder, interval=None).awaitTermination()
    start = jobs.resume_offsets(spark, report, folder, earliest_offsets(spark, log), all_listed=True)
    rest = log_stream(spark, log, starting=start)
    jobs.start_report(report, rest, dimension, folder, interval=None, checkpoint=f"{folder}/second").awaitTermination()
    return report.views(spark, folder)["global_overview"]


def stream_from_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream reads that begins at given positions, and what a range before them holds."""
    log, middle = _second_half(spark, sf_dir)
    folder = new_folder(spark, "positions")
    count = lambda rows: offsets.offset_ranges(rows).join(rows.groupBy("topic", "partition").agg(F.count("*").alias("messages")), ["topic", "partition"])
    history = running.increments(spark, log_stream(spark, log, starting=middle), count, folder)
    columns = ["topic", "partition", "from_offset", "until_offset", "messages"]
    read = history.select(F.lit("stream").alias("part"), *columns)
    return read.unionByName(count(log_range(spark, log, ending=middle)).select(F.lit("before").alias("part"), *columns))


def stream_running_reseed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running failures of two queries: the second has lost the checkpoint and goes on from the totals of the first.

    It begins at the positions where the first one ended and reads no message before them.
    """
    log, middle = _second_half(spark, sf_dir)
    folder = new_folder(spark, "running-reseed")
    keys, measures = ("weekday", "hour", "province_code"), ("failures",)

    def totals() -> DataFrame:
        history = batches.newest_per_key(batches.read_batches(spark, folder), *keys)
        return history.select(*keys, *measures)

    def run(stream: DataFrame, name: str, earlier: DataFrame | None) -> None:
        facts = metrics.order_facts(prepare.parse_orders(stream, S.NOTIFY_RULES))
        sums = state.running_sums(facts, keys, measures, earlier)
        with settings(spark, state.STATE_STORE):
            run_to_end(sums, running.folder_sink(folder), f"{folder}/{name}", "update", state_partitions=4)

    run(log_stream(spark, log, ending=middle), "first", None)
    run(log_stream(spark, log, starting=middle), "second", totals())
    located = lookup.provinces_of_sums(totals(), fixtures.provinces(spark, sf_dir), "inner")
    return located.groupBy("weekday", "hour", "province").agg(F.sum("failures").alias("failures"))


def stream_province_day_closing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running volume per province and day; a day's state goes when one that ends two days later is seen."""
    folder = new_folder(spark, "closing")
    orders = prepare.parse_orders(_stream(spark, sf_dir, "event_id"), S.NOTIFY_RULES)
    facts = metrics.order_facts(orders).select(
        F.expr("CAST(day + INTERVAL 1 DAY AS TIMESTAMP)").alias("day_end"), "province_code", "orders", F.col("fee_all").alias("fee_total")
    )
    sums = state.closing_sums(facts, ("day_end", "province_code"), ("orders", "fee_total"), "day_end", "2 days")
    with settings(spark, state.STATE_STORE):
        run_to_end(sums, running.folder_sink(folder), f"{folder}/checkpoint", "update", state_partitions=4)
    newest = batches.newest_per_key(batches.read_batches(spark, folder), "day_end", "province_code")
    named = lookup.provinces_of_sums(newest, fixtures.provinces(spark, sf_dir), "inner")
    day = F.date_format(F.col("day_end") - F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd")
    return named.select(day.alias("day"), "province", "orders", "fee_total", "closed")


def stream_late_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes of a log in which every tenth message comes ten days late, every batch delivered twice."""
    order = "unix_seconds(CAST(ts AS TIMESTAMP)) + IF(event_id % 10 = 0, 864000, 0)"
    orders = prepare.parse_orders(_stream(spark, sf_dir, order), S.NOTIFY_RULES)
    volume = late.volume_with_late(
        metrics.order_facts(orders), new_folder(spark, "late"), "1 minute", dt.timedelta(hours=2), deliveries=2
    )
    named = lookup.provinces_of_sums(volume, fixtures.provinces(spark, sf_dir), "inner")
    sums = [F.sum(c).alias(c) for c in ("orders", "fee_total", "late_orders", "late_fee")]
    return _shown_slot(named.groupBy(F.col("slot_start").alias("minute_start"), "province").agg(*sums), "minute_start")


class _Interrupted(RuntimeError):
    """Raised by ``stream_restart_resume`` to break its own query."""


def stream_restart_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Break a query after a batch is written but before it is committed, and restart.

    The restarted query delivers that batch again; state and result folder must
    come out as if nothing had happened.
    """
    folder = new_folder(spark, "restart")
    failures = metrics.failures_weekday_hour_province(_notify_province_stream(spark, sf_dir))
    write = running.folder_sink(folder)

    def write_then_break(rows: DataFrame, batch_id: int) -> None:
        write(rows, batch_id)
        if batch_id == 1:
            raise _Interrupted("stopped between write and commit")

    run = partial(run_to_end, failures, checkpoint=f"{folder}/checkpoint", mode="update")
    try:
        run(write_then_break)
    except Exception as stopped:
        if "stopped between write and commit" not in str(stopped):
            raise
    run(write)
    history = batches.read_batches(spark, folder)
    return _named(spark, sf_dir, batches.newest_per_key(history, "weekday", "hour", "province"))


# --- sinks -------------------------------------------------------------------


def sink_keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed upsert of running values, every batch delivered twice."""
    volume = metrics.weekday_hour_volume(_notify_stream(spark, sf_dir))
    history = running.touched_keys(spark, volume, new_folder(spark, "upsert"), deliveries=2)
    newest = batches.running_totals(history, "weekday", "hour")
    key = display_key(F.col("weekday"), F.col("hour"))
    return newest.select(key.alias("dayhour"), "orders", "fee_total")


def sink_additive_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters per day from increments, every batch delivered twice."""
    history = running.increments(
        spark,
        _notify_stream(spark, sf_dir),
        metrics.daily_totals,
        new_folder(spark, "counters"),
        deliveries=2,
    )
    return metrics.daily_rates(batches.counter_sums(history, "day"))


def sink_compacted_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report folded while it runs, with a batch delivered again before and after folding."""
    folder = new_folder(spark, "compacted")
    report, dimension = jobs.NotifyReport(), fixtures.provinces(spark, sf_dir)

    def on_batch(rows: DataFrame, batch_id: int) -> None:
        jobs.write_increments(report, rows, dimension, folder, batch_id)
        if batch_id == 2:
            jobs.write_increments(report, rows, dimension, folder, batch_id)
            jobs.fold_report(spark, report, folder)
            jobs.write_increments(report, rows, dimension, folder, batch_id)

    run_to_end(_stream(spark, sf_dir), on_batch, f"{folder}/checkpoint")
    jobs.fold_report(spark, report, folder)
    return report.views(spark, folder)["daily_overview"]


def sink_partition_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written partition by partition, every batch delivered twice."""
    folder = new_folder(spark, "partitions")
    orders = prepare.parse_orders(_stream(spark, sf_dir), S.ALL_ORDERS_RULES)

    def twice(rows: DataFrame, batch_id: int) -> None:
        for _ in range(2):
            partitions.write_partitions(rows, folder, batch_id, batches.current_run(rows.sparkSession))

    run_to_end(orders, twice, f"{folder}/checkpoint")
    return _shown_orders(partitions.read_partitions(spark, folder, S.ORDER_SCHEMA))


def sink_append_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running failures appended by every batch; the last row per key is returned."""
    orders = prepare.parse_orders(_stream(spark, sf_dir), S.ALL_ORDERS_RULES)
    failures = metrics.failures_province_hour(_by_code(orders))
    history = running.touched_keys(spark, failures, new_folder(spark, "history"), deliveries=2)
    return _named(spark, sf_dir, batches.running_totals(history, "province", "hour"))


# --- offsets -----------------------------------------------------------------


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offsets.offset_ranges(fixtures.positions(spark, sf_dir), "batch_id")


def offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranges(spark, sf_dir)


def offset_ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = fixtures.ledger(_ranges(spark, sf_dir))
    return offsets.saved_offsets(ledger, fixtures.MAIN_GROUP, "orders")


def offset_ledger_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = fixtures.ledger(_ranges(spark, sf_dir))
    return offsets.saved_offsets(ledger, fixtures.BEHIND_GROUP)


def offset_resume_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger against the log it points into; the log is numbered once."""
    folder = new_folder(spark, "log")
    fixtures.positions(spark, sf_dir).write.parquet(folder)
    log = spark.read.parquet(folder)
    ledger = fixtures.ledger(offsets.offset_ranges(log, "batch_id"))
    saved = offsets.saved_offsets(ledger, fixtures.BEHIND_GROUP)
    return offsets.resume_plan(saved, fixtures.earliest_offsets(fixtures.retained(log)))


def offset_resume_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger and log that differ: one partition was never saved, and one is gone from the log."""
    placed = fixtures.positions(spark, sf_dir)
    ledger = fixtures.ledger(offsets.offset_ranges(placed, "batch_id")).filter("NOT (topic = 'orders' AND partition = 1)")
    held = fixtures.retained(placed).filter("NOT (topic = 'orders_failed' AND partition = 2)")
    saved = offsets.saved_offsets(ledger, fixtures.BEHIND_GROUP)
    return offsets.resume_positions(saved, fixtures.earliest_offsets(held), ["orders", "orders_failed"])


def offset_ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger kept by a stream itself, every batch delivered twice."""
    history = running.increments(
        spark,
        _stream(spark, sf_dir),
        offsets.offset_ranges,
        new_folder(spark, "ledger"),
        deliveries=2,
    )
    ledger = history.withColumn("grp", F.lit(fixtures.MAIN_GROUP))
    return offsets.saved_offsets(ledger, fixtures.MAIN_GROUP)


QUERIES: dict[str, Query] = {
    "daily_overview": daily_overview,
    "parse_orders": parse_orders,
    "notify_orders": notify_orders,
    "rejected_orders": rejected_orders,
    "daily_rejected": daily_rejected,
    "rejected_trailing_text": rejected_trailing_text,
    "daily_unknown_codes": daily_unknown_codes,
    "province_dimension": province_dimension,
    "offline_orders_scan": offline_orders_scan,
    "province_lookup": province_lookup,
    "unknown_province_codes": unknown_province_codes,
    "order_time_keys": order_time_keys,
    "order_durations": order_durations,
    "failures_weekday_hour_province": _over(
        _province_facts(_NOTIFY, "weekday", "hour"), metrics.failures_weekday_hour_province
    ),
    "weekday_hour_volume": weekday_hour_volume,
    "top10_province_orders": _over(_province_facts(_NOTIFY), leaders.top_provinces_by_orders),
    "province_day_throughput_literal": _over(
        _province_facts(_NOTIFY, "day"), metrics.province_day_throughput_literal
    ),
    "province_minute_volume": province_minute_volume,
    "province_hour_volume": province_hour_volume,
    "global_overview": _over(_province_facts(_ALL), metrics.global_overview),
    "failures_province_hour": _over(_province_facts(_ALL, "hour"), metrics.failures_province_hour),
    "province_orders": _over(_province_facts(_ALL), metrics.province_orders),
    "province_successes": _over(_province_facts(_ALL), metrics.province_successes),
    "province_success_join": _over(_province_facts(_ALL), metrics.province_success_join),
    "top10_province_success": top10_province_success,
    "bottom10_province_success": bottom10_province_success,
    "hourly_success_volume": _over(_province_facts(_ALL, "hour"), metrics.hourly_success_volume),
    "province_minute_of_day_success": _over(
        _province_facts(_ALL, "hour", "minute"), metrics.province_minute_of_day_success
    ),
    "province_failure_rate": _from_daily_report("province_failure_rate"),
    "daily_province_failures": _from_daily_report("daily_province_failures"),
    "top3_failures": _from_daily_report("top3_failures"),
    "top3_failures_per_day": _from_daily_report("top3_failures_per_day"),
    "stream_orders_ingest": stream_orders_ingest,
    "stream_failures_update": stream_failures_update,
    "stream_weekday_hour_update": stream_weekday_hour_update,
    "stream_province_day_volume": stream_province_day_volume,
    "stream_province_hour_windows": stream_province_hour_windows,
    "stream_province_minute_windows": stream_province_minute_windows,
    "stream_reseed": stream_reseed,
    "stream_from_positions": stream_from_positions,
    "stream_running_reseed": stream_running_reseed,
    "stream_province_day_closing": stream_province_day_closing,
    "stream_late_minutes": stream_late_minutes,
    "stream_hourly_complete": stream_hourly_complete,
    "stream_top10_complete": stream_top10_complete,
    "stream_daily_overview": stream_daily_overview,
    "stream_fanout": stream_fanout,
    "stream_restart_resume": stream_restart_resume,
    "sink_keyed_upsert": sink_keyed_upsert,
    "sink_additive_counters": sink_additive_counters,
    "sink_compacted_views": sink_compacted_views,
    "sink_partition_output": sink_partition_output,
    "sink_append_history": sink_append_history,
    "offset_ranges": offset_ranges,
    "offset_ledger_latest": offset_ledger_latest,
    "offset_ledger_by_group": offset_ledger_by_group,
    "offset_resume_plan": offset_resume_plan,
    "offset_resume_positions": offset_resume_positions,
    "offset_ledger_append": offset_ledger_append,
}
