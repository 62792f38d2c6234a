"""Run a job from the command line: ``python -m orderflow JOB ...``."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from orderflow.plans import jobs
from orderflow.sources.dimension import read_province_dimension
from orderflow.sources.messages import (
    kafka_messages,
    kafka_options,
    landed_messages,
    text_messages,
)
from orderflow.sources.positions import earliest_offsets, log_stream
from orderflow.sources.provinces import provinces

REPORTS = {"notify": jobs.NotifyReport, "all-orders": jobs.AllOrdersReport}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="orderflow", description=__doc__)
    jobs_of = parser.add_subparsers(dest="job", required=True)
    for name in REPORTS:
        report = jobs_of.add_parser(name, help="streaming report")
        source = report.add_mutually_exclusive_group(required=True)
        source.add_argument("--brokers", help="Kafka brokers, host:port,...")
        source.add_argument("--landed", help="folder of landed message files")
        source.add_argument("--log", help="log of messages by topic, partition and segment")
        report.add_argument("--topics", default="recharge", help="topics, comma separated")
        report.add_argument("--starting-offsets", help="JSON, for a query with no checkpoint yet")
        report.add_argument("--checkpoint", help="of the query; inside --out if left out")
        report.add_argument(
            "--resume-from",
            help="parquet of topic, partition, earliest_offset: start a new query at the saved offsets in --out",
        )
        report.add_argument("--resume", action="store_true", help="with --log: start a new query at the saved offsets in --out")
        report.add_argument(
            "--max-offsets-per-trigger", type=int, default=5_000_000, help="messages a batch takes at most"
        )
        report.add_argument(
            "--allow-data-loss", action="store_true", help="go on when the broker has dropped unread messages"
        )
        report.add_argument("--fold-every", type=int, default=jobs.FOLD_EVERY, help="batches")
        report.add_argument("--files-per-batch", type=int, default=1000)
        report.add_argument("--interval", default="5 seconds")
        report.add_argument("--once", action="store_true", help="take what is there and stop")
        _common(report)
    daily = jobs_of.add_parser("daily", help="daily report over a file of messages")
    daily.add_argument("--messages", required=True, help="text, one message per line")
    daily.add_argument(
        "--run",
        type=int,
        default=int(date.today().strftime("%Y%m%d")),
        help="number of this run; a repeated run replaces its results",
    )
    _common(daily)
    return parser.parse_args(argv)


def _common(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--dimension", help="text of 'code name' lines; built in if left out")
    parser.add_argument("--out", required=True, help="result folder, shared by all executors")
    parser.add_argument("--time-zone", default="UTC", help="of days, hours and minutes")


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    # Keys of days, hours and minutes follow the session's zone.
    spark.conf.set("spark.sql.session.timeZone", args.time_zone)
    names = read_province_dimension(spark, args.dimension) if args.dimension else provinces(spark)
    if args.job == "daily":
        jobs.write_daily_report(text_messages(spark, args.messages), names, args.out, args.run)
        return
    interval = None if args.once else args.interval
    report = REPORTS[args.job]()
    stream = _stream(spark, args, report)
    jobs.start_report(
        report, stream, names, args.out, interval, args.checkpoint, args.fold_every
    ).awaitTermination()


def _stream(spark: SparkSession, args: argparse.Namespace, report: jobs.Report) -> DataFrame:
    if args.landed:
        return landed_messages(spark, args.landed, args.files_per_batch)
    start = args.starting_offsets
    if args.log:
        if args.resume:
            start = jobs.resume_offsets(spark, report, args.out, earliest_offsets(spark, args.log), all_listed=True)
        return log_stream(spark, args.log, start, limit=None if args.once else args.max_offsets_per_trigger)
    if args.resume_from:
        start = jobs.resume_offsets(spark, report, args.out, spark.read.parquet(args.resume_from))
    options = kafka_options(
        args.brokers,
        args.topics.split(","),
        start,
        args.max_offsets_per_trigger,
        not args.allow_data_loss,
    )
    return kafka_messages(spark, options)


if __name__ == "__main__":
    run(SparkSession.builder.appName("orderflow").getOrCreate(), arguments())
