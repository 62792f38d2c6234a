import datetime as dt
import json

import pytest
from builders import as_set, dimension, message, messages, records
from test_streaming import NAMES, land, order

from pyspark.sql import functions as F

from orderflow import __main__ as cli
from orderflow import schema as S
from orderflow.operators import leaders, lookup, metrics, prepare
from orderflow.plans import jobs
from orderflow.sinks import batches
from orderflow.sources.messages import landed_messages
from orderflow.sources.positions import write_log

TEXTS = [
    [order("1", 0), order("1", 0, "1001"), order("2", 5, fee=7), "nope"],
    [order("1", 0, "1001"), order("9", 1), message(**{S.SERVICE: "other", S.PROVINCE_CODE: "2"})],
    [order("2", 5), order("2", 6, day="20240102"), order("8", 6), message(**{S.FEE: "x"})],
]


@pytest.fixture
def landed(spark, tmp_path):
    folder = str(tmp_path / "landed")
    land(spark, folder, *TEXTS)
    return folder


def batch_facts(spark, rules):
    everything = messages(spark, *[text for texts in TEXTS for text in texts])
    orders = prepare.parse_orders(everything, rules)
    return metrics.order_facts(lookup.attach_province(orders, dimension(spark, NAMES)))


def run(spark, report, landed, out):
    stream = landed_messages(spark, landed, 1)
    query = jobs.start_report(report, stream, dimension(spark, NAMES), out, interval=None)
    query.awaitTermination()


def test_notify_report_equals_the_batch(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    report = jobs.NotifyReport()
    run(spark, report, landed, out)
    views = report.views(spark, out)
    facts = batch_facts(spark, S.NOTIFY_RULES)
    for name, metric in {
        "daily_overview": metrics.daily_overview,
        "failures_weekday_hour_province": metrics.failures_weekday_hour_province,
        "top10_province_orders": leaders.top_provinces_by_orders,
        "weekday_hour_volume": metrics.weekday_hour_volume,
        "province_minute_volume": metrics.province_minute_volume,
        "province_hour_volume": metrics.province_hour_volume,
        "province_day_volume": metrics.province_day_volume,
    }.items():
        assert as_set(views[name]) == as_set(metric(facts)), name
    # The last batch had no order of the north, so its row stays as it was.
    assert as_set(views["top10_of_last_batches"]) == {("North", 1, 0.0), ("South", 2, 1.0)}
    assert as_set(
        batches.counter_sums(batches.read_batches(spark, out, "unknown_codes"), "province_code")
    ) == {("9", 1), ("8", 1)}
    rejected = batches.read_batches(spark, out, "rejected").select("value", "reason")
    assert as_set(rejected) == {
        ("nope", "unreadable"),
        (message(**{S.FEE: "x"}), "bad_fee"),
    }


def test_all_orders_report_equals_the_batch(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    report = jobs.AllOrdersReport()
    run(spark, report, landed, out)
    views = report.views(spark, out)
    facts = metrics.known_province(batch_facts(spark, S.ALL_ORDERS_RULES))
    for name, metric in {
        "global_overview": metrics.global_overview,
        "failures_province_hour": metrics.failures_province_hour,
        "top10_province_success": leaders.province_success_board,
        "hourly_success_volume": metrics.hourly_success_volume,
        "province_minute_of_day_success": metrics.province_minute_of_day_success,
    }.items():
        assert as_set(views[name]) == as_set(metric(facts)), name


def test_a_report_survives_a_break_in_the_middle_of_a_batch(
    spark, landed, tmp_path, monkeypatch
):
    out = str(tmp_path / "out")
    report = jobs.NotifyReport()
    whole = batches.Manifest.append

    def breaking(held, entry):
        if entry["batch"] == 1:
            raise RuntimeError("lost the driver")
        whole(held, entry)

    monkeypatch.setattr(batches.Manifest, "append", breaking)
    with pytest.raises(Exception, match="lost the driver"):
        run(spark, report, landed, out)
    monkeypatch.setattr(batches.Manifest, "append", whole)
    run(spark, report, landed, out)
    facts = batch_facts(spark, S.NOTIFY_RULES)
    views = report.views(spark, out)
    assert as_set(views["daily_overview"]) == as_set(metrics.daily_overview(facts))
    assert as_set(views["weekday_hour_volume"]) == as_set(metrics.weekday_hour_volume(facts))


def test_the_ledger_of_a_report_seeds_a_new_query(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    report = jobs.NotifyReport()
    run(spark, report, landed, out)
    earliest = spark.createDataFrame(
        [("t", 0, 0), ("t", 1, 99)], "topic string, partition int, earliest_offset bigint"
    )
    offsets = json.loads(jobs.resume_offsets(spark, report, out, earliest))
    assert offsets == {"t": {"0": 4, "1": 99, "2": 4}}


def test_daily_report(spark):
    texts = [order("1", 0), order("1", 1, "1001"), order("2", 1, "1"), order("9", 1, "1"), "nope"]
    results = prepare.parse_day_results(messages(spark, *texts))
    facts = jobs.daily_facts(results, dimension(spark, NAMES))
    views = jobs.daily_results(facts)
    assert as_set(views["daily_province_failures"]) == {
        ("20240101", "North", 1, 2, 0.5),
        ("20240101", "South", 1, 1, 1.0),
    }
    assert as_set(views["province_failure_rate"]) == {("North", 1, 2, 0.5), ("South", 1, 1, 1.0)}
    assert views["top3_failures"].count() == 2
    assert views["top3_failures_per_day"].count() == 2


def test_command_line(spark, landed, tmp_path):
    names = tmp_path / "dimension.txt"
    names.write_text("1 North\n2 South\n", encoding="utf-8")
    lines = tmp_path / "lines.txt"
    lines.write_text("\n".join(TEXTS[0]), encoding="utf-8")
    daily = ["daily", "--messages", str(lines), "--dimension", str(names)]
    for run_id in ("20240102", "20240102", "20240103"):
        cli.run(
            spark, cli.arguments([*daily, "--run", run_id, "--out", str(tmp_path / "daily")])
        )
    read = lambda name: batches.read_batches(spark, str(tmp_path / "daily"), name).withColumn(
        "batch_id", F.col("batch_id") % batches.BATCHES_PER_RUN
    )
    top = read("top3_failures")
    assert top.count() == 4
    assert as_set(top.filter("batch_id = 20240103").select("day", "province", "failures")) == {
        ("20240101", "North", 1),
        ("20240101", "South", 0),
    }
    rejected = read("rejected").filter("batch_id = 20240103").select("value", "reason")
    assert as_set(rejected) == {("nope", "unreadable")}
    rates = read("province_failure_rate")
    assert as_set(rates.filter("batch_id = 20240103").drop("batch_id")) == {
        ("North", 1, 2, 0.5),
        ("South", 0, 1, 0.0),
    }
    out = str(tmp_path / "report")
    report = ["all-orders", "--landed", landed, "--dimension", str(names), "--once"]
    cli.run(spark, cli.arguments([*report, "--out", out]))
    overview = jobs.AllOrdersReport().views(spark, out)["global_overview"]
    assert overview.first()["orders"] == 7
    assert cli.arguments(["notify", "--brokers", "h:1", "--out", "x"]).topics == "recharge"


def test_minutes_of_a_report_are_timestamps(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    run(spark, jobs.NotifyReport(), landed, out)
    minutes = jobs.NotifyReport().views(spark, out)["province_minute_volume"]
    assert minutes.filter("province = 'South'").agg({"minute_start": "max"}).first()[
        0
    ] == dt.datetime(2024, 1, 2, 6)


def test_a_new_query_adds_to_the_old_results(spark, tmp_path):
    first, second, out = (str(tmp_path / name) for name in ("first", "second", "out"))
    land(spark, first, [order("1", 0)] * 5)
    land(spark, second, [order("2", 1)] * 3)
    report, names = jobs.AllOrdersReport(), dimension(spark, NAMES)
    for folder in (first, second):
        stream = landed_messages(spark, folder, 1)
        jobs.start_report(
            report, stream, names, out, interval=None, checkpoint=f"{out}/of-{folder[-6:].strip('/')}"
        ).awaitTermination()
    views = report.views(spark, out)
    assert views["global_overview"].first()["orders"] == 8
    assert as_set(views["top10_of_every_batch"].select("province", "orders")) == {("North", 5), ("South", 3)}


def test_reports_fold_while_they_run(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    report = jobs.NotifyReport()
    stream = landed_messages(spark, landed, 1)
    jobs.start_report(report, stream, dimension(spark, NAMES), out, interval=None, fold_every=2).awaitTermination()
    assert batches.published(spark, out).fold == 1
    facts = batch_facts(spark, S.NOTIFY_RULES)
    assert as_set(report.views(spark, out)["daily_overview"]) == as_set(metrics.daily_overview(facts))


def test_every_message_of_the_daily_report_is_accounted_for(spark, tmp_path):
    texts = [order("1", 0), order("9", 0), "nope", message(**{S.REQUEST_ID: "abcdefghij"}), message(**{S.REQUEST_ID: "  20240101"})]
    out = str(tmp_path)
    jobs.write_daily_report(messages(spark, *texts), dimension(spark, NAMES), out, 1)
    read = lambda name: batches.read_batches(spark, out, name)
    counted = read("daily_province_failures").agg(F.sum("orders")).first()[0]
    unknown = read("unknown_codes").agg(F.sum("orders")).first()[0]
    assert counted + unknown + read("rejected").count() == len(texts)
    assert {r.reason for r in read("rejected").collect()} == {"unreadable", "bad_day"}


def test_a_report_resumes_in_a_log_by_its_ledger(spark, tmp_path):
    """The second query has no checkpoint and a partition that the first one did not know."""
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    common = ["all-orders", "--log", log, "--out", out, "--once"]
    place = lambda partition, first, texts: records(spark, *[(t, "t", partition, first + n) for n, t in enumerate(texts)])
    write_log(place(0, 0, [order("1", 0)] * 5), log, 3)
    cli.run(spark, cli.arguments([*common, "--checkpoint", f"{out}/one"]))
    write_log(place(0, 5, [order("2", 1)] * 2).union(place(1, 0, [order("2", 1)] * 4)), log, 3)
    cli.run(spark, cli.arguments([*common, "--checkpoint", f"{out}/two", "--resume"]))
    report = jobs.AllOrdersReport()
    assert batches.read_batches(spark, out, "offsets").agg(F.sum(F.expr("until_offset - from_offset"))).first()[0] == 11
    saved = {(r.partition, r.saved_offset) for r in jobs.saved_positions(spark, report, out).collect()}
    assert saved == {(0, 7), (1, 4)}


def test_a_running_report_prunes_what_it_folds(spark, landed, tmp_path):
    out = str(tmp_path / "out")
    report = jobs.NotifyReport()
    stream = landed_messages(spark, landed, 1)
    jobs.start_report(report, stream, dimension(spark, NAMES), out, interval=None, fold_every=1, grace_seconds=0).awaitTermination()
    facts = batch_facts(spark, S.NOTIFY_RULES)
    assert as_set(report.views(spark, out)["daily_overview"]) == as_set(metrics.daily_overview(facts))
    assert len(list((tmp_path / "out" / "data").glob("run=*/batch=*/attempt=*"))) <= 1
