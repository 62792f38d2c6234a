"""The physical plans are the ones meant: no Python, no needless shuffles or scans."""

import contextlib
import io
import re

import pytest

from orderflow import schema as S
from orderflow.operators import lookup, metrics, prepare
from orderflow.plans.queries import QUERIES
from orderflow.session import local_session, new_folder, settings, shared_folder
from orderflow.sinks import batches
from orderflow.sources import fixtures

SF_DIR = "/root/testdata/sf0.001"

BATCH = [n for n in QUERIES if not n.startswith(("stream_", "sink_", "offset_ledger_append"))]


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Messages as a landed table, so plans show the operators alone."""
    folder = str(tmp_path_factory.mktemp("plans") / "messages")
    fixtures.messages(spark, SF_DIR).write.parquet(folder)
    return spark.read.parquet(folder)


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cartesian_product(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for unwanted in ("Python", "Pandas", "Cartesian", "NestedLoop", "CollectLimit"):
        assert unwanted not in text


def test_text_is_parsed_once_and_nothing_else_is_read(spark, stored):
    facts = metrics.order_facts(prepare.parse_orders(stored, S.NOTIFY_RULES))
    text = plan(metrics.daily_overview(facts))
    assert text.count("Generate json_tuple") == 1
    assert text.count("make_timestamp(") == 2
    assert text.count("Exchange") == 1
    assert text.count("partial_sum") > 0
    assert "ReadSchema: struct<value:string>" in text


def test_the_service_filter_runs_before_times_are_parsed(spark, stored):
    text = plan(prepare.parse_orders(stored, S.NOTIFY_RULES))
    service = text.index("Filter (isnotnull(service_name")
    assert text.index("Generate inline") < service < text.index("json_tuple")
    assert len(re.findall(r"\*\(1\) (Project|Filter|Generate)", text)) == 5


def test_single_orders_are_salted_for_a_large_dimension(spark, stored):
    orders = prepare.parse_orders(stored, S.ALL_ORDERS_RULES)
    names = fixtures.provinces(spark, SF_DIR)
    assert "BroadcastHashJoin" in plan(lookup.attach_province(orders, names))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        large = plan(lookup.attach_province(orders, names))
    assert re.search(r"hashpartitioning\(province_code#\d+, salt#\d+", large)
    assert "rand(" not in large


def test_metrics_look_provinces_up_after_summing(spark):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        for name in ("failures_province_hour", "province_minute_volume", "top3_failures"):
            text = plan(QUERIES[name](spark, SF_DIR))
            assert text.index("Join") < text.rindex("functions=[partial_sum"), name
            assert "salt" not in text


def test_unknown_codes_are_counted_before_the_join(spark, stored):
    orders = prepare.parse_orders(stored, S.ALL_ORDERS_RULES)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(lookup.unknown_province_codes(orders, fixtures.provinces(spark, SF_DIR)))
    assert text.index("Join") < text.index("partial_count")


def test_keyed_views_use_hash_aggregates(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1, 2.0)], "province string, n bigint, r double")
    batches.write_batch(rows, str(tmp_path / "t"), 0)
    view = batches.newest_per_key(batches.read_batches(spark, str(tmp_path / "t")), "province")
    assert "SortAggregate" not in plan(view)


def test_boards_take_the_top_without_a_full_sort(spark):
    for name in ("top10_province_orders", "top3_failures", "bottom10_province_success"):
        assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF_DIR))


def test_the_overview_has_one_exchange(spark, stored):
    facts = metrics.order_facts(prepare.parse_orders(stored, S.ALL_ORDERS_RULES))
    assert plan(metrics.global_overview(facts)).count("Exchange") == 1


class _Session:
    """As much of a session as ``shared_folder`` looks at."""

    def __init__(self, master, **conf):
        self.conf = conf
        context = {"master": master, "applicationId": f"test-{master}"}
        self.sparkContext = type("Context", (), context)()


def test_the_shared_folder_comes_from_the_session():
    cluster = _Session("spark://host:7077", **{"spark.checkpoint.dir": "s3a://bucket/work/"})
    assert shared_folder(cluster) == "s3a://bucket/work"
    first, second = new_folder(cluster, "x"), new_folder(cluster, "x")
    assert first.startswith("s3a://bucket/work/orderflow/x-") and first != second


def test_a_local_folder_is_for_local_runs_only():
    local = _Session("local[2]")
    assert shared_folder(local) == shared_folder(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_Session("spark://host:7077"))


def test_local_session_is_pinned_to_utc(spark):
    assert local_session().conf.get("spark.sql.session.timeZone") == "UTC"
