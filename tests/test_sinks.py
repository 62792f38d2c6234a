import pytest
from builders import as_set
from pyspark.sql import functions as F

from orderflow.sinks import batches
from orderflow.sinks.entries import Entries
from orderflow.sources.tables import JdbcTable, read_options


def rows(spark, *values):
    return spark.createDataFrame(values, "province string, hour int, n bigint")


def test_a_batch_delivered_twice_counts_once(spark, tmp_path):
    folder = str(tmp_path / "t")
    for batch_id, batch in enumerate([[("a", 1, 2)], [("a", 1, 3), ("b", 2, 1)]]):
        for _ in range(2):
            batches.write_batch(rows(spark, *batch), folder, batch_id)
    history = batches.read_batches(spark, folder)
    assert history.count() == 3
    assert as_set(batches.counter_sums(history, "province", "hour")) == {("a", 1, 5), ("b", 2, 1)}
    assert as_set(batches.newest_per_key(history, "province", "hour")) == {
        ("a", 1, 3),
        ("b", 2, 1),
    }
    assert as_set(batches.newest_snapshot(spark, folder)) == {("a", 1, 3), ("b", 2, 1)}


def test_a_replay_may_change_the_rows_of_its_batch(spark, tmp_path):
    folder = str(tmp_path / "t")
    batches.write_batch(rows(spark, ("a", 1, 2), ("b", 1, 2)), folder, 0)
    batches.write_batch(rows(spark, ("a", 1, 7)), folder, 0)
    assert as_set(batches.read_batches(spark, folder).drop("batch_id")) == {("a", 1, 7)}


def test_counters_without_keys(spark, tmp_path):
    folder = str(tmp_path / "t")
    for batch_id in range(3):
        one = spark.createDataFrame([(1, 10)], "orders bigint, fee bigint")
        batches.write_batch(one, folder, batch_id)
    assert as_set(batches.counter_sums(batches.read_batches(spark, folder))) == {(3, 30)}


def test_an_empty_batch(spark, tmp_path):
    folder = str(tmp_path / "t")
    batches.write_batch(rows(spark, ("a", 1, 2)).limit(0), folder, 0)
    batches.write_batch(rows(spark, ("a", 1, 2)), folder, 1)
    history = batches.read_batches(spark, folder)
    assert as_set(batches.newest_per_key(history, "province", "hour")) == {("a", 1, 2)}


def test_batch_ids_order_as_numbers(spark, tmp_path):
    folder = str(tmp_path / "t")
    for batch_id in (9, 10):
        batches.write_batch(rows(spark, ("a", 1, batch_id)), folder, batch_id)
    newest = batches.newest_per_key(batches.read_batches(spark, folder), "province", "hour")
    assert as_set(newest) == {("a", 1, 10)}


def test_several_results_of_one_batch(spark, tmp_path):
    folder = str(tmp_path)
    other = spark.createDataFrame([("b", 1.5)], "province string, rate double")
    batches.publish({"x": rows(spark, ("a", 1, 2)), "y": other}, folder, 4)
    assert as_set(batches.read_batches(spark, folder, "x").drop("batch_id")) == {("a", 1, 2)}
    assert as_set(batches.read_batches(spark, folder, "y").drop("batch_id")) == {("b", 1.5)}
    with pytest.raises(ValueError, match="no batch"):
        batches.read_batches(spark, folder, "z")


def test_a_column_has_one_type(spark, tmp_path):
    other = spark.createDataFrame([(1,)], "province int")
    with pytest.raises(ValueError, match="province"):
        batches.publish({"x": rows(spark, ("a", 1, 2)), "y": other}, str(tmp_path), 0)


def test_a_failing_result_shows_nothing_of_its_batch(spark, tmp_path):
    folder = str(tmp_path)
    batches.publish({"x": rows(spark, ("a", 1, 2))}, folder, 0)
    bad = rows(spark, ("a", 1, 2)).select(F.raise_error(F.lit("broken")).alias("z"))
    with pytest.raises(Exception, match="broken"):
        batches.publish({"x": rows(spark, ("a", 1, 9)), "y": bad}, folder, 1)
    assert as_set(batches.read_batches(spark, folder, "x").drop("batch_id")) == {("a", 1, 2)}


def test_runs_stand_side_by_side(spark, tmp_path):
    folder = str(tmp_path / "t")
    for run, batch, n in (("one", 0, 5), ("one", 1, 1), ("two", 0, 3)):
        batches.write_batch(rows(spark, ("a", 1, n)), folder, batch, run)
    history = batches.read_batches(spark, folder)
    assert as_set(batches.counter_sums(history, "province", "hour")) == {("a", 1, 9)}
    assert as_set(batches.newest_per_key(history, "province", "hour")) == {("a", 1, 3)}
    assert as_set(batches.newest_snapshot(spark, folder)) == {("a", 1, 3)}


def test_folding_changes_no_view(spark, tmp_path):
    folder = str(tmp_path / "t")
    rules = {"sums": batches.Fold("sum", ("province", "hour")), "newest": batches.Fold("newest", ("province", "hour")), "last": batches.Fold("last")}

    def write(run, batch, *values):
        frame = rows(spark, *values)
        batches.publish({name: frame for name in ("sums", "newest", "last", "all")}, folder, batch, run)

    def views():
        read = lambda name: batches.read_batches(spark, folder, name)
        return (
            as_set(batches.counter_sums(read("sums"), "province", "hour")),
            as_set(batches.newest_per_key(read("newest"), "province", "hour")),
            as_set(batches.newest_snapshot(spark, folder, "last")),
            sorted(map(tuple, read("all").collect())),
        )

    assert not batches.fold(spark, folder, rules)
    for k in range(6):
        write("one", k, ("a", 1, k), ("b", k % 2, 1))
    before = views()
    assert batches.fold(spark, folder, rules) and views() == before
    write("one", 3, ("a", 1, 100))  # folded: too late
    write("one", 5, ("a", 1, 5), ("b", 1, 1))  # the newest again
    assert views() == before
    write("two", 0, ("a", 1, 7))
    write("two", 1, ("c", 1, 1))
    before = views()
    assert batches.fold(spark, folder, rules) and views() == before
    assert not batches.fold(spark, folder, rules)
    state = batches.published(spark, folder)
    assert state.fold == 2 and len(state.live) == 2 and len(before[3]) == 14


def anew(spark, folder):
    """The manifest as another process reads it."""
    return batches.Manifest(spark, folder).refresh()


def test_a_batch_published_during_a_fold_stays(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    for batch in range(3):
        batches.write_batch(rows(spark, ("a", 1, 1)), folder, batch, "one")
    put, late = batches.Manifest.append_fold, []

    def publish_between(held, entry):
        if not late:
            late.append(batches.Manifest(spark, folder))
            late[0].refresh()
            batch = rows(spark, ("a", 1, 1))
            monkeypatch.setattr(batches, "manifest", lambda *_: late[0])
            batches.write_batch(batch, folder, 3, "one")
            monkeypatch.undo()
        return put(held, entry)

    monkeypatch.setattr(batches.Manifest, "append_fold", publish_between)
    assert batches.fold(spark, folder, {"rows": batches.Fold("sum", ("province", "hour"))})
    history = batches.read_batches(spark, folder)
    assert as_set(batches.counter_sums(history, "province", "hour")) == {("a", 1, 4)}
    assert sorted(anew(spark, folder).live) == [("one", 2), ("one", 3)]


def test_only_one_of_two_folds_counts(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    for batch in range(4):
        batches.write_batch(rows(spark, ("a", 1, 1)), folder, batch, "one")
    put, second = batches.Manifest.append_fold, []

    def fold_between(held, entry):
        if not second:
            second.append(batches.Manifest(spark, folder))
            monkeypatch.setattr(batches, "manifest", lambda *_: second[0])
            assert batches.fold(spark, folder, {})
        return put(held, entry)

    monkeypatch.setattr(batches.Manifest, "append_fold", fold_between)
    assert not batches.fold(spark, folder, {})
    assert batches.read_batches(spark, folder).count() == 4 and anew(spark, folder).fold == 1


def test_two_publishers_lose_nothing(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    publishers = [batches.Manifest(spark, folder) for _ in range(2)]
    for batch in range(4):
        monkeypatch.setattr(batches, "manifest", lambda *_, n=batch: publishers[n % 2])
        batches.write_batch(rows(spark, ("a", 1, 1)), folder, batch // 2, f"run{batch % 2}")
    monkeypatch.undo()
    assert len(anew(spark, folder).live) == 4
    assert batches.read_batches(spark, folder).count() == 4


def test_a_long_history_is_rewritten_a_few_times_only(spark, tmp_path, monkeypatch):
    """Rows of rule all, folded after every batch: how often a row is written again grows with levels, not folds."""
    monkeypatch.setattr(batches, "FAN", 3)
    folder, written, together = str(tmp_path / "t"), [], batches._together

    def counting(results):
        out = together(results)
        written.append(out.count())
        return out

    for batch in range(28):
        batches.write_batch(rows(spark, ("a", 1, batch)), folder, batch, "one")
        if batch:
            monkeypatch.setattr(batches, "_together", counting)
            assert batches.fold(spark, folder, {})
            monkeypatch.setattr(batches, "_together", together)
    assert sum(written) <= 27 * 4 and max(written) == 27
    assert len(anew(spark, folder).parts["rows"]) <= 2 * 4
    history = batches.read_batches(spark, folder)
    assert sorted(r.n for r in history.collect()) == list(range(28))


def test_pruning_leaves_readers_their_files(spark, tmp_path):
    folder = str(tmp_path / "t")
    rules = {"rows": batches.Fold("sum", ("province", "hour"))}

    def files():
        return [x for x in (tmp_path / "t").rglob("*") if x.suffix in (".parquet", ".json")]

    def go_on(first, last):
        for batch in range(first, last):
            batches.write_batch(rows(spark, ("a", 1, 1)), folder, batch, "one")
        assert batches.fold(spark, folder, rules)

    go_on(0, 6)
    reader = batches.counter_sums(batches.read_batches(spark, folder), "province", "hour")
    go_on(6, 8)
    assert batches.prune(spark, folder, grace_seconds=3600) == 0
    assert as_set(reader) == {("a", 1, 6)}
    counts = []
    for k in range(3):
        go_on(8 + 2 * k, 10 + 2 * k)
        assert batches.prune(spark, folder, grace_seconds=0) > 0
        counts.append(len(files()))
        fresh = batches.counter_sums(batches.read_batches(spark, folder), "province", "hour")
        assert as_set(fresh) == {("a", 1, 10 + 2 * k)}
    assert counts[0] == counts[1] == counts[2] <= 8
    # A publisher that had read what is gone goes on behind the others.
    batches.manifest(spark, folder).state.position = 1
    batches.write_batch(rows(spark, ("a", 1, 1)), folder, 14, "one")
    assert as_set(batches.counter_sums(batches.read_batches(spark, folder), "province", "hour")) == {("a", 1, 15)}
    assert sorted(anew(spark, folder).live) == [("one", 13), ("one", 14)]


def test_running_sums_of_two_runs_add_up(spark, tmp_path):
    """A query that lost its checkpoint counts from nothing; folding changes nothing."""
    folder = str(tmp_path / "t")
    for run, batch, n in (("one", 0, 3), ("one", 1, 5), ("two", 0, 1), ("two", 1, 3)):
        batches.write_batch(rows(spark, ("a", 1, n)), folder, batch, run)
    for _ in range(2):
        assert as_set(batches.running_totals(batches.read_batches(spark, folder), "province", "hour")) == {("a", 1, 8)}
        batches.fold(spark, folder, {"rows": batches.Fold("running", ("province", "hour"))})


def test_entries_are_written_once(spark, tmp_path):
    one, two = (Entries(spark, str(tmp_path / "e")) for _ in range(2))
    assert one.put_if_absent(1, {"a": 1}) and not two.put_if_absent(1, {"a": 2}) and two.put_if_absent(2, {"é": "x"})
    assert one.read(1) == {"a": 1} and one.read(2) == {"é": "x"} and one.read(3) is None
    assert one.numbers() == [1, 2] and one.numbers(1) == [2] and len(one.names()) == 2


def test_row_keys_depend_on_the_keys_only(spark):
    keyed = batches.with_row_key(
        rows(spark, ("a", 1, 2), ("a", 1, 3), ("a", 12, 3), ("a1", 2, 3), (None, 1, 1)),
        "province",
        "hour",
    )
    keys = [r["row_key"] for r in keyed.collect()]
    assert keys[0] == keys[1]
    assert len(set(keys)) == 4
    assert len(keys[0]) == 64


def test_replays_in_a_store_are_dropped_on_read(spark):
    history = spark.createDataFrame(
        [("a", 1, 0), ("a", 1, 0), ("a", 1, 1)], "province string, n bigint, batch_id bigint"
    )
    once = batches.without_replays(history, "province")
    assert as_set(batches.counter_sums(once, "province")) == {("a", 2)}


def test_store_options():
    table = JdbcTable("jdbc:x://h/db", "t", {"user": "u"})
    assert table.options() == {"url": "jdbc:x://h/db", "dbtable": "t", "user": "u"}
    split = read_options(table, "id", (1, 100), 4)
    assert split["numPartitions"] == "4" and split["upperBound"] == "100"
    assert read_options(table) == table.options()
