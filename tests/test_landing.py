import datetime as dt

from orderflow.sources import fixtures
from orderflow.sources.messages import landed_messages
from orderflow.streaming.run import run_to_end

# Seconds of the messages: many, one, none and a few in the quarters of the time that they span.
QUARTERS = ([*range(0, 24)] * 2, [30], [], [99, 100])


def test_files_follow_messages_and_batches_stay_apart(spark, tmp_path):
    table = str(tmp_path / "sf")
    begin = dt.datetime(2024, 1, 1)
    seconds = [s for quarter in QUARTERS for s in quarter]
    rows = [(i, begin + dt.timedelta(seconds=s), "view", 1.0, '{"k": 1}') for i, s in enumerate(seconds)]
    spark.createDataFrame(rows, fixtures.EVENTS).coalesce(1).write.parquet(f"{table}/events.parquet")

    folder, files = fixtures.land(spark, table, order="unix_seconds(CAST(ts AS TIMESTAMP))", per_file=4)
    assert files == 4  # 51 messages, 16 to a file of each batch
    assert len(spark.read.parquet(folder).inputFiles()) == 4 * len(QUARTERS)

    seen = {}
    on_batch = lambda rows, n: seen.setdefault(n, {int(r["key"]) for r in rows.collect()})
    run_to_end(landed_messages(spark, folder, files), on_batch, str(tmp_path / "checkpoint"))
    ids = iter(range(len(seconds)))
    assert seen == {n: {next(ids) for _ in quarter} for n, quarter in enumerate(QUARTERS)}
