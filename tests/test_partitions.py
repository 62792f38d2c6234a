import json

import pytest
from builders import as_set
from pyspark.sql import functions as F

from orderflow.sinks import partitions

FIELDS = "province string, n bigint, at timestamp, day date, ok boolean, fee int"


def rows(spark, low, high, parts=3):
    made = spark.range(low, high, 1, parts).selectExpr(
        "if(id % 4 = 0, null, concat('p', id % 3)) as province", "id as n", "timestamp_millis(id) as at", "date_add(date'2024-01-01', int(id % 9)) as day",
        "id % 2 = 0 as ok", "int(id) as fee",
    )
    return made


def commits(tmp_path):
    return [json.loads(x.read_text()) for x in sorted((tmp_path / "out" / "commits").glob("*.json"))]


def test_a_batch_delivered_twice_counts_once(spark, tmp_path):
    folder = str(tmp_path / "out")
    for batch, (low, high) in enumerate(((0, 10), (10, 10), (10, 25))):
        for _ in range(2):
            partitions.write_partitions(rows(spark, low, high), folder, batch)
    read = partitions.read_partitions(spark, folder, rows(spark, 0, 1).schema)
    assert as_set(read) == as_set(rows(spark, 0, 25)) and read.count() == 25
    assert [x["rows"] for x in commits(tmp_path)] == [10, 0, 15]
    # What came again left no files.
    assert len(list((tmp_path / "out" / "files").glob("*.parquet"))) == 6


def test_runs_that_count_from_nothing_stand_side_by_side(spark, tmp_path):
    folder = str(tmp_path / "out")
    for run in ("one", "two"):
        partitions.write_partitions(rows(spark, 0, 5), folder, 0, run)
    assert partitions.read_partitions(spark, folder, rows(spark, 0, 1).schema).count() == 10


def test_a_failing_task_commits_nothing(spark, tmp_path):
    folder = str(tmp_path / "out")
    bad = rows(spark, 0, 30).withColumn("n", F.when(F.col("n") == 25, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("n")))
    with pytest.raises(Exception, match="broken"):
        partitions.write_partitions(bad, folder, 0)
    assert partitions.read_partitions(spark, folder, rows(spark, 0, 1).schema).count() == 0
    partitions.write_partitions(rows(spark, 0, 30), folder, 0)
    assert partitions.read_partitions(spark, folder, rows(spark, 0, 1).schema).count() == 30


def test_a_stream_writes_its_batches(spark, tmp_path):
    landed, folder = str(tmp_path / "in"), str(tmp_path / "out")
    for low in (0, 10, 20):
        rows(spark, low, low + 10, 1).write.mode("append").parquet(landed)
    stream = spark.readStream.schema(FIELDS).option("maxFilesPerTrigger", 1).parquet(landed)
    partitions.stream_partitions(stream, folder, str(tmp_path / "c"))
    partitions.stream_partitions(stream, folder, str(tmp_path / "c"))
    assert as_set(partitions.read_partitions(spark, folder, rows(spark, 0, 1).schema)) == as_set(rows(spark, 0, 30))
    assert [x["rows"] for x in commits(tmp_path)] == [10, 10, 10]
