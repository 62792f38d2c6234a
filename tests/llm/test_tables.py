from pyspark.sql import functions as F

from orderflow.llm import tables


def test_size_counts_rows_texts_and_lists(spark):
    rows = spark.createDataFrame(
        [(1, "abc", [1, 2, 3], [("é", 1)]), (None, None, None, None)], "id long, t string, l array<long>, s array<struct<a: string, b: long>>"
    )
    assert tables.memory_size(rows.select("id")) == 2 * 24
    assert tables.memory_size(rows.select("id", "t")) == 2 * 32 + 3
    assert tables.memory_size(rows.select("l")) == 2 * 24 + 24
    assert tables.memory_size(rows.select("s")) == 2 * 24 + 8 + 16 + 2
    assert tables.memory_size(rows.limit(0)) == 0


def test_wide_rows_are_not_broadcast(spark):
    few = spark.range(10).withColumn("text", F.repeat(F.lit("x"), 1000))
    assert "broadcast" in tables.small_side(few)._jdf.queryExecution().logical().toString().lower()
    plan = tables.small_side(few, limit=9_000)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in plan
