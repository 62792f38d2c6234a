"""Number the rows of each group in order, however large a group is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.llm.tables import kept_table, small_side


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """Add ``idx`` (from 0, within ``group``, by ``order``) and ``n``, the size of the group.

    Rows are sorted over ranges of (group, order), so a large group is many tasks. A range's rows are
    numbered where they lie, and shifted by the counts of the ranges before it: one row for each range
    and group. Equal rows are told apart by where they were read, so that they are many ranges too.
    ``group`` holds no null.
    """
    kept = kept_table(
        rows.withColumn("_read", F.monotonically_increasing_id())
        .repartitionByRange(group, *order, "_read")
        .sortWithinPartitions(group, *order, "_read")
        .drop("_read")
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_at", 33)),
        "numbered",
    )
    before = Window.partitionBy(group).orderBy("_range")
    shifts = (
        kept.groupBy(group, "_range")
        .agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
        .withColumn("_shift", F.sum("_rows").over(before) - F.col("_rows") - F.col("_first"))
        .withColumn("n", F.sum("_rows").over(Window.partitionBy(group)))
        .select(group, "_range", "_shift", "n")
    )
    shifts = small_side(kept_table(shifts, "ranges"))
    return (
        kept.join(shifts, [group, "_range"])
        .withColumn("idx", F.col("_at") + F.col("_shift"))
        .select(*rows.columns, "idx", "n")
    )
