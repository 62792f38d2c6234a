"""Order messages, broker records and offset ledgers made from the test tables.

The mapping from ``events`` is fixed and row by row, so the same results can be
stated in SQL over the table itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderflow import schema as S
from orderflow.session import new_folder
from orderflow.sources.dimension import dimension_from_table

EVENTS = "event_id bigint, ts timestamp_ntz, event_type string, value double, props string"
NATION = "n_nationkey int, n_name string"
PARTITIONS = 3
BATCH_ROWS = 1000  # messages per batch in the ledger
RETAINED_FROM = "2024-01-30"  # the log has dropped older messages
MAIN_GROUP = "reporting"
REWIND = 700
BEHIND_GROUP = "auditing"  # always one batch behind

# Messages numbered in one window task; ids are unique, so no group is larger.
NUMBERING_BLOCK = 1 << 17

# Messages of an average landed file; a file is one task where it is written and one where it is read.
FILE_MESSAGES = 1 << 16


def _events_as_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table, spread over the cores when it has fewer splits than that.

    A large table has many splits and is taken as it is, with no shuffle.
    """
    table = _events_as_stored(spark, sf_dir)
    cores = spark.sparkContext.defaultParallelism
    return table.repartition(cores) if scan_splits(table) < cores else table


def scan_splits(table: DataFrame) -> int:
    """How many tasks a plain scan takes; plans the scan but runs nothing."""
    return table.rdd.getNumPartitions()


def provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = spark.read.schema(NATION).parquet(f"{sf_dir}/nation.parquet")
    return dimension_from_table(nation, "n_nationkey", "n_name")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and JSON text of one message per event."""
    return _as_messages(events(spark, sf_dir))


def records(spark: SparkSession, sf_dir: str, block: int = NUMBERING_BLOCK) -> DataFrame:
    """Messages with topic, partition and offset, as a broker would hold them."""
    return _as_messages(_placed_events(spark, sf_dir, block), "topic", "partition", "offset")


def positions(spark: SparkSession, sf_dir: str, block: int = NUMBERING_BLOCK) -> DataFrame:
    """Topic, partition and offset of every message, with its batch and time."""
    return _placed_events(spark, sf_dir, block).select(
        F.expr(f"event_id div {BATCH_ROWS}").alias("batch_id"),
        "ts",
        "topic",
        "partition",
        "offset",
    )


def _placed_events(spark: SparkSession, sf_dir: str, block: int) -> DataFrame:
    """Events with their place in the log. Narrower than texts, so shuffled before them."""
    stored = _events_as_stored(spark, sf_dir)
    return with_offsets(stored.select("*", _topic(), _partition()), block)


def with_offsets(placed: DataFrame, block: int = NUMBERING_BLOCK) -> DataFrame:
    """Number the messages of each topic partition from 0, in ``event_id`` order.

    There are few topic partitions, so a plain ``row_number`` would sort a third
    of all messages in one task. Ids are cut into blocks instead: messages are
    numbered inside their block, and blocks are shifted by the sizes before them.
    """
    cut = placed.withColumn("block", F.expr(f"event_id div {block}"))
    place = ["topic", "partition"]
    before = (
        Window.partitionBy(*place)
        .orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = (
        cut.groupBy(*place, "block")
        .agg(F.count("*").alias("n"))
        .select(*place, "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    )
    in_block = Window.partitionBy(*place, "block").orderBy("event_id")
    return (
        cut.withColumn("nth", F.row_number().over(in_block))
        .join(shifts, [*place, "block"])
        .withColumn("offset", F.col("shift") + F.col("nth") - 1)
        .drop("block", "nth", "shift")
    )


def ledger(ranges: DataFrame) -> DataFrame:
    """Saved offsets of two groups, from ranges per batch.

    The main group saves the end of each batch, the other one its start. Every fifth save goes back
    by ``REWIND`` messages.
    """

    def saved(name: str) -> Column:
        back = F.greatest(F.lit(0), F.col(name) - REWIND)
        return F.when(F.col("batch_id") % 5 == 4, back).otherwise(F.col(name)).alias("until_offset")

    groups = F.array(
        F.struct(F.lit(MAIN_GROUP).alias("grp"), saved("until_offset")),
        F.struct(F.lit(BEHIND_GROUP).alias("grp"), saved("from_offset")),
    )
    return ranges.select("batch_id", "topic", "partition", F.inline(groups))


def retained(placed: DataFrame) -> DataFrame:
    """The part of the log that is still held."""
    return placed.filter(F.col("ts") >= F.lit(RETAINED_FROM).cast("timestamp_ntz"))


def earliest_offsets(held: DataFrame) -> DataFrame:
    """First held offset of each topic partition."""
    return held.groupBy("topic", "partition").agg(F.min("offset").alias("earliest_offset"))


#: Folders that this application has landed already, by what they hold.
_landed: dict[tuple, tuple[str, int]] = {}


def land(
    spark: SparkSession, sf_dir: str, batches: int = 4, order: str = "event_id", per_file: int = FILE_MESSAGES
) -> tuple[str, int]:
    """Write the records as files for a stream; returns folder and files per batch.

    Files of a later batch hold later records, by ``order`` (an expression), as a broker delivers them.
    Their number follows the messages, ``per_file`` of them on average, so a batch of a large input is many files.
    Every batch has as many, some of them empty where it is short of messages: a stream takes files by number. An
    application lands a log once; streams only read it.
    """
    key = (spark.sparkContext.applicationId, sf_dir, batches, order, per_file)
    if key not in _landed:
        _landed[key] = _land(spark, sf_dir, batches, order, per_file)
    return _landed[key]


def _land(spark: SparkSession, sf_dir: str, batches: int, order: str, per_file: int) -> tuple[str, int]:
    folder = new_folder(spark, "landed")
    place = F.expr(order)
    # The log is numbered once for all batches.
    placed = _placed_events(spark, sf_dir, NUMBERING_BLOCK).withColumn("place", place).persist()
    try:
        first, last, held = placed.agg(F.min("place"), F.max("place"), F.count("*")).first()
        files = max(1, -(-held // (batches * per_file)))
        cuts = [first + (last - first) * k / batches for k in range(1, batches)] if first is not None else []
        for nth, (low, high) in enumerate(zip([None, *cuts], [*cuts, None]), 1):
            part = placed if low is None else placed.filter(F.col("place") >= F.lit(low))
            part = part if high is None else part.filter(F.col("place") < F.lit(high))
            rows = _as_messages(part.repartition(files, "event_id"), "topic", "partition", "offset")
            rows.write.mode("append").parquet(folder)
            _fill_up(spark, folder, nth * files)
    finally:
        placed.unpersist()
    return folder, files


def _fill_up(spark: SparkSession, folder: str, files: int) -> None:
    """Add empty files up to a number; a task without rows has written none."""
    written = len(spark.read.schema(S.MESSAGE_SCHEMA).parquet(folder).inputFiles())
    for _ in range(files - written):
        spark.createDataFrame([], S.MESSAGE_SCHEMA).write.mode("append").parquet(folder)


def _topic() -> Column:
    failed = F.col("event_type") == "error"
    return F.when(failed, "orders_failed").otherwise("orders").alias("topic")


def _partition() -> Column:
    return (F.col("event_id") % PARTITIONS).cast("int").alias("partition")


def _as_messages(rows: DataFrame, *places: str) -> DataFrame:
    """Key and text per event.

    By ``event_id`` modulo 997: 0 is cut in the middle; 1 lacks the result, 2 has no number as fee, 3
    no real start day, 4 no end time; 5 to 7 of the other service pad the result with a tab.
    """
    key = F.col("event_id").cast("string").alias("key")
    cut = "IF(event_id % 997 = 0, left(value, CAST(length(value) div 2 AS INT)), value)"
    whole = rows.select("event_id", key, _text(), *places)
    return whole.select("key", F.expr(cut).alias("value"), *places)


def _text() -> Column:
    return F.expr(
        f"""to_json(named_struct(
          '{S.REQUEST_ID}', IF(event_id % 997 = 3, '20240231', date_format(ts, 'yyyyMMdd'))
            || date_format(ts, 'HHmmssSSS')
            || lpad(CAST(event_id AS STRING), greatest(8, length(event_id)), '0'),
          '{S.NOTIFY_TIME}', CASE WHEN event_id % 997 = 4 THEN 'soon'
            WHEN event_id % 10 <> 0 THEN date_format(
            timestampadd(MILLISECOND, CAST(event_id * 37 % 5000 AS INT), ts),
            'yyyyMMddHHmmssSSS') END,
          '{S.PROVINCE_CODE}',
            CAST(try_cast(regexp_extract(props, '"k": *([0-9]+)', 1) AS INT) % 27 AS STRING),
          '{S.RESULT}', CASE WHEN event_id % 997 = 1 THEN NULL
            WHEN event_type = 'error' THEN '1001'
            WHEN event_type = 'view' AND event_id % 997 BETWEEN 5 AND 7 THEN '{S.SUCCESS_CODE}\\t'
            ELSE '{S.SUCCESS_CODE}' END,
          '{S.FEE}', IF(event_id % 997 = 2, '12x', CAST(CAST(round(value * 100) AS BIGINT) AS STRING)),
          '{S.SERVICE}', CASE WHEN event_type = 'view' THEN 'reChargeReq'
            ELSE '{S.NOTIFY_SERVICE}' END))"""
    ).alias("value")
