"""Order messages from Kafka, from landed files and from text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.schema import MESSAGE_SCHEMA


def kafka_options(
    brokers: str,
    topics: list[str],
    starting_offsets: str | None = None,
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``starting_offsets`` is the JSON of ``offsets.starting_offsets_json``; without
    it reading starts at the earliest offset. Once a stream has a checkpoint, the
    checkpoint decides where it goes on. Messages that the broker has dropped unread
    stop the query unless ``fail_on_data_loss`` is false.
    """
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets or "earliest",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_messages(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Kafka stream with key and value as text (needs the Kafka connector jar)."""
    return as_text_messages(spark.readStream.format("kafka").options(**options).load())


def as_text_messages(records: DataFrame) -> DataFrame:
    """Keep the key and value of broker records as text, with their position."""
    return records.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
    )


def landed_messages(spark: SparkSession, folder: str, files_per_batch: int) -> DataFrame:
    """Stream over a folder of landed message files (parquet, ``MESSAGE_SCHEMA``)."""
    return (
        spark.readStream.schema(MESSAGE_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def text_messages(spark: SparkSession, path: str) -> DataFrame:
    """One message per text line; splittable, so a large file is many tasks."""
    return spark.read.text(path)
