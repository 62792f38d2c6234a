"""Stream positions: ranges per batch, the ledger, and where to resume.

The stream's checkpoint decides where a restarted query goes on. The ledger is a
readable record next to it, and a way to seed a new query.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def offset_ranges(records: DataFrame, *batch_keys: str) -> DataFrame:
    """First offset and one past the last, per topic and partition of each batch."""
    return records.groupBy(*batch_keys, "topic", "partition").agg(
        F.min("offset").alias("from_offset"),
        (F.max("offset") + 1).alias("until_offset"),
    )


def saved_offsets(ledger: DataFrame, grp: str, topic: str | None = None) -> DataFrame:
    """Last saved offset of a group, per topic and partition.

    The last save counts, not the largest offset: a topic made anew or a rewind
    saves smaller ones. ``batch_id`` orders the saves.
    """
    mine = ledger.filter(F.col("grp") == grp)
    if topic is not None:
        mine = mine.filter(F.col("topic") == topic)
    last = F.max_by("until_offset", "batch_id").alias("saved_offset")
    return mine.groupBy("topic", "partition").agg(last)


def resume_plan(saved: DataFrame, earliest: DataFrame) -> DataFrame:
    """Where to resume: the saved offset, unless the log no longer reaches back to it.

    ``earliest`` holds ``topic, partition, earliest_offset``; a partition it does
    not list keeps its saved offset.
    """
    return saved.join(earliest, ["topic", "partition"], "left").select(
        "topic",
        "partition",
        "saved_offset",
        "earliest_offset",
        F.greatest("saved_offset", "earliest_offset").alias("start_offset"),
    )


def resume_positions(
    saved: DataFrame, earliest: DataFrame, topics: list[str] | None = None, all_listed: bool = True
) -> DataFrame:
    """Where a new query begins in every partition that the log has or the ledger knows.

    ``saved`` and ``earliest`` are those of ``resume_plan``. ``status`` is ``saved``; ``behind`` where the log no longer
    reaches back to the saved offset, and ``new`` where nothing was saved, both begin at the earliest offset; ``vanished`` where the
    log has no such partition any more, which has no start. ``topics`` leaves out those that aren't subscribed. Where ``earliest``
    doesn't list all partitions of the log (``all_listed``), one that it lacks is taken to be there.
    """
    place = ["topic", "partition"]
    both = saved.join(earliest, place, "full_outer")
    if topics is not None:
        both = both.filter(F.col("topic").isin(topics))
    gone, unknown = F.col("earliest_offset").isNull() & all_listed, F.col("saved_offset").isNull()
    behind = F.col("saved_offset") < F.col("earliest_offset")
    status = F.when(gone, "vanished").when(unknown, "new").when(behind, "behind").otherwise("saved")
    start = F.when(~gone, F.greatest("saved_offset", "earliest_offset"))
    return both.select(*place, "saved_offset", "earliest_offset", start.alias("start_offset"), status.alias("status"))


def starting_offsets_json(plan: DataFrame) -> str:
    """The resume plan as the Kafka source's ``startingOffsets``; partitions without a start are left out.

    One JSON text per topic is built in Spark; the texts are the configuration of a query.
    """
    per_partition = F.map_from_entries(
        F.array_sort(
            F.collect_list(F.struct(F.col("partition").cast("string"), F.col("start_offset")))
        )
    )
    topics = plan.filter("start_offset IS NOT NULL").groupBy("topic").agg(F.to_json(per_partition).alias("offsets"))
    rows = topics.orderBy("topic").collect()
    return "{" + ", ".join(f"{json.dumps(row['topic'])}: {row['offsets']}" for row in rows) + "}"
