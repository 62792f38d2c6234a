"""Mixing sources to target weights along a time-varying curriculum (operator 9), DataFrame functions only.

A document's size is its number of words. Sources get weights by turns in code point order, the
null source last, and share a number of words; a target stops at ``cap`` times its source's size
and the rest is shared again by weight until none is above.

Each source has a schedule: its weight changes linearly over training time from 0 to 1. Its
integral is the source's cumulative demand. A source's documents stand in a fixed order (MD5 of
the id), as often as the target needs, the last one in part. The time at which demand reaches the
middle of a document's words is its position, and documents are dealt and sorted by position.

Sums along a source run over 4,096 ranges of the order and then within each, so that no task holds
a source. Rows of one id are separate documents, in the order of their sizes. A null or blank text
has size 0, is taken 0 times and has no position. No words at all give targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.llm.tables import WORD, kept_table, small_side

WEIGHTS = (5, 2, 1)
#: Weight of a source at the begin and end of training, relative to its mean, by its place in WEIGHTS.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))


def by_turns(values: list, turn: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), turn)


def source_targets(
    sized: DataFrame, weights: tuple = WEIGHTS, schedules: tuple = SCHEDULES, percent: int = 150, cap: int = 2
) -> DataFrame:
    """A row for each source: ``source_size``, ``target``, and the ``begin`` and ``end`` of its schedule.

    This works on one row a source, so global windows over them hold few rows.
    """
    in_order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    by_room = Window.partitionBy(F.lit(0)).orderBy(F.col("most") / F.col("weight"), "nth")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    all_of = Window.partitionBy(F.lit(0))
    turn = F.pmod(F.col("nth") - 1, F.lit(len(weights))) + 1
    shared = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("nth", F.row_number().over(in_order))
        .withColumn("weight", by_turns(list(weights), turn))
        .withColumn("begin", by_turns([float(a) for a, _ in schedules], turn))
        .withColumn("end", by_turns([float(b) for _, b in schedules], turn))
        .withColumn("most", F.col("source_size") * cap)
        .withColumn("words", F.sum("source_size").over(all_of) * (percent / 100))
        .withColumn("room_taken", F.coalesce(F.sum("most").over(before), F.lit(0)))
        .withColumn("weight_taken", F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("weight_all", F.sum("weight").over(all_of))
        # What a unit of weight gets if all sources with less room are full.
        .withColumn("unit", (F.col("words") - F.col("room_taken")) / (F.col("weight_all") - F.col("weight_taken")))
        .withColumn("full", F.col("most") <= F.col("unit") * F.col("weight"))
        .withColumn("first_open", F.min(F.when(~F.col("full"), F.struct(F.col("most") / F.col("weight"), "nth", "unit"))).over(all_of))
    )
    target = F.when(F.col("full"), F.col("most").cast("double")).otherwise(F.col("first_open.unit") * F.col("weight"))
    return shared.select("source", "nth", "source_size", target.alias("target"), "begin", "end")


def time_of(share: Column, begin: Column, end: Column) -> Column:
    """When a schedule that is linear from begin to end has used up this share of its integral."""
    slope = end - begin
    root = F.sqrt(begin * begin + slope * (begin + end) * share)
    return F.when(slope == 0, share).otherwise((root - begin) / slope)


def curriculum(
    docs: DataFrame, weights: tuple = WEIGHTS, schedules: tuple = SCHEDULES, percent: int = 150, cap: int = 2
) -> DataFrame:
    """One row per document, dealt and sorted by position.

    ``doc`` (key of id and text), ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken`` (words,
    repeats counted), ``position`` (0 to 1, of the first pass; null if nothing is taken) and
    ``passes``, an array of (position, words) with an entry for each time the document is used.
    """
    place = F.md5(F.col("doc_id").cast("string"))
    sized = kept_table(
        docs.select(
            F.xxhash64(F.col("doc_id").cast("long"), "text").alias("doc"),
            F.col("doc_id").cast("long").alias("doc_id"),
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.coalesce(place, F.lit("g")).alias("place"),
        ),
        "sizes",
    )
    targets = kept_table(source_targets(sized, weights, schedules, percent, cap), "targets").withColumnRenamed("source", "_source")
    known = sized.join(small_side(targets), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    known = known.withColumn("range", F.substring("place", 1, 3))
    # At most 4,097 ranges a source.
    up_to = F.sum("words").over(Window.partitionBy("nth").orderBy("range"))
    ranges = kept_table(
        known.groupBy("nth", "range")
        .agg(F.sum("size").alias("words"))
        .select("nth", "range", (up_to - F.col("words")).alias("before")),
        "ranges",
    )
    within = Window.partitionBy("nth", "range").orderBy("place", "size").rowsBetween(Window.unboundedPreceding, -1)
    size, total, target = F.col("size"), F.col("source_size"), F.col("target")
    wanted = F.round(target).cast("long")
    whole = F.when(total > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(F.lit(0).cast("long"))
    planned = (
        known.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .join(small_side(ranges), ["nth", "range"])
        .withColumn("start", F.col("before") + F.col("inside"))
        .withColumn("whole", whole)
        .withColumn("part", F.greatest(F.lit(0), F.least(size, wanted - F.col("whole") * total - F.col("start"))))
        .withColumn("taken", F.col("whole") * size + F.col("part"))
        .withColumn(
            "words",
            F.filter(F.expr("transform(sequence(0L, whole), p -> if(p < whole, size, part))"), lambda x: x > 0),
        )
        .withColumn(
            "passes",
            F.transform(
                "words",
                lambda words, p: F.struct(
                    time_of(
                        F.least(F.lit(1.0), (p * total + F.col("start") + words / 2) / target), F.col("begin"), F.col("end")
                    ).alias("position"),
                    words.alias("words"),
                ),
            ),
        )
        .withColumn("position", F.get("passes", F.lit(0))["position"])
        .select("doc", "doc_id", "source", "size", "source_size", "target", "taken", "position", "passes")
    )
    return by_position(planned)


def by_position(rows: DataFrame) -> DataFrame:
    """Deal rows by equal ranges of ``position`` and sort each; rows without one come first.

    Positions are spread evenly over the words, so the ranges need no sample.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.least(F.lit(parts - 1), F.floor(F.col("position") * parts)).cast("int")
    # Rows without a position are dealt over all parts.
    part = F.coalesce(part, F.pmod(F.xxhash64(*rows.columns[:3]), F.lit(parts)).cast("int"))
    return rows.repartitionById(parts, part).sortWithinPartitions("position")
