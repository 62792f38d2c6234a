"""A log of landed messages that is read by position: a data source with offsets.

Messages lie by topic, partition and segment, a run of ``SEGMENT`` offsets. A reader opens the segments of
its range only, so a query that begins at saved offsets reads no file before them. Positions are the JSON of the
Kafka source, ``{"topic": {"partition": offset}}``: the first offset to read, or one past the last.

The folder has to be one that Arrow's file systems reach (a local or mounted path, hdfs, s3, gs).
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from orderflow.schema import MESSAGE_SCHEMA

SEGMENT = 1 << 20
Positions = dict[str, dict[str, int]]


def write_log(messages: DataFrame, folder: str, segment: int = SEGMENT) -> None:
    """Append messages with topic, partition and offset to a log; every segment is sorted by offset."""
    first = F.expr(f"`offset` div {segment} * {segment}")
    (
        messages.select(*MESSAGE_SCHEMA.names, first.alias("segment"))
        .repartition("topic", "partition", "segment")
        .sortWithinPartitions("topic", "partition", "segment", "offset")
        .write.partitionBy("topic", "partition", "segment")
        .mode("append")
        .parquet(folder)
    )


@dataclass
class Span(InputPartition):
    """Offsets of one partition that lie in one segment."""

    topic: str
    partition: int
    folder: str
    start: int
    until: int


def store_of(folder: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system of a folder, and the folder's path in it."""
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))
    return pafs.LocalFileSystem(), folder


class _Log:
    """What lies where in a folder."""

    def __init__(self, folder: str):
        self.folder = folder

    @cached_property
    def store(self) -> tuple[pafs.FileSystem, str]:
        return store_of(self.folder)

    def _below(self, path: str, key: str) -> dict[str, str]:
        """Value and path of the folders ``key=value`` in a folder."""
        files, _ = self.store
        found = files.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        names = [(posixpath.basename(x.path), x.path) for x in found if x.type == pafs.FileType.Directory]
        return {name.removeprefix(f"{key}="): path for name, path in names if name.startswith(f"{key}=")}

    def segments(self) -> dict[tuple[str, int], dict[int, str]]:
        """First offset and folder of the segments of each topic and partition, in order."""
        out = {}
        for topic, at in self._below(self.store[1], "topic").items():
            for partition, below in self._below(at, "partition").items():
                held = {int(k): v for k, v in self._below(below, "segment").items()}
                out[topic, int(partition)] = dict(sorted(held.items()))
        return out

    def files(self, folder: str) -> list[str]:
        found = self.store[0].get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        return sorted(x.path for x in found if x.path.endswith(".parquet"))

    def bounds(self, folder: str) -> tuple[int, int]:
        """First offset of a segment's files and one past the last, from their footers."""
        low, high = [], []
        for path in self.files(folder):
            with self.store[0].open_input_file(path) as held:
                footer = pq.ParquetFile(held).metadata
            column = footer.schema.to_arrow_schema().get_field_index("offset")
            for k in range(footer.num_row_groups):
                found = footer.row_group(k).column(column).statistics
                low.append(found.min)
                high.append(found.max + 1)
        return min(low, default=0), max(high, default=0)

    def ends(self) -> Positions:
        """One past the last offset of each partition; only its last segment is looked into."""
        out: Positions = {}
        for (topic, partition), held in self.segments().items():
            out.setdefault(topic, {})[str(partition)] = self.bounds(held[max(held)])[1]
        return out

    def starts(self, given: Positions) -> Positions:
        """The given offsets, and the first one of partitions that aren't given; only these are looked into."""
        out: Positions = {}
        for (topic, partition), held in self.segments().items():
            known = given.get(topic, {}).get(str(partition))
            out.setdefault(topic, {})[str(partition)] = self.bounds(held[min(held)])[0] if known is None else known
        return out

    def spans(self, start: Positions, end: Positions) -> list[Span]:
        """The segments that hold offsets from ``start`` up to ``end``; a partition that start lacks is read whole."""
        out = []
        for (topic, partition), held in self.segments().items():
            low = start.get(topic, {}).get(str(partition), 0)
            high = end.get(topic, {}).get(str(partition), 0)
            firsts = list(held)
            for first, following in zip(firsts, [*firsts[1:], None]):
                if first < high and (following is None or following > low):
                    out.append(Span(topic, partition, held[first], low, high))
        return out


def _read(folder: str, span: Span) -> Iterator[pa.RecordBatch]:
    log = _Log(folder)
    for path in log.files(span.folder):
        with log.store[0].open_input_file(path) as held:
            for batch in pq.ParquetFile(held).iter_batches(columns=["key", "value", "offset"]):
                inside = pc.and_(pc.greater_equal(batch["offset"], span.start), pc.less(batch["offset"], span.until))
                batch = batch.filter(inside)
                rows = batch.num_rows
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch["key"].cast(pa.string()),
                            batch["value"].cast(pa.string()),
                            pa.array([span.topic] * rows, pa.string()),
                            pa.array([span.partition] * rows, pa.int32()),
                            batch["offset"].cast(pa.int64()),
                        ],
                        names=MESSAGE_SCHEMA.names,
                    )


class _Options:
    def __init__(self, options: dict[str, str]):
        given = {name.lower(): value for name, value in options.items()}  # Spark keeps names in lower case
        self.folder = given["path"]
        self.log = _Log(self.folder)
        self.starting = json.loads(given.get("startingoffsets", "{}"))
        self.ending = json.loads(given["endingoffsets"]) if "endingoffsets" in given else None
        self.limit = int(given["maxoffsetspertrigger"]) if "maxoffsetspertrigger" in given else None

    def first(self) -> Positions:
        """Where a new query begins."""
        return self.log.starts(self.starting)

    def last(self) -> Positions:
        ends = self.log.ends()
        if self.ending is None:
            return ends
        return {t: {p: min(end, self.ending.get(t, {}).get(p, end)) for p, end in held.items()} for t, held in ends.items()}


class _StreamReader(_Options, DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        super().__init__(options)
        # A restarted query plans the range of its last batch first, and so is known to be at its end.
        self.at: Positions | None = None

    def initialOffset(self) -> Positions:
        return self.first()

    def latestOffset(self) -> Positions:
        end = self.last()
        if self.limit is None:
            return end
        at = self.at = self.at or self.first()
        lag = {(t, p): max(0, x - at.get(t, {}).get(p, 0)) for t, held in end.items() for p, x in held.items()}
        total = sum(lag.values())
        if total <= self.limit:
            return end
        # Each partition gets its share of the limit, and one message at least where any wait.
        step = {k: min(n, max(1, n * self.limit // total)) if n else 0 for k, n in lag.items()}
        return {t: {p: at.get(t, {}).get(p, 0) + step[t, p] for p in held} for t, held in end.items()}

    def partitions(self, start: Positions, end: Positions) -> list[Span]:
        back = [(t, p) for t, held in start.items() for p, x in held.items() if end.get(t, {}).get(p, x) < x]
        if back:
            raise ValueError(f"the log ends before the query in {back}")
        self.at = end
        return self.log.spans(start, end)

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return _read(self.folder, partition)


class _RangeReader(_Options, DataSourceReader):
    def partitions(self) -> list[Span]:
        # A task for an empty range, as a plan needs one.
        return self.log.spans(self.first(), self.last()) or [Span("", 0, self.log.store[1], 0, 0)]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return _read(self.folder, partition)


class LandedLog(DataSource):
    """Options: ``path``, ``startingOffsets``, ``endingOffsets`` and, for streams, ``maxOffsetsPerTrigger``.

    The limit is for queries that run on: one that takes what is there (``availableNow``) plans a single batch. A query
    stops rather than go back behind messages that it has read.
    """

    @classmethod
    def name(cls) -> str:
        return "landed_log"

    def schema(self):
        return MESSAGE_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _RangeReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(dict(self.options))


def _options(folder: str, starting: str | None, ending: str | None, limit: int | None = None) -> dict[str, str]:
    given = {"path": folder, "startingOffsets": starting, "endingOffsets": ending, "maxOffsetsPerTrigger": limit}
    return {k: str(v) for k, v in given.items() if v is not None}


def log_stream(
    spark: SparkSession, folder: str, starting: str | None = None, ending: str | None = None, limit: int | None = None
) -> DataFrame:
    """Stream of a log's messages from ``starting`` on; a checkpoint decides where a restarted query goes on.

    limit: messages a batch, about, while the query runs on.
    """
    spark.dataSource.register(LandedLog)
    return spark.readStream.format("landed_log").options(**_options(folder, starting, ending, limit)).load()


def log_range(spark: SparkSession, folder: str, starting: str | None = None, ending: str | None = None) -> DataFrame:
    """The messages from ``starting`` up to ``ending``."""
    spark.dataSource.register(LandedLog)
    return spark.read.format("landed_log").options(**_options(folder, starting, ending)).load()


def earliest_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """The first offset that each partition of a log still has: ``topic``, ``partition``, ``earliest_offset``."""
    found = [(t, int(p), first) for t, held in _Log(folder).starts({}).items() for p, first in held.items()]
    return spark.createDataFrame(found, "topic string, partition int, earliest_offset bigint")
