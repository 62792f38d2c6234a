"""Output of a batch partition by partition: a data sink with a commit.

Each task opens one file for its partition and writes the rows as they come, so the sink holds a bounded
number of rows and one handle a task. The files of a batch count once the driver has committed them, all together; a batch
that is committed already is dropped when it comes again, and so are files of tasks that broke off.

The folder has to be one that Arrow's file systems reach, from the driver and all executors.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from orderflow.sources.positions import store_of


@dataclass
class Written(WriterCommitMessage):
    """The file of a task, '' if its partition was empty."""

    name: str
    rows: int


class _Writer:
    """What tasks write and what the driver commits; ``run`` tells apart queries that count their batches anew."""

    def __init__(self, folder: str, run: str):
        self.folder, self.run = folder, run

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = store_of(self.folder)
        held, name, rows = None, "", 0
        try:
            for batch in iterator:
                if batch.num_rows == 0:
                    continue
                if held is None:
                    name = f"{uuid.uuid4().hex}.parquet"
                    files.create_dir(posixpath.join(root, "files"))
                    held = pq.ParquetWriter(posixpath.join(root, "files", name), batch.schema, filesystem=files)
                held.write_batch(batch)
                rows += batch.num_rows
        finally:
            if held is not None:
                held.close()
        return Written(name, rows)

    def commit_batch(self, messages: list[Written | None], batch: int) -> None:
        files, root = store_of(self.folder)
        folder = posixpath.join(root, "commits")
        place = posixpath.join(folder, f"{self.run}-{batch:012d}.json")
        if files.get_file_info(place).type != pafs.FileType.NotFound:
            self.drop(messages)
            return
        files.create_dir(folder)
        entry = {"run": self.run, "batch": batch, "files": [m.name for m in messages if m and m.name], "rows": sum(m.rows for m in messages if m)}
        beside = posixpath.join(folder, f"_{uuid.uuid4().hex}")
        with files.open_output_stream(beside) as out:
            out.write(json.dumps(entry).encode())
        files.move(beside, place)

    def drop(self, messages: list[Written | None]) -> None:
        files, root = store_of(self.folder)
        for message in messages:
            if message and message.name:
                files.delete_file(posixpath.join(root, "files", message.name))


class _StreamWriter(_Writer, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        self.commit_batch(messages, batchId)

    def abort(self, messages, batchId: int) -> None:
        self.drop(messages)


class _BatchWriter(_Writer, DataSourceArrowWriter):
    def __init__(self, folder: str, run: str, batch: int):
        super().__init__(folder, run)
        self.batch = batch

    def commit(self, messages) -> None:
        self.commit_batch(messages, self.batch)

    def abort(self, messages) -> None:
        self.drop(messages)


class PartitionOutput(DataSource):
    """Options: ``path``, ``run`` (a name for the query and its checkpoint), and ``batch`` outside of streams."""

    @classmethod
    def name(cls) -> str:
        return "partition_output"

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _BatchWriter(self.options["path"], self.options.get("run", "batch"), int(self.options["batch"]))

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(self.options["path"], self.options.get("run", "batch"))


def write_partitions(rows: DataFrame, folder: str, batch_id: int, run: str = "batch") -> None:
    """Write a batch; the same batch of the same run again changes nothing."""
    rows.sparkSession.dataSource.register(PartitionOutput)
    rows.write.format("partition_output").options(path=folder, run=run, batch=batch_id).mode("append").save()


def stream_partitions(rows: DataFrame, folder: str, checkpoint: str, run: str = "batch") -> None:
    """Write what a stream holds, batch by batch."""
    rows.sparkSession.dataSource.register(PartitionOutput)
    query = (
        rows.writeStream.format("partition_output")
        .options(path=folder, run=run, checkpointLocation=checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_partitions(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The rows of all committed batches."""
    files, root = store_of(folder)
    found = files.get_file_info(pafs.FileSelector(posixpath.join(root, "commits"), allow_not_found=True))
    names = []
    for info in found:
        if info.path.endswith(".json"):
            with files.open_input_file(info.path) as held:
                names += json.loads(held.read())["files"]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{folder}/files/{name}" for name in names])
