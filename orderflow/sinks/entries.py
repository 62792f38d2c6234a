"""Numbered JSON entries in a shared folder, each written once."""

from __future__ import annotations

import json
import threading
import uuid

from pyspark.sql import SparkSession

_ONE_WRITER = threading.Lock()


class Entries:
    """Entries 1, 2, 3 and so on of a folder.

    An entry is written beside the others and renamed to its number, which fails where the number is taken. Stores
    whose rename can replace a file (object stores) need one writer for each folder; inside a
    process that holds anyway.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        self._folder = folder
        hadoop = self._jvm.org.apache.hadoop.fs
        conf = spark._jsc.hadoopConfiguration()
        self._path = lambda name="": hadoop.Path(f"{folder}/{name}" if name else folder)
        self._fs = self._path().getFileSystem(conf)
        self._context = hadoop.FileContext.getFileContext(self._fs.getUri(), conf)
        self._never_replace = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
        self._never_replace[0] = hadoop.Options.Rename.NONE

    def _name(self, number: int) -> str:
        return f"{number:020d}.json"

    def names(self) -> list[str]:
        """Names of all that is in the folder."""
        if not self._fs.exists(self._path()):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(self._path())]

    def numbers(self, after: int = 0) -> list[int]:
        """Numbers of entries that are there, in order."""
        found = [int(x[:20]) for x in self.names() if x.endswith(".json") and x[:20].isdigit()]
        return sorted(n for n in found if n > after)

    def has(self, number: int) -> bool:
        return self._fs.exists(self._path(self._name(number)))

    def read(self, number: int) -> dict | None:
        try:
            held = self._fs.open(self._path(self._name(number)))
        except Exception as missing:
            if "FileNotFoundException" in str(missing):
                return None
            raise
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8"))
        finally:
            held.close()

    def put_if_absent(self, number: int, entry: dict) -> bool:
        """Write the entry unless its number is taken."""
        beside = self._path(f"_{uuid.uuid4().hex}")
        out = self._fs.create(beside, False)
        try:
            out.write(bytearray(json.dumps(entry).encode()))
        finally:
            out.close()
        with _ONE_WRITER:
            if not self.has(number):
                try:
                    self._context.rename(beside, self._path(self._name(number)), self._never_replace)
                    return True
                except Exception as taken:
                    if "FileAlreadyExistsException" not in str(taken):
                        raise
        self._fs.delete(beside, False)
        return False

    def remove(self, number: int) -> None:
        self._fs.delete(self._path(self._name(number)), False)

    def remove_beside(self, place: str) -> None:
        """Remove a folder next to that of the entries."""
        parent = self._path().getParent()
        self._fs.delete(self._jvm.org.apache.hadoop.fs.Path(parent, place), True)
