"""Reading the given tables, and tables written between the steps of a job."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.session import new_folder, settings

#: Hash seeds and constants are fixed, so that reruns agree.
WHITE = r"[ \t-\r]"
WORD = r"[^ \t-\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept_table(rows: DataFrame, label: str) -> DataFrame:
    """Write rows to the shared folder and read them back.

    Later steps then start from the files: a lost executor costs only its own
    tasks, and nothing before this point is computed twice. Shuffle files of the
    write are of no use after it and go when it ends.
    """
    spark = rows.sparkSession
    folder = new_folder(spark, label)
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        rows.write.parquet(folder)
    kept = spark.read.schema(rows.schema).parquet(folder)
    _folders[kept] = folder
    return kept


#: Where written tables lie.
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Remove written tables that no later step reads."""
    for rows in tables:
        spark = rows.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(_folders.pop(rows))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


BROADCAST_BYTES = 48 << 20


def small_side(rows: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rows to broadcast if their size in memory is known to be small, else rows for a shuffled join.

    rows: a written table. Where all columns have a fixed width, measuring reads its footers only.
    """
    return F.broadcast(rows) if memory_size(rows) <= limit else rows


def memory_size(rows: DataFrame) -> int:
    """Bytes of all rows in memory: eight a value, and the lengths of texts and lists."""
    fixed, lengths = 16, []
    for field in rows.schema:
        fixed += 8
        if (length := _length(F.col(field.name), field.dataType)) is not None:
            lengths.append(F.coalesce(length, F.lit(0)).cast("long"))
    if not lengths:
        return rows.count() * fixed
    found = rows.agg(F.count("*").alias("rows"), F.sum(sum(lengths[1:], lengths[0])).alias("bytes")).first()
    return found["rows"] * fixed + (found["bytes"] or 0)


def _length(column: Column, kind: T.DataType) -> Column | None:
    """Bytes of a value beside its first eight, null for those of a fixed width."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.octet_length(column)
    if isinstance(kind, T.StructType):
        parts = [_length(column[f.name], f.dataType) for f in kind.fields]
        more = [F.coalesce(x, F.lit(0)).cast("long") for x in parts if x is not None]
        return sum(more, F.lit(8 * len(kind.fields)).cast("long"))
    if isinstance(kind, T.ArrayType):
        each = _length(F.lit(None).cast(kind.elementType), kind.elementType)
        if each is None:
            return F.array_size(column) * 8
        zero = F.lit(0).cast("long")
        return F.aggregate(column, zero, lambda total, x: total + 8 + F.coalesce(_length(x, kind.elementType), zero).cast("long"))
    return None
