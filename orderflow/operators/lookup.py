"""Province lookup: code -> name, and the report of codes without a name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 64
MEASURED_ROWS = 100_000


def is_small(dimension: DataFrame) -> bool:
    """Whether Spark may broadcast the dimension: rows and bytes are measured, of a bounded number of rows."""
    limit = _bytes(dimension.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    length = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in dimension.columns), F.lit(0))
    found = dimension.select(length.cast("long").alias("bytes")).limit(MEASURED_ROWS + 1).agg(F.count("*").alias("rows"), F.sum("bytes").alias("bytes")).first()
    return found["rows"] <= MEASURED_ROWS and (found["bytes"] or 0) <= limit


def _bytes(size: str) -> int:
    """A size setting such as 10MB, 256k or -1 in bytes."""
    digits, unit = size.rstrip("bBkKmMgG"), size.lstrip("-0123456789")[:1].lower()
    return int(digits) * {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(unit, 1)


def attach_province(orders: DataFrame, dimension: DataFrame, how: str = "left") -> DataFrame:
    """Add ``province`` to single orders. ``left`` keeps unknown codes as NULL, ``inner`` drops them.

    Metrics need this on sums only (``provinces_of_sums``). A small dimension is broadcast as it is. For a large one every
    code is spread over ``SALTS`` tasks, because one may hold a large share of all orders; the salt is a hash of the
    order, so that a task that runs again deals its rows the same way. ``dimension`` holds each code once.
    """
    if is_small(dimension):
        return orders.join(F.broadcast(dimension), "province_code", how)
    salt = F.pmod(F.xxhash64(*orders.columns), F.lit(SALTS)).cast("int")
    salted = dimension.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return orders.withColumn("salt", salt).join(salted, ["province_code", "salt"], how).drop("salt")


def provinces_of_sums(sums: DataFrame, dimension: DataFrame, how: str = "left") -> DataFrame:
    """Add ``province`` to sums that have ``province_code`` among their keys."""
    return sums.join(dimension, "province_code", how)


def unknown_province_codes(orders: DataFrame, dimension: DataFrame) -> DataFrame:
    """Codes the dimension lacks, with their order count.

    Orders are counted per code first, so the join sees one row per code. It is
    an outer join because the optimizer would move an anti join back below the
    count.
    """
    per_code = orders.groupBy("province_code").agg(F.count("*").alias("orders"))
    known = dimension.select("province_code", F.lit(True).alias("known"))
    return (
        per_code.join(known, "province_code", "left")
        .filter("known IS NULL")
        .select("province_code", "orders")
    )
