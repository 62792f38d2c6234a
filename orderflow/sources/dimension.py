"""The province dimension: code -> name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.functions.texts import word


def read_province_dimension(spark: SparkSession, path: str) -> DataFrame:
    """Text of ``code name`` lines. A code given twice keeps its last name."""
    line_place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    lines = spark.read.text(path).select(
        word(F.col("value"), 0).alias("province_code"),
        word(F.col("value"), 1).alias("province"),
        line_place.alias("place"),
    )
    return (
        lines.filter("province_code <> '' AND province IS NOT NULL")
        .groupBy("province_code")
        .agg(F.max_by("province", "place").alias("province"))
    )


def dimension_from_table(table: DataFrame, code: str, name: str) -> DataFrame:
    """Dimension from columns of a table whose ``code`` is unique."""
    return table.select(
        F.col(code).cast("string").alias("province_code"), F.col(name).alias("province")
    )
