"""Reads from a relational store through Spark's JDBC source."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTable:
    """A table behind a JDBC URL. The driver jar comes with the cluster."""

    url: str
    table: str
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {"url": self.url, "dbtable": self.table, **self.properties}


def read_columns(
    spark: SparkSession,
    source: JdbcTable,
    columns: list[str],
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Chosen columns of a table, read in parallel when a numeric range is given."""
    return spark.read.format("jdbc").options(
        **read_options(source, partition_column, bounds, partitions)
    ).load().select(*columns)


def read_options(
    source: JdbcTable,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    options = source.options()
    if partition_column and bounds:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options
