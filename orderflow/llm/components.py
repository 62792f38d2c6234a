"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.tables import kept_table


def _mark(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest id each node of ``links`` (a, b) reaches.

    Alternates two contractions until the links are stars. Each is an
    aggregation and a join on a table no larger than the links, written to the
    shared folder, so a star of any size is never gathered in one task. Null ids
    and links of a node with itself are left out; no links give no rows.
    """
    links = kept_table(
        links.where("a is not null and b is not null and a != b").select("a", "b").distinct(), "links"
    )
    before = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        far = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = far.groupBy("a").agg(F.min("b").alias("m"))
        near = (
            far.join(least, "a")
            .where("b != m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
            .where("a != b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
            .distinct()
        )
        links = kept_table(near, "links")
        now = _mark(links)
        if now == before:
            break
        before = now
    stars = links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    roots = links.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return stars.unionByName(roots)
