"""Documents to a training mix: quality, lines, near duplicates, benchmarks, weights.

Each stage takes all that the one before kept, and what it decides takes effect. All but the last
return the columns of ``documents``, whatever else those columns are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.curriculum import by_position, curriculum
from orderflow.llm.decontamination import decontaminate, document_key
from orderflow.llm.jaccard_join import jaccard_join
from orderflow.llm.line_dedup import line_dedup
from orderflow.llm.quality import quality_rules
from orderflow.llm.tables import WHITE, kept_table, small_side, table

KEY = "_document_key"


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Documents whose key is not among ``keys`` (a column ``doc``)."""
    going = small_side(kept_table(keys.select(F.col("doc").alias(KEY)).distinct(), "going"))
    return docs.withColumn(KEY, document_key()).join(going, KEY, "left_anti").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that base rules or distances reject go."""
    judged = quality_rules(docs, keyed=True)
    return without(docs, judged.where(~F.col("kept")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go; documents stay, whatever is left of them."""
    return line_dedup(docs, min_words=5, near_words=10).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates stays.

    Rows of the smallest id stay together. Other texts of an id whose one text goes stay too. A null id
    is no other's duplicate.
    """
    return without(docs, jaccard_join(docs, size=5, percent=75, keyed=True).where("doc_id != component_id"))


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are contaminated with benchmark passages go."""
    judged = decontaminate(docs, table(spark, sf_dir, "benchmark"), size=13, percent=5)
    return without(docs, judged.where("contaminated"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row each time a document is trained on: its columns, ``pass_words`` and ``position``, in that order.

    Text of a pass over a part of a document is cut to that part, its white space to single spaces.
    Rows of one id and text are one document here. Columns of these names are replaced.
    """
    plan = curriculum(docs, weights=(5, 2, 1), percent=150, cap=2)
    times = F.transform("passes", lambda x: F.struct(x["position"].alias("position"), x["words"].alias("pass_words")))
    passes = plan.where("taken > 0").groupBy("doc").agg(F.first(times).alias("_passes"), F.first("size").alias("_size"))
    passes = small_side(kept_table(passes.withColumnRenamed("doc", KEY), "passes"))
    used = (
        docs.withColumn(KEY, document_key())
        .join(passes, KEY)
        .select(*[c for c in docs.columns if c not in ("position", "pass_words")], "_size", F.inline("_passes"))
    )
    part = F.array_join(F.slice(F.split(F.regexp_replace("text", f"^{WHITE}+", ""), f"{WHITE}+"), F.lit(1), F.col("pass_words").cast("int")), " ")
    cut = F.when(F.col("pass_words") < F.col("_size"), part).otherwise(F.col("text"))
    return by_position(used.withColumn("text", cut).drop("_size"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmarks),
    ("source_mix", mix),
]

#: Not for SQL: distances to learned references, components of any depth.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is written and read again but the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
