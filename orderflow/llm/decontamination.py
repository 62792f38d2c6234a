"""Benchmark passages in documents by a positional inverted index (operator 8).

Words are runs of digits, lower-cased letters a to z and characters beyond ASCII. A window is
``size`` consecutive words of an item, or the whole item if it has fewer. A window occurs where
its words stand in a document in the same order with nothing between.

1. Benchmark items become distinct windows; one pass counts their words in the corpus. A window
   with a word that the corpus lacks is done.
2. A second pass stores postings (document, position, word). Only words in reach of a window's
   rarest word can take part in a match, so only those are stored.
3. The list of each window's rarest word gives candidate starts. They are intersected with the
   list of the next rarest at its offset, and what is left with all others.

With ``slop`` above 0 the other words may each stand that many places off (proximity matches).

Words are 64-bit hashes. The benchmark's words go to every task if they are at most
``vocabulary_limit``, else all words are counted and stored, and joins do the selection. Null
texts have no words; items without words have no windows. Rows of the same id and text are
one document and get the same result; null ids are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.llm import words
from orderflow.llm.tables import kept_table

VOCABULARY_LIMIT = 4_000_000


class WordSet:
    """A set of word hashes that whole arrays are looked up in."""

    def __init__(self, members: np.ndarray):
        self.members = np.unique(members)
        bits = min(24, max(10, int(len(self.members)).bit_length() + 4))
        self.mask = np.uint64((1 << bits) - 1)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[(self.members & self.mask).astype(np.int64)] = True

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        out = self.maybe[(hashes & self.mask).astype(np.int64)]
        check = np.flatnonzero(out)
        at = np.minimum(np.searchsorted(self.members, hashes[check]), max(0, len(self.members) - 1))
        out[check] = self.members[at] == hashes[check] if len(self.members) else False
        return out


def _hashed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    at = words.texts(batch.column("text")).lower()
    starts, ends, first = words.spans(at, words.ALPHANUMERIC)
    return words.span_hashes(at.data, starts, ends), first


def _windows(size: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, first = _hashed(batch)
            items, ids, terms = [], [], []
            for row, item in enumerate(batch.column("item").to_pylist()):
                own = hashes[first[row] : first[row + 1]]
                for start in range(max(1, len(own) - size + 1) if len(own) else 0):
                    window = own[start : start + size]
                    items.append(item)
                    ids.append(int(words.sequence_hash(window).view(np.int64)))
                    terms.append(window.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(ids, pa.int64()), pa.array(terms, pa.list_(pa.int64()))],
                names=["item", "window", "terms"],
            )

    return windows


def _counts(vocabulary):
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.pieces(batch, "text"):
                hashes, _ = _hashed(part)
                if vocabulary:
                    hashes = hashes[vocabulary.value.holds(hashes)]
                terms, times = np.unique(hashes, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(times)], names=["term", "times"])

    return counts


def _postings(vocabulary, anchors, reach: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("doc", pa.int64()), ("n_words", pa.int64()), ("at", pa.list_(pa.int32())), ("terms", pa.list_(pa.int64()))]
    )

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.pieces(batch, "text"):
                hashes, first = _hashed(part)
                counts = np.diff(first)
                own = np.repeat(np.arange(len(counts)), counts)
                keep = np.ones(len(hashes), bool)
                if vocabulary:
                    near = np.flatnonzero(anchors.value.holds(hashes))
                    steps = np.zeros(len(hashes) + 1, np.int64)
                    np.add.at(steps, np.maximum(near - reach, first[own[near]]), 1)
                    np.add.at(steps, np.minimum(near + reach + 1, first[own[near] + 1]), -1)
                    keep = np.cumsum(steps[:-1]) > 0
                    keep[keep] = vocabulary.value.holds(hashes[keep])
                at = np.flatnonzero(keep)
                bounds = pa.array(np.searchsorted(at, first).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("doc"),
                        pa.array(counts.astype(np.int64)),
                        pa.ListArray.from_arrays(bounds, pa.array((at - first[own[at]]).astype(np.int32))),
                        pa.ListArray.from_arrays(bounds, pa.array(hashes[at].view(np.int64))),
                    ],
                    schema=schema,
                )

    return postings


def benchmark_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """``item``, ``window`` (its identity) and ``terms``, a row for each window of each item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return items.mapInArrow(_windows(size), "item string, window long, terms array<long>")


def _to_tasks(spark, terms: DataFrame, limit: int):
    """A broadcast set of the distinct terms, or None if there are more than the limit."""
    terms = kept_table(terms.distinct(), "terms")
    if terms.count() > limit:
        return None
    return spark.sparkContext.broadcast(WordSet(terms.toPandas()["term"].to_numpy(np.int64).view(np.uint64)))


def ranked_windows(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``window``, ``length`` and ``ranked``: its words (times, off, term), the rarest first."""
    distinct = windows.groupBy("window").agg(F.first("terms").alias("terms"))
    return (
        distinct.select("window", F.size("terms").alias("length"), F.posexplode("terms").alias("off", "term"))
        .join(counts, "term")
        .groupBy("window", "length")
        .agg(F.sort_array(F.collect_list(F.struct("times", "off", "term"))).alias("ranked"))
        .where(F.size("ranked") == F.col("length"))
    )


def phrase_matches(postings: DataFrame, ranked: DataFrame, slop: int = 0) -> DataFrame:
    """``doc``, ``window``, ``start``, ``length`` of each place where a window occurs.

    postings: ``doc``, ``pos``, ``term``. Words may be off by ``slop`` places, the rarest is not.
    """
    rarest = ranked.select(
        "window", "length", F.col("ranked")[0]["term"].alias("term"), F.col("ranked")[0]["off"].alias("off"),
        F.get("ranked", F.lit(1)).alias("second"),
    )
    found = (
        postings.join(rarest, "term")
        .select("doc", "window", "length", (F.col("pos") - F.col("off")).alias("start"), "second")
        .where(F.col("start") >= -slop)
        .distinct()
    )

    def present(wanted: DataFrame) -> DataFrame:
        if slop:
            wanted = wanted.withColumn("pos", F.explode(F.expr(f"sequence(pos - {slop}, pos + {slop})")))
        return wanted.join(postings, ["doc", "pos", "term"], "left_semi")

    two = present(
        found.where("second is not null").withColumns({"pos": F.col("start") + F.col("second.off"), "term": F.col("second.term")})
    ).select("doc", "window", "length", "start").distinct()
    others = ranked.where("length > 2").select("window", F.expr("slice(ranked, 3, length)").alias("others"))
    more = two.where("length > 2").join(others, "window").select("doc", "window", "length", "start", F.inline("others"))
    whole = (
        present(more.withColumn("pos", F.col("start") + F.col("off")))
        .select("doc", "window", "length", "start", "off")
        .distinct()
        .groupBy("doc", "window", "length", "start")
        .agg(F.count("*").alias("found"))
        .where("found = length - 2")
        .drop("found")
    )
    one = found.where("length = 1").drop("second")
    return whole.unionByName(two.where("length = 2")).unionByName(one.select(*whole.columns))


def document_key() -> F.Column:
    """The same for rows of the same id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, size: int = 13, percent: int = 5, vocabulary_limit: int = VOCABULARY_LIMIT
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``,
    ``contaminated`` (hits make up ``percent`` or more of the words) and ``doc``, its key.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), document_key().alias("doc"), "text")
    windows = kept_table(benchmark_windows(benchmark, size), "windows")
    vocabulary = _to_tasks(spark, windows.select(F.explode("terms").alias("term")), vocabulary_limit)
    counts = docs.select("text").mapInArrow(_counts(vocabulary), "term long, times long").groupBy("term").agg(F.sum("times").alias("times"))
    ranked = kept_table(ranked_windows(windows, counts), "ranked")
    anchors = _to_tasks(spark, ranked.select(F.col("ranked")[0]["term"].alias("term")), vocabulary_limit) if vocabulary else None
    index = kept_table(
        docs.mapInArrow(
            _postings(vocabulary, anchors, size - 1), "doc_id long, doc long, n_words long, at array<int>, terms array<long>"
        ),
        "index",
    )
    postings = index.select("doc", F.inline(F.arrays_zip(F.col("at").alias("pos"), F.col("terms").alias("term")))).toDF("doc", "pos", "term")
    matches = kept_table(phrase_matches(postings, ranked), "matches")
    in_order = Window.partitionBy("doc").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    hits = (
        matches.select("doc", "start", (F.col("start") + F.col("length")).alias("end"))
        .distinct()
        .withColumn("done", F.coalesce(F.max("end").over(in_order), F.col("start")))
        .groupBy("doc")
        .agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "done"))).cast("long").alias("n_hit"))
    )
    items = (
        matches.select("doc", "window")
        .distinct()
        .join(windows.select("window", "item").distinct(), "window")
        .groupBy("doc")
        .agg(F.collect_set("item").alias("items"))
    )
    listed = F.coalesce(F.array_join(F.sort_array("items"), ","), F.lit(""))
    return (
        index.select("doc_id", "doc", "n_words")
        .join(hits, "doc", "left")
        .join(items, "doc", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
            F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
            F.sha2(listed, 256).alias("items_sha256"),
            F.expr(f"coalesce(n_hit > 0 and 100 * n_hit >= {percent} * n_words, false)").alias("contaminated"),
            "doc",
        )
    )
