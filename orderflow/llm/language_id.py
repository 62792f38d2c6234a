"""Language of whole texts by rank-order profiles (operator 3).

A language's profile is its most frequent character n-grams (n from 1 to 3, words marked at both
ends by ``_``) in rank order, counted over all training documents. A document's own ranking is
compared with each profile by out-of-place distance: the sum over the document's n-grams of how
far their ranks differ, with the profile's size for those it lacks. The nearest language wins, the
first by name in a tie; equal counts rank by the n-gram itself.

Letters are those of Unicode, lower-cased; all else divides words. Only ``lang`` and ``text`` of rows that the
caller marks for training are learned from. Null texts and texts without a letter get ``und`` with score 0, as does
everything if there is nothing to learn from.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.llm.tables import kept_table

UNDETERMINED = "und"
GRAM = 21  # bits of a code point
MARK = ord("_")
CHUNK = 1 << 20  # characters that are counted at once


@cache
def letters() -> np.ndarray:
    """For each code point the lower-case letter, or 0 if it is none."""
    table = np.zeros(0x110000, np.int32)
    for point in range(0x110000):
        if not 0xD800 <= point < 0xE000:
            char = chr(point)
            if char.isalpha():
                low = char.lower()
                table[point] = ord(low) if len(low) == 1 else point
            elif unicodedata.category(char) in ("Mn", "Mc") and point > 0x7F:
                table[point] = point
    return table


def _counted(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-grams, sorted, and counts of a sequence of code points and marks."""
    if seq.max() < 4096:
        used = np.flatnonzero(np.bincount(seq, minlength=4096))
    else:
        used = np.unique(seq)
    width = len(used)
    if width**3 > max(1 << 16, 4 * len(seq)):
        one, two = seq[seq != MARK], (seq[:-1] << GRAM) | seq[1:]
        three = ((seq[:-2] << 2 * GRAM) | (seq[1:-1] << GRAM) | seq[2:])[seq[1:-1] != MARK]
        return np.unique(np.concatenate([one, two, three]), return_counts=True)
    # With few different letters a cell for each n-gram is faster than sorting.
    ids = np.searchsorted(used, seq) if used[-1] >= 4096 else _places(used)[seq]
    mark = int(np.searchsorted(used, MARK)) if MARK in used else -1
    two = ids[:-1] * width + ids[1:]
    cells = [np.bincount(ids, minlength=width), np.bincount(two, minlength=width**2), np.bincount(two[:-1] * width + ids[2:], minlength=width**3)]
    if mark >= 0:
        cells[0][mark] = 0
        cells[2].reshape(width, width, width)[:, mark] = 0
    at = [np.flatnonzero(x) for x in cells]
    grams = [
        used[at[0]],
        (used[at[1] // width] << GRAM) | used[at[1] % width],
        (used[at[2] // width**2] << 2 * GRAM) | (used[at[2] // width % width] << GRAM) | used[at[2] % width],
    ]
    return np.concatenate(grams), np.concatenate([x[k] for x, k in zip(cells, at)])


def _places(used: np.ndarray) -> np.ndarray:
    table = np.zeros(4096, np.int64)
    table[used] = np.arange(len(used))
    return table


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text and how often each occurs, counted a part of the text at a time."""
    grams, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = 0
    while at < len(text):
        end = min(len(text), at + CHUNK)
        # A part ends at a character that is no letter, unless a word is longer than a part.
        while end < len(text) and end > at + CHUNK // 2 and text[end - 1].isalpha():
            end -= 1
        points = letters()[np.frombuffer(text[at:end].encode("utf-32-le", "replace"), np.uint32)].astype(np.int64)
        at = end
        points = np.concatenate([[0], points, [0]])
        inside = points > 0
        # One mark between words: keep letters, and others that follow or precede a letter only once.
        keep = inside | np.concatenate([[False], inside[:-1]]) | np.concatenate([inside[1:], [False]])
        if not inside.any():
            continue
        seq = np.where(inside, points, MARK)[keep]
        double = np.concatenate([[False], (seq[1:] == MARK) & (seq[:-1] == MARK)])
        seq = seq[~double]
        found, number = _counted(seq)
        if len(grams):
            found, inverse = np.unique(np.concatenate([grams, found]), return_inverse=True)
            number = np.bincount(inverse, np.concatenate([times, number])).astype(np.int64)
        grams, times = found, number
    return grams, times


def ranked(grams: np.ndarray, times: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, by count and then by n-gram (the input is sorted by n-gram)."""
    if len(grams) > size:
        least = np.partition(times, len(times) - size)[len(times) - size]
        grams, times = grams[times >= least], times[times >= least]
    return grams[np.argsort(-times, kind="stable")][:size]


def _training_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts (lang, gram, times), given out whenever they are many."""
    sums: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    held = 0

    def combined() -> Iterator[pa.RecordBatch]:
        for lang, parts in sums.items():
            grams, inverse = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            times = np.bincount(inverse, np.concatenate([t for _, t in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]).take(pa.array(np.zeros(len(grams), np.int64))), pa.array(grams), pa.array(times)], names=["lang", "gram", "times"]
            )
        sums.clear()

    for batch in batches:
        together: dict[str, list[str]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            together.setdefault(lang, []).append(text)
        for lang, parts in together.items():
            # A space keeps words of two texts apart.
            grams, times = gram_counts(" ".join(parts))
            sums.setdefault(lang, []).append((grams, times))
            held += len(grams)
        if held > 4_000_000:
            yield from combined()
            held = 0
    yield from combined()


@dataclass
class Profiles:
    langs: list[str]
    grams: np.ndarray  # all n-grams of any profile, sorted
    ranks: np.ndarray  # of each n-gram in each language; ``size`` where it lacks the n-gram
    size: int


def learn_profiles(training: DataFrame, size: int) -> Profiles:
    """Profiles from ``lang`` and ``text``; the driver gets ``size`` n-grams a language."""
    counts = kept_table(
        training.where("lang is not null and text is not null")
        .select("lang", "text")
        .mapInArrow(_training_counts, "lang string, gram long, times long")
        .groupBy("lang", "gram")
        .agg(F.sum("times").alias("times")),
        "grams",
    )
    in_order = Window.partitionBy("lang").orderBy(F.desc("times"), "gram")
    top = counts.withColumn("rank", F.row_number().over(in_order) - 1).where(F.col("rank") < size).select("lang", "gram", "rank").toPandas()
    langs = sorted(top["lang"].unique())
    grams = np.unique(top["gram"].to_numpy(np.int64))
    ranks = np.full((len(grams), len(langs)), size, np.int64)
    number = {lang: k for k, lang in enumerate(langs)}
    ranks[np.searchsorted(grams, top["gram"]), top["lang"].map(number)] = top["rank"]
    return Profiles(langs, grams, ranks, size)


def predicted(text: str | None, profiles: Profiles) -> tuple[str, float]:
    """Language and score: by how much of the largest possible distance the nearest profile is nearer than that."""
    grams, times = gram_counts(text or "")
    own = ranked(grams, times, profiles.size)
    # Marks take part in n-grams, but are no letters by themselves.
    if not len(own) or not profiles.langs or not any(map(str.isalpha, text)):
        return UNDETERMINED, 0.0
    at = np.minimum(np.searchsorted(profiles.grams, own), len(profiles.grams) - 1)
    ranks = np.where((profiles.grams[at] == own)[:, None], profiles.ranks[at], profiles.size)
    places = np.arange(len(own))[:, None]
    away = np.where(ranks == profiles.size, profiles.size, np.abs(ranks - places)).sum(0)
    best = int(np.argmin(away))
    return profiles.langs[best], float(1 - away[best] / (profiles.size * len(own)))


def identify_languages(docs: DataFrame, training: Column, size: int = 400) -> DataFrame:
    """One row per document: ``doc_id``, ``text``'s ``lang_pred`` and ``score`` (0 to 1).

    training: true for the rows to learn from. Predictions read the text only.
    """
    profiles = docs.sparkSession.sparkContext.broadcast(learn_profiles(docs.where(training), size))

    def predictions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [predicted(text, profiles.value) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        predictions, "doc_id long, lang_pred string, score double"
    )
