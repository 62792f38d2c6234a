"""License notices in documents by an exact set-similarity join (operator 11).

Templates are sets of words. A text block is any run of a template's ``span`` consecutive words, and it meets the template
if it contains ``percent`` of the template's distinct words. All blocks of all texts that do are found:

1. The words of all templates are counted over all documents and put in one order, from rare to frequent.
2. A block with enough of a template's n words, k of them, has one of its n - k + 1 rarest: its *prefix*. Only
   the places of prefix words open candidate blocks, so frequent words open none.
3. A place of the prefix word of rank i is dropped by position if fewer than k words of ranks from i on are left, in the
   template or within reach of the place; blocks with fewer than k places of any rank drop by length.
4. In what is left, the distinct words of every block are counted in one sweep. Overlapping blocks of a template
   are reported once, by the fullest and then the first.

Phrases (``ordered``) ask for all words, next to each other and in order, and each place is reported.

Null and blank texts have no words and no blocks; equal texts and repeated rows give equal rows, an empty table none.
Words are compared by 64-bit hashes. Columns other than ``doc_id`` and ``text`` aren't read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm import words

#: Words of texts and templates, behind lower-cased A to Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

BLOCKS = "array<struct<label: string, begin: long, end: long, found: long, of: long, ordered: boolean>>"


@dataclass(frozen=True)
class Template:
    """Words to be found in a block; ``slack`` words may stand between them, and what ``percent`` leaves out is free too."""

    label: str
    text: str
    percent: int = 100
    slack: int = 0
    ordered: bool = False

    @property
    def sequence(self) -> list[str]:
        return re.findall(WORD, re.sub("[A-Z]", lambda x: x[0].lower(), self.text))

    @property
    def words(self) -> set[str]:
        return set(self.sequence)

    @property
    def needed(self) -> int:
        return -(-len(self.words) * self.percent // 100)

    @property
    def span(self) -> int:
        return len(self.sequence) + self.slack


#: Phrases with their labels.
PHRASES = (
    Template("mit", "under the mit license", ordered=True),
    Template("apache-2", "apache license version 2", ordered=True),
    Template("cc-by-nc", "cc by nc", ordered=True),
)
#: Notices of common licenses, and their names with a version near them.
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", 80, 5),
    Template("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at", 80, 5),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", 80, 5),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 85, 5),
    Template("unlicense", "this is free and unencumbered software released into the public domain", 85, 3),
    Template("mit", "the mit license", 100, 1),
    Template("apache-2", "apache license 2", 100, 3),
    Template("gpl-2", "gnu general public license version 2", 100, 14),
    Template("gpl-3", "gnu general public license version 3", 100, 14),
    Template("lgpl", "gnu lesser general public license", 100, 2),
    Template("agpl", "gnu affero general public license", 100, 2),
    Template("mpl-2", "mozilla public license 2", 100, 3),
    Template("cc-by-nc", "creative commons attribution noncommercial", 100, 2),
    Template("cc-by-sa", "creative commons attribution sharealike", 100, 2),
    Template("cc-by-sa", "cc by sa", 100),
    Template("cc0", "creative commons cc0 universal", 100, 4),
)


def word_hash(*texts: str) -> np.ndarray:
    at = words.texts(pa.array(texts))
    starts, ends, _ = words.spans(at, words.ALPHANUMERIC)
    return words.span_hashes(at.data, starts, ends)


@dataclass
class Occurrences:
    """Where words of the templates stand in the texts of a batch."""

    n_words: np.ndarray
    text: np.ndarray
    place: np.ndarray  # of the word in its text
    word: np.ndarray  # its number among the templates' words


def occurrences(column: pa.Array, vocabulary: np.ndarray) -> Occurrences:
    """vocabulary: sorted hashes."""
    at = words.texts(column).lower()
    starts, ends, first = words.spans(at, words.ALPHANUMERIC)
    hashes = words.span_hashes(at.data, starts, ends)
    near = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = np.flatnonzero(vocabulary[near] == hashes)
    text = np.searchsorted(first, known, "right") - 1
    return Occurrences(np.diff(first), text, known - first[text], near[known])


def _counts(vocabulary: np.ndarray):
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for part in words.pieces(batch, "text"):
                total += np.bincount(occurrences(part.column("text"), vocabulary).word, minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["word", "times"])

    return counts


@dataclass
class Plan:
    """A template against the order of words: the rank of each word of the vocabulary in the template, or -1."""

    template: Template
    rank: np.ndarray
    sequence: np.ndarray


def ordered_plans(templates: tuple[Template, ...], known: list[str], number: dict[str, int], times: np.ndarray) -> list[Plan]:
    """Rank the words of each template from rare to frequent over the corpus, ties by the word."""
    plans = []
    for template in templates:
        by_rarity = sorted(template.words, key=lambda x: (times[number[x]], x))
        rank = np.full(len(known), -1)
        rank[[number[x] for x in by_rarity]] = np.arange(len(by_rarity))
        plans.append(Plan(template, rank, np.array([number[x] for x in template.sequence])))
    return plans


def _between(sorted_places: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """How many places there are from low to high."""
    return np.searchsorted(sorted_places, high, "right") - np.searchsorted(sorted_places, low, "left")


def candidates(place: np.ndarray, rank: np.ndarray, template: Template) -> np.ndarray:
    """Places of the template's words (as indexes) that a block with enough of them may hold."""
    size, needed, span = len(template.words), template.needed, template.span
    open_at = [np.zeros(0, np.int64)]
    for low in range(size - needed + 1):
        prefix = place[rank == low]
        if len(prefix):
            left = _between(place[rank >= low], prefix - span + 1, prefix + span - 1)
            open_at.append(prefix[np.minimum(size - low, left) >= needed])
    opened = np.sort(np.concatenate(open_at))
    if not len(opened):
        return opened
    return np.flatnonzero(_between(opened, place - span + 1, place + span - 1) > 0)


def full_blocks(place: np.ndarray, rank: np.ndarray, template: Template) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of places at which blocks with enough distinct words begin, and how many these have."""
    none = np.zeros(0, np.int64)
    if not len(place):
        return none, none
    # A word counts for blocks that begin behind its place before and up to itself.
    by_word = np.lexsort((place, rank))
    before = np.full(len(place), -template.span - 1)
    same = np.flatnonzero(rank[by_word[1:]] == rank[by_word[:-1]])
    before[by_word[same + 1]] = place[by_word[same]]
    begin = np.searchsorted(place, np.maximum(before, place - template.span) + 1)
    change = np.bincount(begin, minlength=len(place) + 1) - np.bincount(np.arange(len(place)) + 1, minlength=len(place) + 1)
    found = np.cumsum(change)[:-1]
    good = np.flatnonzero(found >= template.needed)
    return good, found[good]


def fullest(place: np.ndarray, found: np.ndarray, span: int) -> np.ndarray:
    """The first of the fullest blocks in each chain of overlapping ones (indexes)."""
    if not len(place):
        return place
    chain = np.concatenate([[0], np.cumsum(place[1:] - place[:-1] >= span)])
    order = np.lexsort((place, -found, chain))
    return order[np.concatenate([[True], chain[order][1:] != chain[order][:-1]])]


def blocks_of(got: Occurrences, plans: list[Plan]) -> list[list[dict]]:
    """Blocks of each text, in the order of the templates and places."""
    out: list[list[dict]] = [[] for _ in got.n_words]
    # Texts lie so far apart that no block reaches from one into the next.
    gap = max((plan.template.span for plan in plans), default=0)
    shift = np.concatenate([[0], np.cumsum(got.n_words + gap)])[:-1]
    all_places = got.place + shift[got.text]
    for plan in plans:
        template, size = plan.template, len(plan.template.words)
        own = np.flatnonzero(plan.rank[got.word] >= 0)
        own = own[candidates(all_places[own], plan.rank[got.word[own]], template)]
        at, found = full_blocks(all_places[own], plan.rank[got.word[own]], template)
        if template.ordered:
            count = len(plan.sequence)
            at = at[at + count <= len(own)]
            same = np.ones(len(at), bool)
            for k, word in enumerate(plan.sequence):
                same &= (got.word[own[at + k]] == word) & (all_places[own[at + k]] == all_places[own[at]] + k)
            at = at[same]
            found = np.full(len(at), size)
        else:
            kept = fullest(all_places[own[at]], found, template.span)
            at, found = at[kept], found[kept]
        for k, n in zip(own[at], found):
            text, begin = int(got.text[k]), int(got.place[k])
            end = min(begin + template.span, int(got.n_words[text]))
            out[text].append({"label": template.label, "begin": begin, "end": end, "found": int(n), "of": size, "ordered": template.ordered})
    return out


def _scan(vocabulary: np.ndarray, plans: list[Plan]):
    block = pa.struct([("label", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("found", pa.int64()), ("of", pa.int64()), ("ordered", pa.bool_())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.pieces(batch, "text"):
                got = occurrences(part.column("text"), vocabulary)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(got.n_words.astype(np.int64)), pa.array(blocks_of(got, plans), pa.list_(block))],
                    names=["doc_id", "n_words", "blocks"],
                )

    return scan


def license_blocks(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words`` and ``blocks``, with the words ``begin`` to ``end`` (not included)
    of each text block, the ``label`` of its template, and how many distinct words of the template are ``found``.

    What is collected is a count for each word of the templates.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = sorted({x for template in templates for x in template.words})
    hashes = word_hash(*known)
    order = np.argsort(hashes)
    vocabulary, number = hashes[order], {known[k]: int(n) for n, k in enumerate(order)}
    counted = docs.mapInArrow(_counts(vocabulary), "word long, times long").groupBy("word").agg(F.sum("times").alias("times"))
    times = np.zeros(len(known), np.int64)
    for row in counted.collect():
        times[row["word"]] = row["times"]
    plans = ordered_plans(templates, known, number, times)
    return docs.mapInArrow(_scan(vocabulary, plans), f"doc_id long, n_words long, blocks {BLOCKS}")


def license_report(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_base`` (places of phrases), ``first_word`` and ``last_word`` of these,
    ``base_labels``, ``labels`` (of all blocks), and ``score``, the largest containment of a block or 0.
    """
    named = lambda rows: F.array_join(F.array_sort(F.array_distinct(F.transform(rows, lambda x: x["label"]))), ",")
    phrases = F.filter("blocks", lambda x: x["ordered"])
    begins = F.transform(phrases, lambda x: x["begin"])
    return license_blocks(docs, templates).select(
        "doc_id",
        "n_words",
        F.size(phrases).cast("long").alias("n_base"),
        F.array_min(begins).alias("first_word"),
        F.array_max(begins).alias("last_word"),
        named(phrases).alias("base_labels"),
        named(F.col("blocks")).alias("labels"),
        F.coalesce(F.array_max(F.transform("blocks", lambda x: x["found"] / x["of"])), F.lit(0.0)).alias("score"),
    )
