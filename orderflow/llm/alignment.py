"""Alignment of the tokens of two tokenizers (operator 13).

A is a byte-level BPE, given the text behind a space; B is a piece model that puts this space in itself. Both
then spell the same bytes. For each text the ends of A's tokens, in bytes, are the keys of one dictionary and those of
B's tokens of another, each with the token's number. The keys that both have, sorted, slice the two
lists of ids into groups; in each slice the tokens that end with it are linked, every A with every B.

Links are summed by their pair of ids within a text, then over the corpus. One of two linked tokens ends with all
bytes of the other, so there are no more pairs than bytes in both vocabularies: the table
of their counts is broadcast whatever the corpus, and texts meet it where they lie.

Null and empty texts, and texts that A or B doesn't spell to the byte (sentence pieces may change white space),
have no tokens and no groups. Equal texts, repeated rows and null ids give equal rows; no rows give none.
Other columns than ``doc_id`` and ``text`` aren't read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm import words
from orderflow.llm.tables import kept_table

#: The split of byte-level BPE into words, and the mark for a space in sentence pieces.
BYTE_LEVEL_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE_MARK = "▁"

SCHEMA = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
)


@cache
def byte_of() -> dict[str, int]:
    """The byte behind each character of a byte-level entry: itself if it is visible, else the next free one from U+0100."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _in_order(of_ids: dict[int, bytes]) -> list[bytes]:
    return [of_ids.get(k, b"") for k in range(max(of_ids, default=-1) + 1)]


class ByteLevel:
    """A: ids of texts by a byte-level BPE in the ``tokenizers`` format, without special tokens."""

    def __init__(self, spec: bytes):
        held = json.loads(spec)
        model, split = held["model"], held["pre_tokenizer"]
        entries = model["vocab"] | {x["content"]: x["id"] for x in held["added_tokens"] if not x["special"]}
        decode = byte_of()
        self.bytes = _in_order({k: bytes(map(decode.__getitem__, x)) for x, k in entries.items()})
        merges = ["".join(x.split(" ") if isinstance(x, str) else x) for x in model["merges"]]
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}.items() <= split.items()
        by_rank = [model["vocab"].get(x) for x in merges] == list(range(256, 256 + len(merges)))
        options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
        ordinary = not any(model.get(x) for x in options) and len(entries) == 256 + len(merges)
        if plain and by_rank and ordinary and held["normalizer"] is None:
            # Ids are ranks of merges: the same vocabulary by the engine that is four times as fast.
            ranks = {x: k for k, x in enumerate(self.bytes)}
            self._encode = tiktoken.Encoding("given", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            engine = tokenizers.Tokenizer.from_str(spec.decode())
            engine.encode_special_tokens = True
            self._encode = lambda text: engine.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._encode(text) for text in texts]


class Pieces:
    """B: ids of texts by a sentence piece model, which begins each text with a space."""

    def __init__(self, model: bytes):
        self.engine = sentencepiece.SentencePieceProcessor(model_proto=model)
        count = self.engine.get_piece_size()
        self.bytes = [
            bytes([int(self.engine.id_to_piece(k)[1:-1], 16)])
            if self.engine.is_byte(k)
            else self.engine.id_to_piece(k).replace(SPACE_MARK, " ").encode()
            for k in range(count)
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.engine.encode(texts, num_threads=1)


@cache
def loaded(kind: type, model: bytes) -> ByteLevel | Pieces:
    """Once for each Python worker."""
    return kind(model)


@dataclass
class Aligned:
    """One text: how many tokens of A and of B lie before the end of each group, and the links."""

    a: np.ndarray
    b: np.ndarray
    upto_a: np.ndarray
    upto_b: np.ndarray
    links: list[tuple[int, int]] | np.ndarray

    def groups(self) -> bytes:
        """Groups as ``a1,a2|b1;a3|b2,b3``."""
        count = len(self.upto_a)
        out = np.empty(len(self.a) + len(self.b), "S12")
        before_a, before_b = np.diff(self.upto_a, prepend=0), np.diff(self.upto_b, prepend=0)
        # A token comes behind all groups before its own, and B's behind the A's of its own group.
        place_a = np.arange(len(self.a)) + np.repeat(self.upto_b - before_b, before_a)
        place_b = np.arange(len(self.b)) + np.repeat(self.upto_a, before_b)
        for ids, place, last, mark in ((self.a, place_a, self.upto_a, b"|"), (self.b, place_b, self.upto_b, b";")):
            table = decimals(int(ids.max(initial=0)).bit_length())
            text = table[0][ids]
            ends = last[np.diff(last, prepend=0) > 0] - 1
            text[ends] = table[1 if mark == b"|" else 2][ids[ends]]
            out[place] = text
        # A group without tokens on one side would lack its mark; both sides have some, as cuts ascend.
        assert count == 0 or (before_a.all() and before_b.all())
        return out.tobytes().translate(None, b"\0")[:-1]


@cache
def decimals(bits: int) -> list[np.ndarray]:
    """Ids of so many bits as text, before a comma, a bar and a semicolon."""
    plain = np.arange(1 << bits).astype("S11")
    return [np.char.add(plain, mark) for mark in (b",", b"|", b";")]


def ends_of(ids: list[int], lengths: list[int]) -> dict[int, int]:
    """From each end, in bytes, to the number of tokens up to it."""
    return dict(zip(itertools.accumulate(map(lengths.__getitem__, ids)), itertools.count(1)))


def align(a: list[int], b: list[int], lengths_a: list[int], lengths_b: list[int], some_empty: bool) -> Aligned:
    """Align the tokens of a text that both tokenizers spell alike; ``some_empty`` if a token may have no bytes."""
    index_a, index_b = ends_of(a, lengths_a), ends_of(b, lengths_b)
    cuts = sorted(index_a.keys() & index_b.keys())
    upto_a = np.fromiter(map(index_a.__getitem__, cuts), np.int64, len(cuts))
    upto_b = np.fromiter(map(index_b.__getitem__, cuts), np.int64, len(cuts))
    ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
    if some_empty:
        links = [(x, y) for i, k in zip(upto_a, upto_b) for x in ending(a, i, lengths_a) for y in ending(b, k, lengths_b)]
        links = np.array(links, np.int64).reshape(-1, 2)
    else:
        links = np.stack([ids_a[upto_a - 1], ids_b[upto_b - 1]], 1)
    return Aligned(ids_a, ids_b, upto_a, upto_b, links)


def ending(ids: list[int], upto: int, lengths: list[int]) -> list[int]:
    """The tokens that end where the first ``upto`` do: the last one with bytes, and those without behind it."""
    first = upto - 1
    while first > 0 and lengths[ids[first]] == 0:
        first -= 1
    return ids[first:upto]


def _aligned(models, digests: bool):
    """models: a broadcast of both models."""
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool_a, tool_b = loaded(ByteLevel, models.value[0]), loaded(Pieces, models.value[1])
        lengths_a, lengths_b = [len(x) for x in tool_a.bytes], [len(x) for x in tool_b.bytes]
        scale, some_empty = len(lengths_b), 0 in lengths_a or 0 in lengths_b
        for batch in batches:
            for part in words.pieces(batch, "text", 1 << 20):
                texts = [x or "" for x in part.column("text").to_pylist()]
                counts, groups, pairs, times = [], [], [], []
                for text, a, b in zip(texts, tool_a.encode([" " + x for x in texts]), tool_b.encode(texts)):
                    spelled = (" " + text).encode()
                    if (
                        not text
                        or b"".join(map(tool_a.bytes.__getitem__, a)) != spelled
                        or b"".join(map(tool_b.bytes.__getitem__, b)) != spelled
                    ):
                        a = b = []
                    got = align(a, b, lengths_a, lengths_b, some_empty)
                    counts.append((len(a), len(b), len(got.upto_a), len(got.links)))
                    shown = got.groups()
                    groups.append(hashlib.sha256(shown).hexdigest() if digests and a else shown.decode())
                    own, often = np.unique(got.links[:, 0] * scale + got.links[:, 1], return_counts=True)
                    pairs.append(own)
                    times.append(often)
                bounds = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in pairs])]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(x).astype(np.int64))) for x in (pairs, times)]
                four = [pa.array(x, pa.int64()) for x in zip(*counts)]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("doc_id"), *four, pa.array(groups, pa.string()), *lists], names=names)

    return aligned


def align_tokenizers(docs: DataFrame, byte_level: str, pieces: str, digests: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups``.

    byte_level, pieces: paths on the driver of the two models. ``groups`` is ``a1,a2|b1;a3|b2,b3``, ids in order, several
    times as long as the text; with ``digests`` its SHA-256 is written in its place, '' without tokens.
    """
    spark = docs.sparkSession
    models = []
    for path in (byte_level, pieces):
        with open(path, "rb") as held:
            models.append(held.read())
    scale = len(loaded(Pieces, models[1]).bytes)
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = kept_table(numbered.mapInArrow(_aligned(spark.sparkContext.broadcast(models), digests), SCHEMA), "aligned")
    linked = texts.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))
    counts = kept_table(linked.groupBy("pair").agg(F.sum("times").alias("count")), "pairs")
    of_b = F.col("pair") % scale
    highest = counts.groupBy(of_b.alias("b")).agg(F.max("count").alias("highest"))
    best = counts.join(F.broadcast(highest), of_b == F.col("b")).select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    sums = (
        linked.join(F.broadcast(best), "pair")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    )
    none = F.lit(0).cast("long")
    return texts.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups",
    )
