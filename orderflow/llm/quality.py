"""Quality rules by distribution divergence (operator 7).

Each language of the corpus gets two reference distributions, counted over all its documents:
character classes, and common words (hash buckets of words; the ``COMMON`` fullest are bins, the
rest is one bin). A document is rejected when the Jensen-Shannon distance of one of its histograms
to its language's reference is above a limit. Short texts have noisy histograms: below
``MIN_WORDS`` words nothing is rejected by distance, and each limit is raised by what sampling
alone gives at a document's length.

Base rules come first: too few words, or too many in repeated three-word windows. Null texts have
no words and fail them. A document without a language, or of one with no reference, is compared
with all references and takes the nearest; without any reference only base rules count.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm import words
from orderflow.llm.tables import kept_table

BUCKETS = 1 << 14
COMMON = 200
MIN_WORDS = 50
NOISE_SHARE = 0.3
CLASSES = ("white", "lower", "upper", "digit", "stop", "quote", "bracket", "mark", "symbol", "control", "beyond ASCII")

_SYMBOL = np.array([chr(b) in "#*$%&|<>" for b in range(256)])
_NOT_NEWLINE = np.array([b != 0x0A for b in range(256)])


def _class_of(byte: int) -> int:
    char = chr(byte)
    if byte >= 0x80:
        return 10
    for k, chars in ((0, " \t\n\v\f\r"), (4, ".,;:!?"), (5, "\"'`"), (6, "()[]{}"), (8, "#*$%&|<>")):
        if char in chars:
            return k
    if byte < 0x20 or byte == 0x7F:
        return 9
    return 1 if char.islower() else 2 if char.isupper() else 3 if char.isdigit() else 7


_CLASS = np.array([_class_of(b) for b in range(256)])
#: Bytes that begin a character.
_BEGINS = np.array([b & 0xC0 != 0x80 for b in range(256)])


@dataclass
class Counted:
    """Counts of each text of a batch."""

    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    classes: np.ndarray
    buckets: np.ndarray
    of: np.ndarray


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _often(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    _, inverse, times = np.unique(keys, return_inverse=True, return_counts=True)
    return times[inverse] > 1


def counted(column: pa.Array, base: bool = True) -> Counted:
    at = words.texts(column)
    count = len(at.bounds) - 1
    starts, ends, first = words.spans(at, words.NOT_WHITE)
    hashes = words.span_hashes(at.data, starts, ends)
    n_words = np.diff(first)
    of = np.repeat(np.arange(count), n_words)
    begins = _BEGINS[at.data]
    text_of = np.repeat(np.arange(count), np.diff(at.bounds))
    classes = np.bincount(text_of[begins] * len(CLASSES) + _CLASS[at.data[begins]], minlength=count * len(CLASSES))
    zeros = np.zeros(count, np.int64)
    out = Counted(n_words, zeros, zeros, zeros, zeros, classes.reshape(count, -1), (hashes % np.uint64(BUCKETS)).astype(np.int64), of)
    if not base:
        return out
    out.word_chars = _per_text(begins & words.NOT_WHITE[at.data], at.bounds)
    out.n_symbols = _per_text(_SYMBOL[at.data], at.bounds)
    with np.errstate(over="ignore"):
        salt = words.mix(np.arange(1, count + 1, dtype=np.uint64))
        line_starts, line_ends, _ = words.spans(at, _NOT_NEWLINE)
        filled = np.concatenate([[0], np.cumsum(words.NOT_WHITE[at.data], dtype=np.int64)])
        good = filled[line_ends] > filled[line_starts]
        line_starts, line_ends = line_starts[good], line_ends[good]
        line_of = np.searchsorted(at.bounds, line_starts, "right") - 1
        lines = words.span_hashes(at.data, line_starts, line_ends) ^ salt[line_of]
        _, one = np.unique(lines, return_index=True)
        out.n_dup_lines = np.bincount(line_of, minlength=count) - np.bincount(line_of[one], minlength=count)
        triples = words.runs(hashes, 3)
        whole = np.flatnonzero(of[: len(triples)] == of[len(of) - len(triples) :]) if len(triples) else np.zeros(0, np.int64)
        again = whole[_often(triples[whole] ^ salt[of[whole]])]
    repeated = np.zeros(len(hashes), bool)
    for k in range(3):
        repeated[again + k] = True
    out.n_repeat_words = np.bincount(of[repeated], minlength=count)
    return out


def _references(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row (lang, bin, times) of each bin that a task's documents have; buckets come behind classes."""
    sums: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in sums.items():
            bins = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(bins), pa.string()), pa.array(bins), pa.array(counts[bins])], names=["lang", "bin", "times"]
            )
        sums.clear()

    for batch in batches:
        for part in words.pieces(batch, "text"):
            got = counted(part.column("text"), base=False)
            langs, codes = np.unique(np.array(part.column("lang").to_pylist(), object).astype(str), return_inverse=True)
            for k, lang in enumerate(langs):
                counts = sums.setdefault(lang, np.zeros(len(CLASSES) + BUCKETS, np.int64))
                counts[: len(CLASSES)] += got.classes[codes == k].sum(0)
                counts[len(CLASSES) :] += np.bincount(got.buckets[codes[got.of] == k], minlength=BUCKETS)
        if len(sums) > 64:
            yield from flush()
    yield from flush()


@dataclass
class References:
    langs: list[str]
    classes: np.ndarray
    words: np.ndarray
    slot: np.ndarray  # of each language and bucket; COMMON is the bin of the rest


def learn_references(docs: DataFrame) -> References:
    """Reference distributions, of a fixed size for each language, from all its documents."""
    counts = kept_table(
        docs.where("lang is not null and text is not null")
        .select("lang", "text")
        .mapInArrow(_references, "lang string, bin long, times long")
        .groupBy("lang", "bin")
        .agg(F.sum("times").alias("times")),
        "references",
    )
    size = len(CLASSES)
    few = counts.where(f"bin < {size}").unionByName(
        counts.where(f"bin >= {size}")
        .groupBy("lang")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("times", "bin")), asc=False), 1, COMMON).alias("top"), F.sum("times").alias("all"))
        .select("lang", F.inline(F.expr("concat(top, array(struct(all as times, -1L as bin)))")))
        .select("lang", "bin", "times")
    )
    table = few.toPandas()
    langs = sorted(table["lang"].unique())
    classes, slot = np.zeros((len(langs), size)), np.full((len(langs), BUCKETS), COMMON, np.int16)
    common = np.zeros((len(langs), COMMON + 1))
    for k, lang in enumerate(langs):
        own = table[table["lang"] == lang].sort_values(["times", "bin"], ascending=[False, True])
        low = own[(own["bin"] >= 0) & (own["bin"] < size)]
        classes[k, low["bin"]] = low["times"]
        top = own[own["bin"] >= size]
        slot[k, top["bin"] - size] = np.arange(len(top))
        common[k, : len(top)] = top["times"]
        common[k, COMMON] = own.loc[own["bin"] == -1, "times"].sum() - top["times"].sum()
    share = lambda x: x / np.maximum(1, x.sum(1, keepdims=True))
    return References(langs, share(classes), share(common), slot)


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of rows of p and q, from 0 to 1."""
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        part = np.where(p > 0, p * np.log2(p / middle), 0).sum(-1) + np.where(q > 0, q * np.log2(q / middle), 0).sum(-1)
    return np.sqrt(np.clip(part / 2, 0, 1))


def distances(got: Counted, langs: list[str | None], known: References) -> tuple[np.ndarray, np.ndarray]:
    """Distance of each text's classes and common words to its language's, or the nearest, reference."""
    count = len(langs)
    if not known.langs:
        return np.zeros(count), np.zeros(count)
    p = got.classes / np.maximum(1, got.classes.sum(1, keepdims=True))
    number = {x: k for k, x in enumerate(known.langs)}
    best = np.ones((2, count))
    own = np.array([number.get(x, -1) for x in langs])
    for k in range(len(known.langs)):
        these = np.flatnonzero((own == k) | (own == -1))
        if not len(these):
            continue
        place = np.full(count, -1)
        place[these] = np.arange(len(these))
        mine = place[got.of] >= 0
        bins = place[got.of[mine]] * (COMMON + 1) + known.slot[k, got.buckets[mine]]
        w = np.bincount(bins, minlength=len(these) * (COMMON + 1)).reshape(len(these), -1)
        w = w / np.maximum(1, w.sum(1, keepdims=True))
        now = np.stack([js_distance(p[these], known.classes[k]), js_distance(w, known.words[k])])
        nearer = now.sum(0) < best[:, these].sum(0)
        best[:, these[nearer]] = now[:, nearer]
    return best[0], best[1]


def quality_rules(
    docs: DataFrame,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_class_distance: float = 0.31,
    max_word_distance: float = 0.4,
    keyed: bool = False,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``kept``, and both distances; if ``keyed`` also ``doc``, a hash of id and text.

    docs: ``doc_id``, ``text``, ``lang``; other columns are not read.
    """
    key = [F.xxhash64(F.col("doc_id").cast("long"), "text").alias("doc")] if keyed else []
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", *key)
    known = docs.sparkSession.sparkContext.broadcast(learn_references(docs))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.pieces(batch, "text"):
                got = counted(part.column("text"))
                n = got.n_words
                classes, common = distances(got, part.column("lang").to_pylist(), known.value)
                failed = (n < min_words) | (100 * got.n_repeat_words > max_repeat_percent * n)
                # Squared distance that n draws over b equally likely bins give, (b - 1) / (8 n ln 2);
                # language is far from equally likely, so only a share of it.
                noise = lambda bins, size: NOISE_SHARE * (bins - 1) / (8 * np.log(2) * np.maximum(1, size))
                far = classes**2 > max_class_distance**2 + noise(len(CLASSES), got.classes.sum(1))
                far |= common**2 > max_word_distance**2 + noise(COMMON + 1, n)
                kept = ~failed & ~(far & (n >= MIN_WORDS))
                values = [n, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(v.astype(np.int64)) for v in values]]
                    + [pa.array(failed), pa.array(kept), pa.array(classes), pa.array(common)]
                    + ([part.column("doc")] if keyed else []),
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
                    + ["base_failed", "kept", "class_distance", "word_distance"]
                    + (["doc"] if keyed else []),
                )

    return docs.mapInArrow(
        judged,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, kept boolean, class_distance double, word_distance double" + (", doc long" if keyed else ""),
    )
