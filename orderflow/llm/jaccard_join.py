"""N-gram Jaccard join of whole documents by signature trees (operator 10).

Two documents link when the Jaccard similarity of their sets of distinct word
shingles reaches a threshold. The join is exact, up to 64-bit hashes of shingles:

1. One pass over the texts counts shingles that come again in a task, another gives each document its
   set's size, an identity of the set, a bitmap of its hashed shingles, and the first of its
   shingles: common ones come last, the others by hash. Linked sets share at least one of these,
   and sets that only have a common passage share none.
2. Shingles that several sets have are found by an aggregation, and so is the most central set of each.
   Sets are tied to the central sets of their shingles; ties that a full comparison confirms make first
   groups. This is linear in the rows, also for thousands of near copies.
3. Other sets tied to one central set, in several first groups, get signature trees. A
   node holds the OR of its sets' bitmaps, their size range, and whether all are
   in one group. Two trees are descended together; a pair of nodes ends where sizes
   or bitmaps rule the overlap out or where both are one group already. Sets of
   one size class share a tree; a large one is cut into blocks, and a task gets
   two blocks at most. What comes out is the sets that have a partner left.
4. These sets come back to their blocks with all their shingles. A task compares the pairs that its trees leave,
   groups what links, and gives out only the links that joined two groups: no more than it has sets.

Null or blank texts have an empty set, which is linked with nothing. Equal sets
are one node however many documents have them. Rows that share a ``doc_id`` are
one document for the result's smallest id, a null id counts as larger than any.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm import words
from orderflow.llm.components import components
from orderflow.llm.tables import discard, kept_table, small_side
from orderflow.session import settings

LEAF = 32
FAN = 8
BLOCK_SHINGLES = 8e6  # of the sets of one block
COMMON = 1 << 17  # shingles whose counts every task knows
COUNTED = 1 << 20  # shingles that a task counts at once
#: Rows that go to Python at once: a pair of large sets is some hundred thousand bytes.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "256"}
SIGNATURE = "doc_id long, doc long, set_id long, n long, bits binary, prefix array<long>"


def shingle_sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and sorted distinct shingle hashes of each text of a batch."""
    at = words.texts(batch.column("text")).lower()
    starts, ends, first = words.spans(at, words.NOT_WHITE)
    hashes = words.span_hashes(at.data, starts, ends)
    shingles = words.runs(hashes, size)
    for row in range(batch.num_rows):
        begin, end = first[row], first[row + 1]
        if end - begin >= size:
            own = np.sort(shingles[begin : end - size + 1])
            yield row, own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif end > begin:
            yield row, np.array([words.sequence_hash(hashes[begin:end])], np.uint64)
        else:
            yield row, np.zeros(0, np.uint64)


def set_identity(tokens: np.ndarray) -> int:
    if not len(tokens):
        return 0
    with np.errstate(over="ignore"):
        total = np.sum(words.mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)
        mixed = words.mix(np.array([total + np.uint64(len(tokens))], np.uint64))
    return int(mixed.view(np.int64)[0]) or 1


def bitmap(tokens: np.ndarray) -> bytes:
    """A bit for each token's hash; 4 to 8 times as many bits as tokens, from 64 to 262,144."""
    width = 1 << min(18, max(6, int(4 * len(tokens) - 1).bit_length()))
    bits = np.zeros(width, bool)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def needed_overlap(n: int, percent: int) -> int:
    return -(-n * percent // 100)


def _repeated(size: int):
    """Shingles that several sets have among those a task counts at once, and how many; equal sets count once."""

    def counts(held: list[np.ndarray]) -> pa.RecordBatch:
        tokens, rows = np.unique(np.concatenate(held), return_counts=True)
        several = rows > 1
        return pa.RecordBatch.from_arrays([pa.array(tokens[several].view(np.int64)), pa.array(rows[several], pa.int64())], names=["token", "rows"])

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        total = 0
        for batch in batches:
            for part in words.pieces(batch, "text"):
                for _, tokens in shingle_sets(part, size):
                    if held.setdefault((len(tokens), int(tokens.sum(dtype=np.uint64))), tokens) is tokens:
                        total += len(tokens)
                    if total >= COUNTED:
                        yield counts([*held.values()])
                        held, total = {}, 0
        if total:
            yield counts([*held.values()])

    return repeated


def common_shingles(docs: DataFrame, size: int) -> np.ndarray:
    """The shingles that most sets have, rarer ones first, as hashes.

    The counts are of those that tasks see more than once. They decide which shingles of a set
    are looked at first, the same for all sets, and so no link depends on them.
    """
    level = F.floor(F.log2("rows") * 8)
    counted = kept_table(
        docs.select("text").mapInArrow(_repeated(size), "token long, rows long").groupBy("token").agg(F.sum("rows").alias("rows")), "counted"
    )
    least, room = None, COMMON
    for step in sorted(counted.groupBy(level.alias("level")).count().collect(), reverse=True):
        room -= step["count"]
        if room < 0:
            break
        least = step["level"]
    found = counted.where(level >= F.lit(least)).toArrow()
    discard(counted)
    tokens, rows = (found[c].to_numpy() for c in ("token", "rows"))
    return tokens[np.lexsort((tokens, rows))].view(np.uint64)


def first_shingles(tokens: np.ndarray, common: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """Of a set's sorted shingles those that it shares one of with each set it is linked with; ``common`` is sorted, too."""
    first = len(tokens) - needed_overlap(len(tokens), percent) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        known = common[at] == tokens
        if known.any():
            tokens = np.concatenate([tokens[~known], tokens[known][np.argsort(rank[at[known]])]])
    return tokens[:first]


def _signatures(size: int, percent: int, common: np.ndarray):
    rank = np.argsort(common)
    common = common[rank]
    schema = pa.schema(
        [("doc_id", pa.int64()), ("doc", pa.int64()), ("set_id", pa.int64()), ("n", pa.int64()), ("bits", pa.binary()), ("prefix", pa.list_(pa.int64()))]
    )

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: set[int] = set()  # a copy of a set that this task has shown needs no second prefix
        for batch in batches:
            for part in words.pieces(batch, "text"):
                ids, sizes, bits, prefixes = [], [], [], []
                for _, tokens in shingle_sets(part, size):
                    n, identity = len(tokens), set_identity(tokens)
                    ids.append(identity)
                    sizes.append(n)
                    bits.append(bitmap(tokens) if n else b"")
                    if n and identity not in recent:
                        prefixes.append(first_shingles(tokens, common, rank, percent).view(np.int64))
                        recent.add(identity)
                    else:
                        prefixes.append(np.zeros(0, np.int64))
                if len(recent) > 100_000:
                    recent.clear()
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in prefixes])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(prefixes)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("doc"), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(bits, pa.binary()), lists],
                    schema=schema,
                )

    return signatures


def _full_sets(size: int):
    def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.pieces(batch, "text"):
                got = [tokens for _, tokens in shingle_sets(part, size)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([set_identity(x) for x in got], pa.int64()), pa.array([x.tobytes() for x in got], pa.binary())],
                    names=["set_id", "tokens"],
                )

    return full_sets


def fold(bits: np.ndarray, width: int) -> np.ndarray:
    """Narrow bitmaps (rows of 64-bit words) to ``width`` words; narrower ones stay."""
    while bits.shape[-1] > width:
        bits = bits[..., : bits.shape[-1] // 2] | bits[..., bits.shape[-1] // 2 :]
    return bits


def as_words(bits: bytes) -> np.ndarray:
    return np.frombuffer(bits, np.uint64)


def _fits(percent: int):
    """Keep pairs whose bitmaps allow the overlap that the sizes ask for."""

    def fits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = []
            for a, b, na, nb in zip(frame["bits_a"], frame["bits_b"], frame["na"], frame["nb"]):
                a, b = as_words(a), as_words(b)
                width = min(len(a), len(b))
                a, b = fold(a, width), fold(b, width)
                only_a, only_b = int(np.bitwise_count(a & ~b).sum()), int(np.bitwise_count(b & ~a).sum())
                keep.append((100 + percent) * min(na - only_a, nb - only_b) >= percent * (na + nb))
            yield frame.loc[np.array(keep, bool), ["a", "b"]]

    return fits


def _linked(percent: int):
    def linked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            keep = []
            for a, b in zip(frame["tokens_a"], frame["tokens_b"]):
                a, b = as_words(a), as_words(b)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield frame.loc[np.array(keep, bool), ["a", "b"]]

    return linked


def full_sets_of(wanted: DataFrame, sets: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """``set_id`` and all its ``tokens`` of the sets in ``wanted``."""
    of_docs = small_side(kept_table(sets.join(wanted, "set_id", "left_semi").select("doc"), "docs"))
    return kept_table(
        docs.select("doc", "text")
        .join(of_docs, "doc", "left_semi")
        .select("text")
        .mapInArrow(_full_sets(size), "set_id long, tokens binary")
        .groupBy("set_id")
        .agg(F.first("tokens").alias("tokens")),
        "sets",
    )


def confirmed(pairs: DataFrame, sets: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The links among pairs (a, b), which are distinct and have sizes ``na``, ``nb``."""
    side = lambda x: sets.select(F.col("set_id").alias(x), F.col("bits").alias(f"bits_{x}"))
    likely = kept_table(
        pairs.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
        .join(side("a"), "a")
        .join(side("b"), "b")
        .mapInPandas(_fits(percent), "a long, b long"),
        "pairs",
    )
    ends = likely.select(F.col("a").alias("set_id")).union(likely.select("b")).distinct()
    tokens = full_sets_of(ends, sets, docs, size)
    full = lambda x: tokens.select(F.col("set_id").alias(x), F.col("tokens").alias(f"tokens_{x}"))
    return likely.join(full("b"), "b").join(full("a"), "a").mapInPandas(_linked(percent), "a long, b long")


class Tree:
    """Sets of one task, sorted by group and size, under nodes that sum them up."""

    def __init__(self, n: np.ndarray, group: np.ndarray, bits: np.ndarray):
        self.order = np.lexsort((n, group))
        self.n, self.group, self.bits = n[self.order], group[self.order], bits[self.order]
        slack = self.n - np.bitwise_count(self.bits).sum(1).astype(np.int64)
        cuts = np.arange(0, len(n), LEAF)
        level = {
            "bits": np.bitwise_or.reduceat(self.bits, cuts),
            "least": np.minimum.reduceat(self.n, cuts),
            "most": np.maximum.reduceat(self.n, cuts),
            "slack": np.maximum.reduceat(slack, cuts),
            "low": np.minimum.reduceat(self.group, cuts),
            "high": np.maximum.reduceat(self.group, cuts),
        }
        self.levels = [level]
        while len(level["least"]) > 1:
            cuts = np.arange(0, len(level["least"]), FAN)
            level = {
                k: {"bits": np.bitwise_or, "least": np.minimum, "low": np.minimum}.get(k, np.maximum).reduceat(v, cuts)
                for k, v in level.items()
            }
            self.levels.append(level)

    def apart(self, height: int, x: int, other: Tree, height_other: int, y: int, percent: int) -> bool:
        """True where no set under node x and no set under node y can be a new link."""
        a, b = self.levels[height], other.levels[height_other]
        if a["low"][x] == a["high"][x] == b["low"][y] == b["high"][y]:
            return True
        small, large = min(a["most"][x], b["most"][y]), max(a["least"][x], b["least"][y])
        if 100 * small < percent * large:
            return True
        most = int(np.bitwise_count(a["bits"][x] & b["bits"][y]).sum()) + min(a["slack"][x], b["slack"][y])
        return 100 * most < percent * large

    def pairs(self, other: Tree, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Row numbers of pairs that bitmaps and sizes allow; each pair once if ``other`` is this tree."""
        stack = [(len(self.levels) - 1, 0, len(other.levels) - 1, 0)]
        while stack:
            height, x, height_other, y = stack.pop()
            if self.apart(height, x, other, height_other, y, percent):
                continue
            if height == height_other == 0:
                yield from self._leaves(x, other, y, percent)
                continue
            if height >= height_other:
                low = [(height - 1, k) for k in range(x * FAN, min((x + 1) * FAN, len(self.levels[height - 1]["least"])))]
            else:
                low = [(height, x)]
            if height_other >= height:
                low_other = [(height_other - 1, k) for k in range(y * FAN, min((y + 1) * FAN, len(other.levels[height_other - 1]["least"])))]
            else:
                low_other = [(height_other, y)]
            stack += [(h, i, g, k) for h, i in low for g, k in low_other if self is not other or i <= k]

    def _leaves(self, x: int, other: Tree, y: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        i = np.arange(x * LEAF, min((x + 1) * LEAF, len(self.n)))
        k = np.arange(y * LEAF, min((y + 1) * LEAF, len(other.n)))
        a, b, na, nb = self.bits[i], other.bits[k], self.n[i][:, None], other.n[k][None, :]
        both = np.bitwise_count(a[:, None, :] & b[None, :, :]).sum(2, dtype=np.int64)
        only_a = np.bitwise_count(a).sum(1, dtype=np.int64)[:, None] - both
        only_b = np.bitwise_count(b).sum(1, dtype=np.int64)[None, :] - both
        most = np.minimum(na - only_a, nb - only_b)
        good = (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & ((100 + percent) * most >= percent * (na + nb))
        good &= self.group[i][:, None] != other.group[k][None, :]
        if self is other:
            good &= i[:, None] < k[None, :]
        rows, cols = np.nonzero(good)
        yield self.order[i[rows]], other.order[k[cols]]


def stacked(bits: np.ndarray) -> np.ndarray:
    """Bitmaps as rows of words, all folded to the narrowest."""
    widths = {len(b) for b in bits}
    if len(widths) == 1:
        return np.frombuffer(b"".join(bits), np.uint64).reshape(len(bits), -1)
    return np.stack([fold(as_words(b), min(widths) // 8) for b in bits])


BLOCK = ("anchor", "class", "i", "k")
MEMBER = "anchor long, class long, i long, k long, part long, own boolean, set_id long, n long, group long"


def _trees(rows: dict[str, np.ndarray], bits: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a block that may be links, some pairs at a time."""
    n, group, own, part = (rows[c] for c in ("n", "group", "own", "part"))
    i, k = rows["i"][0], rows["k"][0]
    # A set of the class below meets the class's own sets here, and its like elsewhere.
    kinds = [(own & (part == i), own & (part == k), i == k), (own & (part == i), ~own & (part == k), False)]
    if i != k:
        kinds.append((own & (part == k), ~own & (part == i), False))
    for left, right, same in kinds:
        left, right = np.flatnonzero(left), np.flatnonzero(right)
        if len(left) and len(right) and (len(left) > 1 or not same):
            tree = Tree(n[left], group[left], bits[left])
            other = tree if same else Tree(n[right], group[right], bits[right])
            for p, q in tree.pairs(other, percent):
                if len(p):
                    yield left[p], right[q]


def with_partners(rows: dict[str, np.ndarray], percent: int) -> dict[str, np.ndarray]:
    """The rows of a block that bitmaps and sizes leave a partner."""
    held = np.zeros(len(rows["n"]), bool)
    if rows["group"].min() != rows["group"].max():
        for p, q in _trees(rows, stacked(rows["bits"]), percent):
            held[p] = held[q] = True
    return {c: v[held] for c, v in rows.items() if c != "bits"}


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens each of the left sets shares with each of the right ones."""
    known = np.unique(np.concatenate(left))
    bits = []
    for side in (left, right):
        rows = np.zeros((len(side), -(-len(known) // 64) * 64), bool)
        for row, tokens in enumerate(side):
            at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
            rows[row, at[known[at] == tokens]] = True
        bits.append(np.packbits(rows, axis=1).view(np.uint64))
    return np.stack([np.bitwise_count(bits[1] & row).sum(1, dtype=np.int64) for row in bits[0]])


def spanning_links(rows: dict[str, np.ndarray], percent: int) -> dict[str, np.ndarray]:
    """Links of a block, each between what were two groups so far."""
    tokens = [as_words(x) for x in rows["tokens"]]
    bits = stacked(np.array([bitmap(x) for x in tokens], object))
    ids, n = rows["set_id"], rows["n"]
    # Rows of one set are one group, as are sets that are grouped already.
    _, first = np.unique(rows["group"], return_inverse=True)
    group, links = first.copy(), []
    for p, q in _trees(rows, bits, percent):
        new = group[p] != group[q]
        p, q = p[new], q[new]
        if not len(p):
            continue
        x, at_p = np.unique(p, return_inverse=True)
        y, at_q = np.unique(q, return_inverse=True)
        both = overlaps([tokens[k] for k in x], [tokens[k] for k in y])[at_p, at_q]
        linked = 100 * both >= percent * (n[p] + n[q] - both)
        for a, b in zip(p[linked], q[linked]):
            if group[a] != group[b]:
                links.append((ids[a], ids[b]))
                group[group == group[b]] = group[a]
    found = np.array(links, np.int64).reshape(-1, 2)
    return {"a": found.min(1, initial=np.iinfo(np.int64).max), "b": found.max(1, initial=np.iinfo(np.int64).min)}


def _by_block(of_block, percent: int):
    """Apply a function to each block: rows are sorted by block, and a block is held at once."""

    def by_block(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            rows = {c: frame[c].to_numpy() for c in frame.columns}
            if rest is not None:
                rows = {c: np.concatenate([rest[c], rows[c]]) for c in rows}
            new = np.zeros(max(0, len(rows["anchor"]) - 1), bool)
            for c in BLOCK:
                new |= rows[c][1:] != rows[c][:-1]
            cuts = np.flatnonzero(new) + 1
            got = [
                of_block({c: v[begin:end] for c, v in rows.items()}, percent)
                for begin, end in zip([0, *cuts[:-1]], cuts)
                if end - begin > 1
            ]
            if got:
                yield pd.DataFrame({c: np.concatenate([x[c] for x in got]) for c in got[0]})
            rest = {c: v[cuts[-1] if len(cuts) else 0 :] for c, v in rows.items()}
        if rest is not None and len(rest["anchor"]) > 1:
            yield pd.DataFrame(of_block(rest, percent))

    return by_block


def blocked(rows: DataFrame) -> DataFrame:
    return rows.repartition(*BLOCK).sortWithinPartitions(*BLOCK)


def shared_postings(signed: DataFrame) -> DataFrame:
    """``token``, ``set_id``, ``n`` of shingles that several sets have among their first, and ``rows`` of the shingle.

    A shingle of any number of sets is summed up before it is shuffled; its postings meet the one row of the sum.
    """
    rows = signed.select("set_id", "n", F.explode("prefix").alias("token"))
    shared = kept_table(
        rows.groupBy("token")
        .agg(F.min("set_id").alias("low"), F.max("set_id").alias("high"), F.count("*").alias("rows"))
        .where("low != high")
        .select("token", "rows"),
        "shared",
    )
    postings = kept_table(rows.join(shared, "token").groupBy("token", "set_id", "n", "rows").agg(F.lit(1).alias("one")).drop("one"), "postings")
    discard(shared)
    return postings


def ties_to_central(signed: DataFrame) -> DataFrame:
    """Each set of a shared shingle (``a``, ``na``) with the shingle's most central set (``b``, ``nb``).

    Central is the set whose shingles are shared most often for its size: the
    original more than its edited copies. ``several`` is true where a third set has such a shingle.
    """
    postings = shared_postings(signed)
    central = postings.groupBy("set_id", "n").agg((F.sum("rows") / F.col("n")).alias("central"))
    placed = kept_table(postings.select("token", "set_id", "n").join(central, ["set_id", "n"]), "central")
    best = F.min(F.struct((-F.col("central")).alias("central"), "set_id", "n"))
    anchors = kept_table(placed.groupBy("token").agg(best.alias("anchor"), F.count("*").alias("sets")), "anchors")
    stars = kept_table(
        placed.select("token", "set_id", "n")
        .join(anchors, "token")
        .where("set_id != anchor.set_id")
        .select(F.col("set_id").alias("a"), F.col("anchor.set_id").alias("b"), F.col("n").alias("na"), F.col("anchor.n").alias("nb"), "sets")
        .groupBy("a", "b", "na", "nb")
        .agg((F.max("sets") > 2).alias("several")),
        "stars",
    )
    discard(postings, placed, anchors)
    return stars


def tree_links(stars: DataFrame, groups: DataFrame, sets: DataFrame, docs: DataFrame, size: int, percent: int, block: int) -> DataFrame:
    """Links (a, b) between sets of different groups that join all groups which links join.

    Sets that share a shingle are tied to the same central set, so there is one
    tree for each central set and not for each shingle. It lacks the central set, which
    all its sets have been compared with, and sets that no third one shares a shingle with. A block has ``block`` sets at most, and
    fewer where they are so large that their shingles would not fit into a task.
    """
    members = (
        stars.where("several")
        .select(F.col("b").alias("anchor"), F.col("a").alias("set_id"), F.col("na").alias("n"))
        .join(groups.select(F.col("node").alias("set_id"), "root"), "set_id", "left")
        .select("anchor", "set_id", "n", F.coalesce("root", "set_id").alias("group"))
    )
    own_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9)
    classed = kept_table(
        members.withColumn("class", own_class).select(
            "anchor", "set_id", "n", "group", F.inline(F.expr("array(struct(class as class, true as own), struct(class + 1 as class, false as own))"))
        ),
        "members",
    )
    # One group needs no links.
    counts = (
        classed.groupBy("anchor", "class")
        .agg(
            F.count("*").alias("rows"), F.count(F.when(F.col("own"), 1)).alias("owners"), F.min("group").alias("low"), F.max("group").alias("high")
        )
        .where("owners > 0 and low != high")
        .select("anchor", "class", "rows")
    )
    blocks = (
        classed.join(counts, ["anchor", "class"])
        .withColumn("parts", F.ceil(F.col("rows") / F.least(F.lit(block), F.ceil(BLOCK_SHINGLES / F.pow(F.lit(100 / percent), F.col("class") + 1)))))
        .withColumn("part", F.pmod(F.xxhash64("set_id"), F.col("parts")))
        .withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)")))
        .withColumn("i", F.least("part", "other"))
        .withColumn("k", F.greatest("part", "other"))
        .join(sets.select("set_id", "bits"), "set_id")
        .select(*BLOCK, "part", "own", "set_id", "n", "group", "bits")
    )
    open_rows = kept_table(blocked(blocks).mapInPandas(_by_block(with_partners, percent), MEMBER), "open")
    tokens = full_sets_of(open_rows.select("set_id").distinct(), sets, docs, size)
    return blocked(open_rows.join(tokens, "set_id")).mapInPandas(_by_block(spanning_links, percent), "a long, b long").distinct()


def merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Groups (``node``, ``root``) after more links (a, b): only the roots that these connect are contracted."""
    of = lambda x: groups.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
    between = (
        links.join(of("a"), "a", "left")
        .join(of("b"), "b", "left")
        .select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    )
    moved = components(between).select(F.col("node").alias("root"), F.col("root").alias("to"))
    moved = small_side(kept_table(moved, "moved"))
    new = moved.join(groups.select(F.col("node").alias("root")), "root", "left_anti")
    return (
        groups.join(moved, "root", "left")
        .select("node", F.coalesce("to", "root").alias("root"))
        .unionByName(new.select(F.col("root").alias("node"), F.col("to").alias("root")))
    )


def jaccard_join(docs: DataFrame, size: int = 5, percent: int = 75, block: int = 2048, keyed: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``; if ``keyed`` also ``doc``, a hash of id and text.

    docs: ``doc_id`` and ``text``; other columns are not read. An empty table
    gives no rows. ``percent`` is the threshold in hundredths; ``block`` bounds
    how many sets of a tree a task holds twice over.
    """
    with settings(docs.sparkSession, SMALL_BATCHES):
        doc_id = F.col("doc_id").cast("long")
        docs = docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, "text").alias("doc"), "text")
        signed = kept_table(docs.mapInArrow(_signatures(size, percent, common_shingles(docs, size)), SIGNATURE), "signatures")
        stars = ties_to_central(signed)
        # All later steps are about these sets only.
        tied = small_side(kept_table(stars.select(F.col("a").alias("set_id")).union(stars.select("b")).distinct(), "tied"))
        sets = kept_table(
            signed.join(tied, "set_id", "left_semi")
            .groupBy("set_id")
            .agg(F.min("doc").alias("doc"), F.max("n").alias("n"), F.first("bits").alias("bits")),
            "sets",
        )
        links = kept_table(confirmed(stars, sets, docs, size, percent), "links")
        groups = kept_table(components(links), "groups")
        found = kept_table(tree_links(stars, groups, sets, docs, size, percent, block), "links")
        if not found.isEmpty():
            groups = kept_table(merged(groups, found), "groups")
    placed = (
        signed.select("doc_id", "doc", "set_id", "n")
        .join(groups.select(F.col("node").alias("set_id"), "root"), "set_id", "left")
        .select("doc_id", "doc", "n", F.when(F.col("n") > 0, F.coalesce("root", "set_id")).alias("root"))
    )
    smallest = placed.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    return placed.join(smallest, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("smallest", "doc_id").alias("component_id"), *(["doc"] if keyed else [])
    )
