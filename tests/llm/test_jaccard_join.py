import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import samples

from orderflow.llm import jaccard_join as op


def shingles(text, size=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def brute(rows, percent=75):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index, shared = defaultdict(list), Counter()
    for k, s in enumerate(sets):
        for g in s:
            index[g].append(k)
    for ks in index.values():
        for i, a in enumerate(ks):
            for b in ks[:i]:
                shared[b, a] += 1
    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            root[find(a)] = find(b)
    ids = defaultdict(list)
    for k, r in enumerate(rows):
        ids[find(k)].append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    # Rows of one id and different texts are no case here.
    return sorted(((r[0], len(sets[k]), least[find(k)] if sets[k] else r[0]) for k, r in enumerate(rows)), key=repr)


def families():
    """Near copies around the threshold whose links form chains, and a passage that many texts share."""
    passage = samples.prose(99, 40)
    rows = [(k, samples.prose(1000 + k, 90) + " " + passage, "en", "a", 1) for k in range(60)]
    for family in range(12):
        base = samples.prose(family, 100 + 20 * family)
        text = base
        for k in range(30):
            # Some are edits of the base, some of the last copy, some too far away.
            text = samples.edited(base if k % 3 else text, (36, 48, 70, 24)[k % 4], 31 * k + family)
            rows.append((1000 * family + k + 100, text, "en", "a", 1))
    return rows


@pytest.mark.parametrize("rows", [samples.awkward_rows(), families()], ids=["awkward", "families"])
@pytest.mark.parametrize("block", [2048, 8])
def test_equals_brute_force(spark, rows, block):
    got = op.jaccard_join(samples.documents(spark, rows), block=block).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_a_passage_that_many_texts_share_ties_none_of_them(spark, monkeypatch):
    """Rows of a step grow with near copies, not with the texts that only have a passage in common."""
    passage = samples.prose(99, 20)
    rows = [(k, samples.prose(1000 + k, 60 + k % 40) + " " + passage, "en", "a", 1) for k in range(300)]
    rows += [(1000 + k, samples.edited(rows[k][1], 40, k + 1), "en", "a", 1) for k in range(10)]
    written, keep = Counter(), op.kept_table

    def counted(frame, label):
        kept = keep(frame, label)
        written[label] = max(written[label], kept.count())
        return kept

    monkeypatch.setattr(op, "kept_table", counted)
    got = op.jaccard_join(samples.documents(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
    assert sum(r["component_id"] != r["doc_id"] for r in got) == 10
    assert 10 <= written["stars"] <= 20 and written["members"] <= 40


def test_sets_that_share_shingles_with_one_set_only_get_no_tree(spark, monkeypatch):
    """Of a text that quotes many others, each has been compared with them, and they have nothing in common."""
    quotes = [samples.prose(k, 20) for k in range(12)]
    rows = [(k, samples.prose(1000 + k, 100) + " " + q, "en", "a", 1) for k, q in enumerate(quotes)]
    rows += [(100, " ".join(quotes), "en", "a", 1), (101, samples.edited(" ".join(quotes), 60), "en", "a", 1)]
    monkeypatch.setattr(op, "COMMON", 0)
    written, keep = {}, op.kept_table
    monkeypatch.setattr(op, "kept_table", lambda frame, label: written.setdefault(label, []).append(kept := keep(frame, label)) or kept)
    got = op.jaccard_join(samples.documents(spark, rows[:-1])).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows[:-1])
    assert written["stars"][0].count() > 6 and written["members"][0].count() == 0
    got = op.jaccard_join(samples.documents(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


@pytest.mark.parametrize("common", [0, 3, 40, 200])
def test_first_shingles_meet_whichever_are_common(common):
    """Linked sets share one of their first shingles by any order that all sets follow."""
    rnd = np.random.default_rng(common)
    base = np.unique(rnd.integers(1, 1 << 62, 200, dtype=np.uint64))
    known = np.sort(rnd.permutation(base)[:common])
    rank = rnd.permutation(len(known))
    met = 0
    for _ in range(100):
        a, b = (np.sort(np.delete(base, rnd.permutation(200)[: int(rnd.integers(5, 60))])) for _ in range(2))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 75 * (len(a) + len(b) - both):
            met += 1
            first = [op.first_shingles(x, known, rank, 75) for x in (a, b)]
            assert len(np.intersect1d(*first))
            assert [len(x) for x in first] == [len(x) - op.needed_overlap(len(x), 75) + 1 for x in (a, b)]
    assert met > 20


def test_empty_table(spark):
    got = op.jaccard_join(samples.empty(spark))
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == 0


def test_tree_drops_no_pair_that_reaches_the_threshold():
    rnd = np.random.default_rng(3)
    sets = []
    for _ in range(20):
        base = rnd.integers(1, 1 << 60, 200, dtype=np.uint64)
        for drop in rnd.integers(0, 60, 12):
            sets.append(np.unique(np.concatenate([base[drop:], rnd.integers(1, 1 << 60, drop // 2, dtype=np.uint64)])))
    n = np.array([len(s) for s in sets])
    bits = op.stacked(np.array([op.bitmap(s) for s in sets], object))
    tree = op.Tree(n, np.arange(len(sets)), bits)
    got = {tuple(sorted(p)) for a, b in tree.pairs(tree, 75) for p in zip(a.tolist(), b.tolist())}
    wanted = set()
    for i in range(len(sets)):
        for k in range(i):
            both = len(np.intersect1d(sets[i], sets[k]))
            if 100 * both >= 75 * (n[i] + n[k] - both):
                wanted.add((k, i))
    assert wanted and wanted <= got and len(got) < len(sets) ** 2 / 8


def test_merged_groups_join_through_their_roots(spark):
    groups = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (8, 8), (9, 8)], "node long, root long")
    links = spark.createDataFrame([(6, 2), (9, 30), (20, 21), (5, 6)], "a long, b long")
    got = {(r["node"], r["root"]) for r in op.merged(groups, links).collect()}
    assert got == {(1, 1), (2, 1), (5, 1), (6, 1), (8, 8), (9, 8), (30, 8), (20, 20), (21, 20)}


def test_links_of_a_block_span_its_components():
    """Near copies around the threshold: as many links as joins of groups, and the components of all links."""
    rnd = np.random.default_rng(2)
    base = np.sort(rnd.integers(1, 1 << 62, 120, dtype=np.uint64))
    sets = []
    for k in range(160):
        gone = rnd.permutation(120)[: int(rnd.integers(8, 30))]
        new = rnd.integers(1, 1 << 62, len(gone), dtype=np.uint64)
        sets.append(np.unique(np.concatenate([np.delete(base, gone), new])))
    n = np.array([len(x) for x in sets])
    group = np.arange(len(sets))
    group[20:30] = 20
    rows = {
        "anchor": np.zeros(160, int), "class": np.zeros(160, int), "i": np.zeros(160, int), "k": np.zeros(160, int), "part": np.zeros(160, int),
        "own": np.ones(160, bool), "set_id": np.arange(160), "n": n, "group": group, "tokens": np.array([x.tobytes() for x in sets], object),
    }
    got = op.spanning_links(rows, 75)

    def components(links):
        label = group.copy()
        for a, b in links:
            label[label == label[b]] = label[a]
        return {frozenset(np.flatnonzero(label == x)) for x in label}

    every = []
    for a in range(160):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 75 * (n[a] + n[b] - both):
                every.append((a, b))
    pairs = list(zip(got["a"], got["b"]))
    assert set(pairs) <= {(b, a) for a, b in every} and len(every) > 150
    assert components(pairs) == components(every) and len(components(pairs)) < 140
    assert len(pairs) == 151 - len(components(every))
