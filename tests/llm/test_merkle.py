import hashlib
import zlib

import pytest
import samples
from pyspark.sql import functions as F

from orderflow.llm import merkle
from orderflow.llm.positions import numbered


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(level):
    """Root, and for each leaf its siblings with their side; None where it has none."""
    paths, below = [[] for _ in level], [[k] for k in range(len(level))]
    while len(level) > 1:
        upper, above = [], []
        for k in range(0, len(level), 2):
            pair = level[k : k + 2]
            for leaf in below[k]:
                paths[leaf].append((False, pair[1]) if len(pair) == 2 else None)
            for leaf in below[k + 1] if len(pair) == 2 else []:
                paths[leaf].append((True, pair[0]))
            upper.append(sha(*pair))
            above.append(sum(below[k : k + 2], []))
        level, below = upper, above
    return level[0], paths


def brute(rows):
    trees, out = {}, []
    for row in rows:
        trees.setdefault(row[2], []).append((row[0], sha(*map(field, row)), row))
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in order:
        trees[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    lower = [tree([leaf for _, leaf, _ in trees[lang]]) for lang in order]
    root, upper = tree([subroot for subroot, _ in lower]) if lower else (None, [])
    for lang, (subroot, paths), rest in zip(order, lower, upper):
        for (doc, leaf, row), path in zip(trees[lang], paths):
            changed = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and row[3] is not None
            digest = sha(*map(field, (*row[:3], row[3] + 1, row[4]))) if changed else leaf
            for step in path + rest:
                digest = sha(digest) if step is None else sha(step[1], digest) if step[0] else sha(digest, step[1])
            out.append((doc, leaf, subroot, root, "".join(x[1] for x in path + rest if x), digest, digest == root))
    return sorted(out, key=repr)


def manifest(docs):
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    return sorted(map(tuple, merkle.merkle_manifest(docs, tampered).collect()), key=repr)


@pytest.mark.parametrize("count", [0, 1, 2, 3, 5, 255, 256, 257, 513, 700])
def test_trees_of_every_size(spark, count):
    rows = [(k, f"text {k}", "en" if k % 7 else None, "a", k) for k in range(count)]
    docs = samples.documents(spark, rows) if rows else samples.empty(spark)
    assert manifest(docs) == brute([(r[0], r[3], r[2], r[4], r[1]) for r in rows])


def test_awkward_rows(spark):
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in samples.awkward_rows()]
    assert manifest(samples.documents(spark)) == brute(rows)


def test_steps_and_copies_change_nothing(spark, monkeypatch):
    """Four leaves a block and copies for every two leaves give the same as whole blocks."""
    rows = [(k % 40, f"text {k}", ("en", "de", None)[k % 3], "a", k) for k in range(150)]
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "SPREAD", 2)
    assert manifest(samples.documents(spark, rows)) == brute([(r[0], r[3], r[2], r[4], r[1]) for r in rows])


def test_only_a_changed_count_is_found(spark):
    docs = samples.documents(spark, [(k, "t", "en", "a", k or None) for k in range(50)])
    got = merkle.merkle_manifest(docs, F.col("doc_id") % 5 == 0).collect()
    assert {r.doc_id for r in got if not r.verified} == set(range(5, 50, 5))
    assert len({r.root for r in got}) == 1 and all(r.verified == (r.folded_root == r.root) for r in got)


def test_numbers_of_a_large_group(spark):
    rows = spark.range(5000, numPartitions=7).selectExpr("if(id % 10 = 0, 'b', 'a') as g", "id div 3 as x")
    got = numbered(rows, "g", "x").collect()
    for group, size in (("a", 4500), ("b", 500)):
        own = sorted((r.idx, r.x, r.n) for r in got if r.g == group)
        assert [i for i, _, _ in own] == list(range(size)) and {n for *_, n in own} == {size}
        assert [x for _, x, _ in own] == sorted(x for _, x, _ in own)
