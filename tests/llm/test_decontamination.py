import hashlib
import re

import samples

from orderflow.llm import decontamination as op


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, items, size=13):
    windows = {}
    for item, text in items:
        w = words_of(text)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + size]), set()).add(str(item))
    lengths = {len(w) for w in windows}
    out = []
    for r in rows:
        w, hit, found = words_of(r[1]), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if of := windows.get(tuple(w[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= of
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((r[0], len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def case():
    passage = samples.prose(8, 40)
    items = [(1, passage), (2, passage), (10, samples.prose(9, 25)), (3, None), (4, "?!"), (5, "Wörter, nur drei"), (6, "one"), (7, "two THREE")]
    items += [(8, "so " * 14), (8, "so " * 14)]
    rows = samples.awkward_rows() + [
        (20, samples.prose(30, 50) + " " + passage + " " + samples.prose(31, 50), "en", "a", 1),
        (21, samples.prose(30, 900) + " " + " ".join(passage.split()[3:17]), "en", "a", 1),
        (22, passage + " " + passage, "en", "a", 1),
        (23, "wörter nur drei! nur wörter drei", "en", "a", 1),
        (24, " ".join(passage.split()[:12]), "en", "a", 1),
    ]
    return rows, items


def test_equals_brute_force_with_either_plan(spark):
    rows, items = case()
    docs = samples.documents(spark, rows)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for limit in (op.VOCABULARY_LIMIT, 3):
        got = op.decontaminate(docs, benchmark, vocabulary_limit=limit).drop("doc").distinct().collect()
        assert sorted((tuple(r) for r in got), key=repr) == sorted(set(brute(rows, items)), key=repr)


def test_every_row_has_a_row(spark):
    rows, items = case()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert op.decontaminate(samples.documents(spark, rows), benchmark).count() == len(rows)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert op.decontaminate(samples.empty(spark), none).count() == 0
    got = op.decontaminate(samples.documents(spark), none)
    assert got.where("contaminated or n_hit > 0 or n_items > 0").count() == 0


def test_proximity(spark):
    postings = spark.createDataFrame([(1, p, t) for p, t in enumerate([5, 7, 9, 6])] + [(2, 0, 5), (2, 9, 6)], "doc long, pos int, term long")
    windows = spark.createDataFrame([("i", 77, [5, 6, 9])], "item string, window long, terms array<long>")
    counts = spark.createDataFrame([(5, 2), (6, 2), (9, 1)], "term long, times long")
    ranked = op.ranked_windows(windows, counts)
    assert op.phrase_matches(postings, ranked).count() == 0
    assert [tuple(r) for r in op.phrase_matches(postings, ranked, slop=2).select("doc", "window").distinct().collect()] == [(1, 77)]
