import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import samples

from orderflow.llm import quality as op
from orderflow.llm import words as hashing


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    triples = Counter(zip(w, w[1:], w[2:]))
    repeated = {k + j for k, x in enumerate(zip(w, w[1:], w[2:])) if triples[x] > 1 for j in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(repeated), failed


def test_base_rules_equal_brute_force(spark):
    rows = samples.awkward_rows()
    got = op.quality_rules(samples.documents(spark, rows)).collect()
    found = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got]
    assert sorted(found, key=repr) == sorted(((r[0], *base(r[1])) for r in rows), key=repr)
    assert not any(r.kept for r in got if r.base_failed)


def test_distances_tell_junk_from_prose(spark):
    common = "the of and to in is was for on that".split()
    rnd = np.random.default_rng(5)

    def prose(seed):
        w = samples.prose(seed, 150).split()
        return " ".join(x if rnd.random() < 0.5 else str(rnd.choice(common)) for x in w) + "."

    rows = [(k, prose(k), "en", "a", 1) for k in range(60)]
    junk = [(100, " ".join(f"{w}%%%" for w in prose(3).split()), "en", "a", 1), (101, prose(4).upper(), None, "a", 1)]
    got = {r.doc_id: r.kept for r in op.quality_rules(samples.documents(spark, rows + junk)).collect()}
    assert all(got[k] for k in range(60)) and not got[100] and not got[101]


def test_without_any_language(spark):
    rows = [(1, samples.prose(2, 80), None, "a", 1)]
    assert op.quality_rules(samples.documents(spark, rows)).first().kept
    assert op.quality_rules(samples.empty(spark)).count() == 0


def test_js_distance():
    same, other = np.array([[0.5, 0.5, 0.0]]), np.array([0.0, 0.0, 1.0])
    assert op.js_distance(same, same[0])[0] == 0 and op.js_distance(same, other)[0] == 1


def histograms(text):
    """Character classes, and hash buckets of words, counted one by one."""
    text = text or ""
    classes = Counter(next((k for k, chars in SETS if c in chars), None) for c in text)
    rest = [c for c in text if not any(c in chars for _, chars in SETS)]
    del classes[None]
    for c in rest:
        kind = 10 if ord(c) >= 0x80 else 9 if c < " " or c == "\x7f" else 1 if c.islower() else 2 if c.isupper() else 3 if c.isdigit() else 7
        classes[kind] += 1
    at = hashing.texts(pa.array([" ".join(re.findall(r"[^\x20\x09-\x0D]+", text))]))
    starts, ends, _ = hashing.spans(at, hashing.NOT_WHITE)
    buckets = Counter((hashing.span_hashes(at.data, starts, ends) % np.uint64(op.BUCKETS)).tolist())
    return classes, buckets


SETS = ((0, " \t\n\v\f\r"), (4, ".,;:!?"), (5, "\"'`"), (6, "()[]{}"), (8, "#*$%&|<>"))


def distance(p, q):
    """Jensen-Shannon distance of two counters."""
    a, b = sum(p.values()), sum(q.values())
    total = 0.0
    for k in set(p) | set(q):
        x, y = p[k] / max(1, a), q[k] / max(1, b)
        total += sum(v / 2 * math.log2(2 * v / (x + y)) for v in (x, y) if v)
    return math.sqrt(min(1, max(0, total)))


def brute_distances(rows):
    """Distances of classes and common words of each row (id, text, lang) to its language, or the nearest; none without words."""
    classes, words, own = {}, {}, [histograms(r[1]) for r in rows]
    for r, (one, two) in zip(rows, own):
        if r[1] is not None and r[2] is not None:
            classes[r[2]] = classes.get(r[2], Counter()) + one
            words[r[2]] = words.get(r[2], Counter()) + two
    common = {k: {b for b, _ in sorted(v.items(), key=lambda x: (-x[1], -x[0]))[: op.COMMON]} for k, v in words.items()}

    def binned(lang, counts):
        kept = Counter({b: n for b, n in counts.items() if b in common[lang]})
        return kept + Counter({-1: sum(n for b, n in counts.items() if b not in common[lang])})

    out = []
    for r, (one, two) in zip(rows, own):
        langs = [x for x in sorted(classes) if r[2] in (x, None)]
        near = [(distance(one, classes[x]), distance(binned(x, two), binned(x, words[x]))) for x in langs]
        out.append(min(near, key=sum) if near and two else None)
    return out


def brute_kept(rows):
    """The verdict of each row, with the query's limits."""
    out = []
    for r, far in zip(rows, brute_distances(rows)):
        n, *_, failed = base(r[1])
        noise = lambda bins, size: op.NOISE_SHARE * (bins - 1) / (8 * math.log(2) * size)
        away = far is not None and (
            far[0] ** 2 > 0.31**2 + noise(len(op.CLASSES), len(r[1])) or far[1] ** 2 > 0.4**2 + noise(op.COMMON + 1, n)
        )
        out.append(not failed and not (away and n >= 50))
    return out


def test_distances_equal_brute_force(spark):
    rows = [r for r in samples.awkward_rows() if len(r[1] or "") < 10_000]
    rows += [(200 + k, samples.prose(k, 260) + " the of and" * (k + 1), ("en", "de", "xx", None)[k % 4], "a", 1) for k in range(12)]
    rows += [(300 + k, "%# $& " * 40 + samples.prose(k, 60 + 20 * k), "en", "a", 1) for k in range(4)]
    got = op.quality_rules(samples.documents(spark, rows)).collect()
    found = sorted(((r.doc_id, round(r.class_distance, 9), round(r.word_distance, 9)) for r in got if r.n_words), key=repr)
    want = [(r[0], round(d[0], 9), round(d[1], 9)) for r, d in zip(rows, brute_distances(rows)) if d]
    assert found == sorted(want, key=repr)
    kept = sorted(((r[0], k) for r, k in zip(rows, brute_kept(rows))), key=repr)
    assert sorted(((r.doc_id, r.kept) for r in got), key=repr) == kept and {k for _, k in kept} == {True, False}
