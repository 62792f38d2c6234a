from collections import defaultdict

import samples

from orderflow.llm.line_dedup import line_dedup

BLANKS = " \t\x0b\f\r"


def words_of(line):
    for c in BLANKS:
        line = line.replace(c, " ")
    return tuple(w for w in line.split(" ") if w)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute(rows, min_words=5, near_words=10):
    """(id, text, n_lines, n_exact, n_near) of every row; equal rows are one document."""
    lines = sorted(
        {(r[0] is None, r[0] or 0, r[1], k, words_of(x)) for r in rows if r[1] is not None for k, x in enumerate(r[1].split("\n"))},
        key=lambda x: (x[:2], x[3]),
    )
    lines = [x for x in lines if len(x[4]) >= min_words]
    first = {}
    for x in lines:
        first.setdefault(x[4], x)
    order = {w: i for i, w in enumerate(first)}
    long = [w for w in first if len(w) >= near_words]
    # One word away leaves the first or the last word as it is.
    ends = defaultdict(list)
    for w in long:
        ends[0, w[0]].append(w)
        ends[1, w[-1]].append(w)
    near = {w for w in long for v in {*ends[0, w[0]], *ends[1, w[-1]]} if order[v] < order[w] and one_edit(v, w)}
    exact_at, near_at = set(), set()
    for x in lines:
        if first[x[4]] != x:
            exact_at.add(x[:4])
        elif x[4] in near:
            near_at.add(x[:4])
    out = []
    for r in rows:
        key = (r[0] is None, r[0] or 0, r[1])
        split = [] if r[1] is None else r[1].split("\n")
        exact = [k for k in range(len(split)) if (*key, k) in exact_at]
        close = [k for k in range(len(split)) if (*key, k) in near_at]
        kept = None if r[1] is None else "\n".join(x for k, x in enumerate(split) if k not in exact and k not in close)
        out.append((r[0], kept, len(split), len(exact), len(close)))
    return sorted(out, key=repr)


def near_rows():
    line = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    changed = line.replace("zeta", "other")
    return [
        (5, f"{line}\nshort line\nshort line", "en", "a", 1),
        (6, changed, "en", "a", 1),
        (7, line.replace("zeta ", ""), "en", "a", 1),
        (8, line + " mu", "en", "a", 1),
        (9, line.replace("zeta", "other words"), "en", "a", 1),
        (3, "zero " + line, "en", "a", 1),
        (10, "\n".join(line.replace("kappa", f"no{k}") for k in range(200)), "en", "a", 1),
        (11, "five words in a line\n five  words in\ta line\r", "en", "a", 1),
        (12, "five words in a row", "en", "a", 1),
        (13, line.replace(" ", "  ") + "\r\n" + changed, "en", "a", 1),
    ]


def compare(spark, rows):
    docs = samples.documents(spark, rows)
    got = line_dedup(docs)
    assert got.columns[: len(docs.columns) - 1] == [c for c in docs.columns if c != "n_lines"]
    kept = [tuple(r) for r in got.select("doc_id", "text", "n_lines", "n_exact", "n_near").collect()]
    assert sorted(kept, key=repr) == brute(rows)


def test_near_lines(spark):
    compare(spark, near_rows())


def test_awkward_rows(spark):
    compare(spark, samples.awkward_rows())


def test_near_lines_of_repeated_rows(spark):
    """The earliest place of a line is in rows that share id and text, or in null-id rows of one text."""
    known = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    rows = [(1, known, "en", "a", 1)] * 2 + [(2, known.replace("zeta", "other"), "en", "a", 1), (3, known + " mu", "en", "a", 1)]
    late = known.upper()
    rows += [(None, f"zz\n{late}", "en", "a", 1)] * 2 + [(None, f"{late} MU", "en", "a", 1), (None, late.replace("IOTA ", ""), "en", "a", 1)]
    compare(spark, rows)
    assert sum(r[4] for r in brute(rows)) >= 4


def test_short_lines_when_floors_are_lower(spark):
    """Floors are parameters of the function, not limits of its method."""
    line = "a b c d e f g h i"
    texts = [line, line.replace("e", "x"), line + " j", line.replace("c ", ""), "Read more", "Read more", "Read it more", "one two three", "one two four", "x", "x", ""]
    rows = [(k, text, "en", "a", 1) for k, text in enumerate(texts)]
    got = line_dedup(samples.documents(spark, rows), min_words=1, near_words=3)
    kept = [tuple(r) for r in got.select("doc_id", "text", "n_lines", "n_exact", "n_near").collect()]
    assert sorted(kept, key=repr) == brute(rows, min_words=1, near_words=3)


def test_empty_table(spark):
    assert line_dedup(samples.empty(spark)).count() == 0
