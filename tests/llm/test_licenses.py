import random
import re

import numpy as np
import pyarrow as pa
import pytest
import samples

from orderflow.llm import licenses as li
from orderflow.llm.licenses import NOTICES, PHRASES, Template


def words_of(text):
    return re.findall(li.WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, templates):
    """Every block of every template, and of overlapping ones the fullest."""
    words, out = words_of(text), []
    for t in templates:
        size = len(t.words)
        if t.ordered:
            out += [(t.label, k, size) for k in range(len(words)) if words[k : k + len(t.sequence)] == t.sequence]
            continue
        full = [(k, len(t.words & set(words[k : k + t.span]))) for k in range(len(words)) if words[k] in t.words]
        chain, chains = None, []
        for k, found in full:
            if 100 * found >= t.percent * size:
                if chain is None or k - chain[-1][0] >= t.span:
                    chains.append(chain := [])
                chain.append((k, found))
        out += [(t.label, *min(c, key=lambda x: (-x[1], x[0]))) for c in chains]
    return len(words), sorted(out)


def texts():
    rnd = random.Random(5)
    pool = sorted({w for t in PHRASES + NOTICES for w in t.words}) + ["so", "été", "漢字", "x9"]
    made = [" ".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 120))) for _ in range(60)]
    for t in PHRASES + NOTICES:
        words = t.sequence
        for loss in (0, 1, 3, 6):
            kept = [w for k, w in enumerate(words) if k >= loss]
            shuffled = rnd.sample(kept, len(kept))
            made += [". ".join(kept), " ".join(shuffled), "b " * 30 + " und ".join(kept) + " c" * 30, "\n".join([" ".join(kept)] * 3)]
    awkward = [r[1] for r in samples.awkward_rows()]
    return awkward + made + ["Under the MIT License!", "under the mit\nLICENSE", "CC BY-NC 4.0 " * 5000, "cc by", "the " * 20_000 + "mit license"]


def test_same_as_brute_force(spark):
    rows = list(enumerate(texts()))
    docs = samples.documents(spark, [(k, x, "en", "a", 0) for k, x in rows])
    got = {r.doc_id: (r.n_words, sorted((b.label, b.begin, b.found) for b in r.blocks)) for r in li.license_blocks(docs).collect()}
    want = {k: brute(x, PHRASES + NOTICES) for k, x in rows}
    assert {k: v for k, v in got.items() if want[k] != v} == {} and len(got) == len(rows)
    report = {r.doc_id: r for r in li.license_report(docs.repartition(7)).collect()}
    for k, (n, blocks) in want.items():
        places = [p for label, p, _ in brute(rows[k][1], PHRASES)[1]]
        r = report[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (n, len(places), min(places, default=None), max(places, default=None))
        assert r.labels == ",".join(sorted({b[0] for b in blocks})) and set(r.base_labels.split(",")) <= {"", *r.labels.split(",")}
        assert (r.score == 0) == (not blocks) and 0 <= r.score <= 1 and (not places or r.score == 1)


@pytest.mark.parametrize("seed", range(4))
def test_any_template_on_any_order(seed):
    """Few different words, so that blocks are many and overlap; the order of words must not matter."""
    rnd = random.Random(seed)
    pool = [f"w{k}" for k in range(9)]
    templates = tuple(
        Template(f"t{k}", " ".join(rnd.choices(pool, k=rnd.randrange(1, 9))), rnd.choice((30, 60, 75, 100)), rnd.randrange(4)) for k in range(12)
    ) + (Template("phrase", "w1 w2 w1 w3", ordered=True),)
    known = sorted({w for t in templates for w in t.words})
    hashes = li.word_hash(*known)
    order = np.argsort(hashes)
    number = {known[k]: n for n, k in enumerate(order)}
    plans = li.ordered_plans(templates, known, number, np.array([rnd.randrange(5) for _ in known]))
    made = [" ".join(rnd.choices(pool + ["other"], k=rnd.randrange(0, 60))) for _ in range(80)]
    found = li.blocks_of(li.occurrences(pa.array(made), hashes[order]), plans)
    for text, own in zip(made, found):
        assert sorted((b["label"], b["begin"], b["found"]) for b in own) == brute(text, templates)[1]


def test_no_rows_and_awkward_rows(spark):
    assert li.license_report(samples.empty(spark)).count() == 0
    rows = li.license_report(samples.documents(spark)).collect()
    assert len(rows) == len(samples.awkward_rows())
    blank = [r for r in rows if r.doc_id in (4, 5, 6)]
    assert len(blank) == 3 and all(tuple(r)[1:] == (0, 0, None, None, "", "", 0.0) for r in blank)
