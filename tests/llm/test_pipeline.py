import hashlib
import os
import re
from collections import defaultdict

import compare
import corpus_pipeline
import pytest
import samples
import test_curriculum
import test_decontamination
import test_jaccard_join
import test_line_dedup
import test_quality

import __spark_entry__ as contract
from orderflow.llm import queries
from orderflow.llm.tables import kept_table

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in queries.QUERIES} == set(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())


def test_stages_take_effect(spark):
    docs = corpus_pipeline.table(spark, SF_DIR, "documents")
    columns, before = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = kept_table(stage(spark, docs, SF_DIR), name)
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert docs.columns == columns and len(ids) == len(set(ids)) and set(ids) <= before
        assert len(ids) == len(before) if name == "line_dedup" else len(ids) < len(before) or name == "near_duplicates"
        before = set(ids)
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    rows = mixed.selectExpr("doc_id", "pass_words", "position", "regexp_count(text, '[^ \\\\t-\\\\r]+') as words").collect()
    assert all(r.words == r.pass_words for r in rows) and {r.doc_id for r in rows} <= before
    assert [r.position for r in rows] == sorted(r.position for r in rows)


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_stand_awkward_rows(spark, stage):
    docs = samples.documents(spark)
    assert stage(spark, docs, SF_DIR).count() <= 2 * docs.count()
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0


def brute_mix(rows):
    """(id, words of the pass, text) for each use of a document, in the order of md5 of ids within a source."""
    by_source, out = defaultdict(list), []
    for r in rows:
        by_source[r[3]].append(r)
    sizes = {source: sum(test_curriculum.size(r[1]) for r in some) for source, some in by_source.items()}
    targets = test_curriculum.targets(sizes)
    for source, some in by_source.items():
        wanted, total, start = int(targets[source] + 0.5), sizes[source], 0
        whole = wanted // total if total else 0
        for r in sorted(some, key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest()):
            words = re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")
            part = max(0, min(len(words), wanted - whole * total - start))
            out += [(r[0], len(words), r[1])] * (whole if words else 0)
            if part:
                out.append((r[0], part, r[1] if part == len(words) else " ".join(words[:part])))
            start += len(words)
    return sorted(out)


def test_pipeline_equals_brute_force(spark):
    """Every stage by its brute force, over the whole smallest tables."""
    columns = ("doc_id", "text", "lang", "source")
    rows = [tuple(r) for r in corpus_pipeline.table(spark, SF_DIR, "documents").select(*columns).collect()]
    items = [tuple(r) for r in corpus_pipeline.table(spark, SF_DIR, "benchmark").select("item_id", "text").collect()]
    counts = [len(rows)]
    rows = [r for r, kept in zip(rows, test_quality.brute_kept(rows)) if kept]
    counts.append(len(rows))
    texts = {r[0]: r[1] for r in test_line_dedup.brute(rows)}
    rows = [(r[0], texts[r[0]], *r[2:]) for r in rows]
    first = {r[0] for r in test_jaccard_join.brute(rows) if r[0] == r[2]}
    rows = [r for r in rows if r[0] in first]
    counts.append(len(rows))
    dirty = {r[0] for r in test_decontamination.brute(rows, items) if r[-1]}
    rows = [r for r in rows if r[0] not in dirty]
    counts.append(len(rows))
    got = corpus_pipeline.run(spark, SF_DIR).select("doc_id", "pass_words", "text").collect()
    assert sorted(map(tuple, got)) == brute_mix(rows)
    assert counts[0] > counts[1] >= counts[2] > counts[3] > 0


def test_another_text_of_the_same_id_stays(spark):
    copied, other = samples.prose(1, 120), samples.prose(2, 120)
    docs = samples.documents(spark, [(1, copied, "en", "a", 0), (2, copied, "en", "a", 0), (2, other, "en", "a", 0), (None, copied, "en", "a", 0)])
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, SF_DIR).select("doc_id", "text").collect()
    assert {(r.doc_id, r.text == other) for r in kept} == {(1, False), (2, True), (None, False)}


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) & {*queries.QUERIES, "pipeline"}))
def test_query_equals_sql(spark, name):
    rows = contract.queries()[name](spark, SF_DIR)
    assert compare.assert_same(rows, compare.connect(SF_DIR), contract.oracle_sql()[name]) > 0
