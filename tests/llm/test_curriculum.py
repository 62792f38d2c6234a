import re
from collections import defaultdict

import pytest
import samples

from orderflow.llm.curriculum import curriculum, time_of
from pyspark.sql import functions as F


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes: dict, weights=(5, 2, 1)):
    """Share by weight, stop at twice the size, share the excess again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    got, open_, left = dict.fromkeys(sizes, 0.0), set(sizes), 1.5 * sum(sizes.values())
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        for s in open_:
            got[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if got[s] >= 2 * sizes[s]:
                left += got[s] - 2 * sizes[s]
                got[s] = 2.0 * sizes[s]
                open_.discard(s)
    return got


def many():
    return [(k, samples.prose(k, 5 + (k * 37) % 90), "en", ("hot", "b", None, "Z", "é", "d")[min(k % 9, 5)], 1) for k in range(300)]


@pytest.mark.parametrize("rows", [samples.awkward_rows(), many()], ids=["awkward", "many"])
def test_targets_and_takes(spark, rows):
    docs = samples.documents(spark, rows)
    got = curriculum(docs).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r[1])
    wanted, taken = targets(sizes), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(wanted[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == sum(p.words for p in r.passes)
        assert all(0 <= p.position <= 1 for p in r.passes) and (r.position is None) == (r.taken == 0)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - wanted[s]) <= 1 for s in sizes)
    again = curriculum(docs.repartition(3)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_sorted_by_position(spark):
    parts = curriculum(samples.documents(spark, many())).select("position", F.spark_partition_id().alias("part")).where("position is not null").collect()
    assert [r.position for r in parts] == sorted(r.position for r in parts)


def test_demand_is_inverted(spark):
    for begin, end in ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5)):
        times = [time_of(F.lit(u / 10), F.lit(begin), F.lit(end)).alias(str(u)) for u in range(11)]
        for u, t in enumerate(spark.range(1).select(*times).first()):
            assert begin * t + (end - begin) * t * t / 2 == pytest.approx(u / 10 * (begin + end) / 2)


def test_empty_table(spark):
    assert curriculum(samples.empty(spark)).count() == 0
    assert curriculum(samples.documents(spark, [(1, "", "en", "a", 0)])).first().target == 0
