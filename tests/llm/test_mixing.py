"""Mixing: targets, seats, blocks."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strata.llm import mixing
from strata.llm.common import WORD


def slow_targets(sizes, weights=(5, 2, 1), cap=3):
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, budget = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in full]
        level = (budget - sum(full.values())) / sum(w[s] for s in free) if free else 0
        over = [s for s in free if w[s] * level > cap * sizes[s] + 1e-9]
        if not over:
            return {s: full.get(s, w[s] * level) for s in order}
        full.update({s: cap * sizes[s] for s in over})


def seats_one_by_one(weights, n):
    got = [0] * len(weights)
    for _ in range(n):
        best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


@pytest.mark.parametrize("case", [([5, 3, 1], 7), ([100, 1, 1, 1, 1, 1, 1], 20), ([1] * 9, 5), ([0, 4, 4], 3), ([3], 11),
                                  ([7, 7, 7, 7], 6), ([1000, 3, 3, 3, 3], 4)])
def test_sainte_lague_against_one_by_one(spark, case):
    weights, n = case
    df = spark.createDataFrame([(i, float(w), n) for i, w in enumerate(weights)], "i int, w double, n long")
    got = [r.seats for r in mixing.apportion(df, [], "w", "n", ["i"]).orderBy("i").collect()]
    assert got == seats_one_by_one(weights, n)


def test_mix_properties(make_docs):
    from tests.llm.conftest import EN, prose
    rows = [(i, prose(EN, i, 5 + i % 90), None, ["hot", "hot", "b", "é", None, "tiny"][i % 6] if i else "tiny", None) for i in range(600)]
    rows = [r for r in rows if r[3] != "tiny" or r[0] < 40]
    rows += [(600, None, None, "none", None), (601, "", None, "none", None), (7, "same id twice", None, "b", None)]
    docs = make_docs(rows)
    got = mixing.mix(docs, block=8, shard_words=500).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(re.findall(WORD, r[1] or ""))
    want, taken = slow_targets(sizes), defaultdict(int)
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
    shards = {r.source: len({x.shard for x in got if x.source == r.source}) for r in got}
    assert shards["hot"] > 3
    for s, t in want.items():
        assert abs(taken[s] - t) <= 8 * (1 + shards[s]), s
    assert sorted(got) == sorted(mixing.mix(docs.repartition(7, F.rand(3)), block=8, shard_words=500).collect())
    assert sorted(got) != sorted(mixing.mix(docs, block=8, shard_words=500, seed=12).collect())


def test_awkward_rows(messy, make_docs):
    got = mixing.mix(messy).collect()
    assert len(got) == messy.count()
    assert all(r.taken == 0 for r in got if r["size"] == 0)
    assert sum(r.target for r in {x.source: x for x in got}.values()) == pytest.approx(sum(r["size"] for r in got))
    assert mixing.mix(make_docs([])).count() == 0
    assert [r.taken for r in mixing.mix(make_docs([(1, None), (2, "")])).collect()] == [0, 0]


def test_shuffle_path_gives_the_same(make_docs, monkeypatch):
    from tests.llm.conftest import EN, prose
    docs = make_docs([(i, prose(EN, i, 30), None, "ab"[i % 2], None) for i in range(60)])
    want = sorted(mixing.mix(docs).collect())
    monkeypatch.setattr(mixing, "bounded_broadcast", lambda df, rows, limit=0: df)
    assert sorted(mixing.mix(docs).collect()) == want


def test_rows_without_ids_are_dealt_to_many_shards(make_docs):
    docs = make_docs([(None, f"word{i} " * 20, None, "hot", None) for i in range(400)] + [(5, f"again{i} " * 20, None, "hot", None) for i in range(400)])
    got = mixing.mix(docs, block=8, shard_words=500).collect()
    for i in (None, 5):
        assert len({r.shard for r in got if r.doc_id == i}) > 10
