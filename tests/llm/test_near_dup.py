"""Near duplicates against all pairs by brute force."""

import numpy as np
import pytest

from strata.llm import near_dup as N
from tests.llm.conftest import EN, prose


def slow_components(rows):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        k = min(5, len(words))
        sets.append({tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None:
                both = len(sets[i] & sets[j])
                if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(sets[i]), least.get(find(i)) if d is not None else None) for i, (d, _) in enumerate(rows)]


def variants(base, n, edits, start):
    out = []
    for v in range(n):
        words = base.split()
        for e in range(edits):
            words[(v * 37 + e * 53) % len(words)] = f"edit{v}x{e}"
        out.append((start + v, " ".join(words)))
    return out


@pytest.fixture(scope="module")
def crowd():
    rows = [(i, prose(EN, i, 60 + i % 50)) for i in range(100)]
    rows += variants(prose(EN, 500, 300), 60, 3, 1000)      # near copies of one text, chained
    rows += variants(prose(EN, 501, 200), 25, 2, 2000)
    rows += [(3000 + i, prose(EN, 502, 90)) for i in range(40)]  # exact copies
    return rows


def test_against_all_pairs(make_docs, crowd, messy):
    rows = crowd + [(9001, "One two"), (9002, "one  TWO"), (9003, None), (9004, ""), (None, prose(EN, 502, 90))]
    got = N.near_duplicates(make_docs(rows)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in got) == sorted(
        (d or -1, n, c or -1) for d, n, c in slow_components(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_leftover_pairs_inside_buckets_are_found(spark, make_docs):
    """Copies of copies: far from the centre, near each other."""
    base = prose(EN, 503, 120)
    rows = [(4000, base)] + variants(base, 30, 1, 4001)
    far = variants(base, 1, 14, 0)[0][1]                       # too far from the base for a link
    rows += [(5000, far)] + [(5001 + k, " ".join(w if p != 7 + 3 * k else f"again{k}" for p, w in enumerate(far.split()))) for k in range(8)]
    rows += [(6000 + k, v) for k, (_, v) in enumerate(variants(base, 60, 9, 0))]
    got = {r.doc_id: r.component_id for r in N.near_duplicates(make_docs(rows)).collect()}
    want = {d: c for d, _, c in slow_components(rows)}
    assert got == want
    assert want[5003] == 5000 and want[4003] == 4000 and len({want[6000 + k] for k in range(60)}) > 20


def test_leftovers_against_all_pairs(spark):
    """The prefix filter around a centre misses no linked pair that grouping left apart."""
    rng = np.random.default_rng(12)
    centre = list(range(1000, 1150))
    sets = {}
    for i in range(120):
        s = set(centre)
        for block in rng.choice(15, rng.integers(0, 4), replace=False):
            s -= set(range(1000 + 10 * block, 1000 + 10 * block + rng.integers(2, 9)))
            s |= set(range(5000 + 100 * block, 5000 + 100 * block + rng.integers(0, 7)))
        s |= set(rng.integers(10_000, 10_000_000, rng.integers(0, 9)).tolist())
        sets[i] = s
    c = set(centre)
    linked = lambda a, b: 100 * len(a & b) >= 85 * len(a | b)
    rows = []
    for i, s in sets.items():
        d = sorted(s - c) + sorted(c - s)
        rows.append((i, 999, len(s), linked(s, c), len(d), d[: int(len(s) * (15 / 185 * (1 + 100 / 85))) + 2]))
        rows[-1] += (d,)
    checked = spark.createDataFrame(rows, "u long, v long, n int, linked boolean, delta int, prefix array<long>, d array<long>")
    checked = checked.withColumn("bits", N.bitmap("d")).drop("d")
    groups = N.components(checked.where("linked").select("u", "v"))
    root = {r.node: r.root for r in groups.collect()}
    got = {frozenset(map(int, r)) for r in N.leftovers(checked, groups, 85).collect()}
    want = {frozenset((i, j)) for i in sets for j in sets if i < j and root.get(i, i) != root.get(j, j) and linked(sets[i], sets[j])}
    assert want and want <= got
    assert len(got) < 120 * 119 / 4


def test_shuffle_path_gives_the_same(make_docs, crowd, monkeypatch):
    docs = make_docs(crowd[::3])
    want = sorted(N.near_duplicates(docs).collect())
    monkeypatch.setattr(N, "bounded_broadcast", lambda df, rows, limit=0: df)
    assert sorted(N.near_duplicates(docs).collect()) == want


def test_components_of_long_chains(spark):
    import random
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000 + i, 1000) for i in range(200)] + [(2000, 2000)]
    random.Random(4).shuffle(edges)
    df = spark.createDataFrame(edges, "u long, v long").repartition(9)
    got = {r.node: r.root for r in N.components(df).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{1000 + i: 1000 for i in range(1, 200)}}


def test_superminhash_is_unbiased_with_less_variance():
    rng = np.random.default_rng(3)
    for n in (40, 400):
        errors = []
        for _ in range(80):
            u = np.unique(rng.integers(0, 2 ** 62, 2 * n, dtype=np.uint64))
            a, b = u[: int(len(u) * 0.75)], u[int(len(u) * 0.25):]
            r = N.superminhash([a, b], 125)
            errors.append((r[0] == r[1]).mean() - 0.5)
        assert abs(np.mean(errors)) < 0.02
        # against independent hashes: less where elements are few, about the same where they are many
        assert np.std(errors) < (0.25 / 125) ** 0.5 * (0.9 if n == 40 else 1.2)


def test_signatures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 2 ** 62, n, dtype=np.uint64)) for n in (1, 2, 5, 60, 700, 9000, 0)]
    together = N.superminhash(sets, 125)
    for s, row in zip(sets, together):
        assert (N.superminhash([s], 125)[0] == row).all()


def test_keep_first_and_awkward_rows(messy, make_docs):
    kept = N.keep_first(messy)
    assert kept.columns == messy.columns
    ids = sorted((r.doc_id or -1) for r in kept.collect())
    assert ids == [-1, -1, 1, 2, 3, 4, 5, 7, 8, 8, 9, 10]  # 6 is a copy of 1, twice; both texts of 8 differ
    again = make_docs([(5, prose(EN, 1, 90), None, "a", 1), (5, prose(EN, 1, 90), None, "b", 2), (6, prose(EN, 1, 90))])
    assert [r.doc_id for r in N.keep_first(again).collect()] == [5]
    assert N.near_duplicates(make_docs([])).count() == 0
    assert N.keep_first(make_docs([])).count() == 0
