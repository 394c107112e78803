"""SimHash: fingerprints against their definition, trees and shards against all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strata.llm import simhash as S
from tests.llm.conftest import EN, prose


def defined(text):
    """The fingerprint word by word as the contract states it."""
    lower = (text or "").encode().lower().decode()
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps):
    """Component of every (fp, node) by all pairs."""
    parent = {n: n for _, n in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, (f, a) in enumerate(fps):
        for g, b in fps[:i]:
            if (f ^ g).bit_count() <= 3:
                a_, b_ = find(a), find(b)
                parent[max(a_, b_)] = min(a_, b_)
    return {n: find(n) for _, n in fps}


def test_fingerprint_is_as_defined(messy):
    texts = [r.text for r in messy.collect()] + ["a", "a b", "A B c", "a b c d", " x y z \x1f q", "ÄÖ ä Ö É"]
    for t in texts:
        assert S.fingerprint((t or "").encode()) == defined(t)


def test_hash_is_sparks(spark):
    one = spark.range(1).select(F.xxhash64(F.lit("one two three")).alias("h")).first().h
    assert one % (1 << 64) == S.fingerprint(b"One  two\nTHREE")


@pytest.mark.parametrize("piece", [1, 7, 64, 5000])
def test_pieces_do_not_change_a_fingerprint(monkeypatch, piece):
    text = prose(EN, 3, 700).encode() + b"   \n" * 50 + b"tail  words x"
    whole = S.fingerprint(text)
    monkeypatch.setattr(S, "_PIECE", piece)
    monkeypatch.setattr(S, "_COUNTED", 100)
    assert S.fingerprint(text) == whole == defined(text.decode())


def test_very_long_text():
    text = (prose(EN, 1, 5000) + " ").encode() * 200  # 5 MB
    assert S.fingerprint(text) == S.fingerprint(text) != 0
    assert S.fingerprint(b"x" * 5_000_000) == xxhash.xxh64_intdigest(b"x" * 5_000_000, seed=42)


def crowd(rng, n, spread, bits=64):
    base = rng.getrandbits(64)
    out = set()
    while len(out) < n:
        x = base
        for _ in range(rng.randint(0, spread)):
            x ^= 1 << rng.randrange(bits)
        out.add(x)
    return out


def mixed(seed):
    rng = random.Random(seed)
    fps = crowd(rng, 250, 8) | crowd(rng, 150, 4) | crowd(rng, 80, 12) | {rng.getrandbits(64) for _ in range(200)} | {0, (1 << 64) - 1, 1 << 63}
    fps = sorted(fps)
    rng.shuffle(fps)
    return [(f, 10 * i + 3) for i, f in enumerate(fps)]


def test_trees_find_every_pair():
    fps = np.array([f for f, _ in mixed(5)], dtype=np.uint64)
    root = np.where(np.arange(len(fps)) < 300, 0, 300).astype(np.int32)  # two shards
    pairs = set()
    for a, b in S.Trees(fps, root).near(np.arange(len(fps)), 3):
        pairs |= set(zip(a.tolist(), b.tolist()))
    expected = {(i, j) for i in range(len(fps)) for j in range(i)
                if root[i] == root[j] and (int(fps[i]) ^ int(fps[j])).bit_count() <= 3}
    assert pairs == expected and len(expected) > 300


def test_a_tree_search_follows_edges_within_the_radius_only(monkeypatch):
    rng = random.Random(1)
    fps = np.array([rng.getrandbits(64) for _ in range(4000)], dtype=np.uint64)
    trees, seen, count = S.Trees(fps, np.zeros(4000, dtype=np.int32)), [], np.bitwise_count
    monkeypatch.setattr(S.np, "bitwise_count", lambda x: (seen.append(len(x)), count(x))[1])
    list(trees.near(np.arange(4000), 3))
    assert sum(seen) < 0.8 * 4000 * 4000 / 2


@pytest.mark.parametrize("size,held,pairs", [(16_384, 1 << 15, 1 << 21), (64, 50, 300), (10, 1, 1)])
def test_groups_equal_all_pairs(spark, monkeypatch, size, held, pairs):
    fps = mixed(9)
    monkeypatch.setattr(S, "_HELD", held)
    monkeypatch.setattr(S, "_PAIRS", pairs)
    classes = spark.createDataFrame([(S._signed(f), n) for f, n in fps], "fp bigint, node bigint").repartition(5)
    roots = {r.node: r.root for r in S.groups_of(classes, size=size).collect()}
    expected = components(fps)
    assert {n: roots.get(n, n) for _, n in fps} == expected
    assert len(set(expected.values())) < len(fps) - 300


def test_blocks_leave_no_pair_out():
    rng = random.Random(3)
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for _ in range(3):
            y ^= 1 << rng.randrange(64)
        same = [m for m in S.masks() if x & m == y & m]
        assert same
        for m in same:
            assert any(x & f == y & f for f in S.finer(m))
    assert {m.bit_count() for m in S.masks()} <= {25, 26}
    assert {64 - f.bit_count() for m in S.masks() for f in S.finer(m)} <= {18, 19, 20, 21}  # bits that a crowd's key leaves open


def test_documents_and_awkward_rows(spark, messy, make_docs):
    rows = S.near_duplicates(messy).collect()
    given = messy.collect()
    assert len(rows) == len(given)
    fps = {}
    for r in given:
        if r.doc_id is not None:
            f = defined(r.text)
            fps[f] = min(fps.get(f, r.doc_id), r.doc_id)
    comp = components(list(fps.items()))
    expected = sorted(((r.doc_id, f"{defined(r.text):016x}", None if r.doc_id is None else comp[fps[defined(r.text)]]) for r in given), key=repr)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in rows), key=repr) == expected
    assert S.near_duplicates(make_docs([])).count() == 0
    empty = {r.doc_id: r.component_id for r in S.near_duplicates(make_docs([(5, None), (3, ""), (9, " \t")])).collect()}
    assert empty == {5: 3, 3: 3, 9: 3}


def test_query_equals_all_pairs(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = S.near_duplicates(docs).collect()
    fps = {}
    for r in docs.collect():
        f = defined(r.text)
        fps[f] = min(fps.get(f, r.doc_id), r.doc_id)
    comp = components(list(fps.items()))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        r.doc_id: (f"{defined(r.text):016x}", comp[fps[defined(r.text)]]) for r in docs.collect()}
