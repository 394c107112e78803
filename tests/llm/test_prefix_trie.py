"""Prefix trie: every beginning of every rebuilt conversation held as text."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm import prefix_trie as P

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                      T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def reference(row):
    role, text = row[2] or "", row[3] or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def expected(rows):
    own = {}
    for r in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, reference(r))):
        own.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out, kids, leaves, saved, ends = [], {}, {}, {}, {}
    for path in nodes:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    for c, turns in built.items():
        ends.setdefault(turns, []).append(c)
    for path in sorted(nodes, key=len, reverse=True):
        words = len([w for w in path[-1][1].replace("\t", " ").replace("\n", " ").split(" ") if w]) if path else 0
        leaves[path] = sum(leaves[k] for k in kids.get(path, [])) if path in kids else 1
        saved[path] = (len(nodes[path]) - 1) * words + sum(saved[k] for k in kids.get(path, []))
    for path, members in nodes.items():
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), len(kids.get(path, [])), leaves[path],
                    saved[path], hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest()))
    return sorted(out)


def got(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in df.dtypes} == {"bigint", "string"}
    return sorted(map(tuple, df.collect()))


def random_rows(seed, convs=90, texts=3, longest=7):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-45, 140), convs):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None, ""]),
                         rng.choice([None, "", *["a b\tc " * (k + 1) for k in range(texts)]])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_whole_beginnings(spark, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, TURNS)
    for c in ("depth", "owner", "q0", "k", "words", "pid", "block", "digest", "last"):
        df = df.withColumn(c, F.lit("x"))
    assert got(P.trie(df)) == expected(rows)


def test_long_conversations_span_ranges_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 8)
    monkeypatch.setattr(P, "_PIECE", 3)
    rows = [(c, t, "u", f"word {t}" if t < cut else f"other {c} {t} x") for c, cut in ((40, 999), (41, 999), (42, 150), (60, 30), (45, 170), (47, 999))
            for t in range(200 if c != 47 else 90)]
    rows += [(c, 0, "u", "word 0") for c in range(100, 260)] + random_rows(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert got(P.trie(spark.createDataFrame(rows, TURNS))) == expected(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_products_do_not_depend_on_ranges(spark, ranges):
    rows = [(c, t, "u", f"t {t * c % 11}") for c in (1, 2, 5) for t in range(60)] + random_rows(6)
    base = P.bases(5)
    out = {(r.conv_id, r.k): [r[q] for q in P.Q] for r in P.products(P.turns_of(spark.createDataFrame(rows, TURNS)), base, ranges).collect()}
    own = {}
    for r in sorted((r for r in rows), key=lambda r: (r[0], r[1] is not None, r[1] or 0, reference(r))):
        own.setdefault(r[0], []).append(reference(r))
    for c, refs in own.items():
        q = [0] * P.LANES
        for k, ref in enumerate(refs, 1):
            for lane, b in enumerate(base):
                t = int.from_bytes(ref[8 * lane:8 * lane + 8], "little", signed=True)
                q[lane] = (q[lane] + t * pow(b, k, P.P)) % P.P
            assert out[c, k] == q


def test_colliding_bases_are_found_and_replaced(spark, monkeypatch):
    rows = random_rows(8)
    real, asked = P.bases, []

    def bases(seed):
        asked.append(seed)
        return [0] * P.LANES if len(asked) == 1 else real(seed)
    monkeypatch.setattr(P, "bases", bases)
    monkeypatch.setattr(P, "pow", lambda b, e, p: pow(b, e, p) if b or e >= 0 else 0, raising=False)
    assert got(P.trie(spark.createDataFrame(rows, TURNS))) == expected(rows)
    assert len(asked) == 2


def test_awkward_rows(spark):
    assert P.trie(spark.createDataFrame([], TURNS)).count() == 0
    assert P.trie(spark.createDataFrame([(None, 0, "u", "x")], TURNS)).count() == 0
    rows = [(2, None, None, None), (2, None, None, None), (2, 0, "u", "x y"), (2, 0, "u", "x y"), (None, 1, "u", "z"), (3, 5, "", ""),
            (-7, 0, "u", "long " * 400_000), (-20, 1, "u", "a"), (-20, 0, "u", "b"), (-27, 0, "u", "c")]
    assert got(P.trie(spark.createDataFrame(rows, TURNS))) == expected(rows)
    # turnless: its own turns are all behind no head, and there is no base
    lone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    out = got(P.trie(spark.createDataFrame([(lone, 0, "u", "x")], TURNS)))
    assert out == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
