"""Filter interactions: every order replayed document by document, and the intervals of ranks."""

import random
import re
from itertools import permutations

import pytest
from pyspark.sql import types as T

from strata.llm import filter_audit as A

LABELS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])


def replay(docs, labels):
    """Expected rows by applying every order to every document."""
    def has(i, pos):
        return i is not None and any(r[0] == i and r[pos] == 1 for r in labels)

    rows = []
    for d in docs:
        i, text, lang = d[0], d[1] or "", d[2] or ""
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        bad = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
               "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
               "E": i is not None and any(o[0] is not None and o[0] < i and (o[1] or "") == text for o in docs)}
        rows.append((lang, bad, has(i, 1), has(i, 2)))
    out = {}
    for part in {r[0] for r in rows}:
        mine, shapley = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(mine)
            for step, x in enumerate(order, 1):
                gone = [r for r in left if r[1][x]]
                left = [r for r in left if not r[1][x]]
                shapley[x] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(r[1][x] for r in mine) - len(gone),
                    sum(r[1][x] and sum(r[1].values()) == 1 for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for order in permutations("ABCDE"):
            for step, x in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[x])
    return {k: tuple(v) for k, v in out.items()}


def got(df):
    cols = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = df.collect()
    assert len({(r.part, r.filter_order, r.step) for r in rows}) == len(rows)
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in cols) for r in rows}


def awkward(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n\t", "A B C", "a # b", "Ab " * 60, " ".join(f"w{i}" for i in range(120)), " ".join(f"w{i % 90}" for i in range(120)),
             "É" * 20 + "AB", " ".join(f"X{i}$" for i in range(150)), "one two three", " one two three", " wide ", "x\x0by\x0cz " * 40]
    docs = [(rng.choice([None, *range(25)]), rng.choice(texts), rng.choice([None, "", "en", "de"]), "s", 1) for _ in range(120)]
    labels = [(rng.choice([None, *range(25)]), rng.choice([None, 0, 1]), rng.choice([None, 0, 1])) for _ in range(40)]
    return docs, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_replaying_every_order(spark, make_docs, seed):
    docs, labels = awkward(seed)
    marks = spark.createDataFrame(labels, LABELS)
    for c in ("part", "mask", "digest", "spread", "n"):
        marks = marks.withColumn(c, marks.doc_id)
    assert got(A.audit(make_docs(docs, clashes=True), marks)) == replay(docs, labels)


def test_a_text_that_a_third_of_all_rows_share(spark, make_docs):
    common = "the same words again " * 30
    docs = [(i, common if i % 3 == 0 else f"text {i} " * 50, "en" if i % 2 else None) for i in range(300)]
    docs += [(0, common, "de"), (None, common, "en"), (None, common, "en")]
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 300, 5)]
    found = got(A.audit(make_docs(docs), spark.createDataFrame(labels, LABELS)))
    assert found == replay(docs, labels)
    assert sum(found[p, "EABCD", 1][1] for p in ("en", "de", "")) == 99  # all but the smallest id; equal ids and NULL ids stay


def test_very_long_text(spark, make_docs):
    docs = [(1, "word " * 1_000_000, "en"), (2, "A" * 5_000_000, "en"), (3, "word " * 1_000_000, "en")]
    assert got(A.audit(make_docs(docs), spark.createDataFrame([(1, 1, 1)], LABELS))) == replay(docs, [(1, 1, 1)])


def test_empty_tables(spark, make_docs):
    assert A.audit(make_docs([]), spark.createDataFrame([], LABELS)).count() == 0
    assert got(A.audit(make_docs([(1, "a", "en")]), spark.createDataFrame([], LABELS))) == replay([(1, "a", "en")], [])


def test_intervals_cover_every_order_once():
    letters = list("ABCDE")
    assert [A.lehmer_rank("".join(p), letters) for p in permutations(letters)] == list(range(120))
    rows = A.intervals(letters)
    for mask in range(1, 32):
        at = sorted(r for m, _, a, b in rows if m == mask for r in range(a, b))
        assert at == list(range(120))
    for mask, step, a, b in rows:
        for rank in (a, b - 1):
            order = list(permutations(letters))[rank]
            assert [bool(mask >> letters.index(x) & 1) for x in order].index(True) == step - 1
