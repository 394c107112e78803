"""Template decontamination: exact, embedded, re-parameterised and inconsistent copies."""

import pytest

from strata.llm import decontaminate as D
from tests.llm.conftest import DE, EN, prose

ITEM = ("A train leaves the station at 9 and travels 120 km with Anna Smith before it stops for 15 minutes. "
        "How far does it travel in 3 hours if it goes on at the same speed after the stop, and when does Anna Smith arrive?")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, ITEM), (2, prose(DE, 5, 30)), (3, "too short to tell"), (4, None), (5, "")],
                                 "item_id long, text string")


def found(docs, bench):
    return {(r.doc_id, r.item_id): r for r in D.matches(docs, bench).collect()}


def wrap(text, k):
    return f"{prose(EN, 40 + k, 50)} {text} {prose(EN, 60 + k, 50)}"


def test_copies_are_found_and_clean_documents_left(make_docs, bench):
    other = (ITEM.replace("120 km", "95 miles").replace("Anna Smith", "Peter Brown").replace("15", "40").replace(" 9 ", " 7 ").replace("3 h", "6 h"))
    mixed_up = ITEM.replace("Anna Smith arrive", "Peter Brown arrive").replace("Anna Smith before", "Maria Lopez before")
    docs = make_docs([(10, wrap(ITEM, 0)), (11, wrap(ITEM.upper(), 1)), (12, wrap(other, 2)), (13, wrap(" *** ".join(ITEM.split()), 3)),
                      (14, prose(EN, 99, 300)), (15, " ".join(ITEM.split()[:10]) + " " + prose(EN, 7, 80)), (16, prose(DE, 5, 30)),
                      (17, wrap(mixed_up, 4)), (18, wrap(ITEM.replace("\n", " "), 5).replace(" ", "\n"))])
    got = found(docs, bench)
    assert {(10, 1), (12, 1), (13, 1), (16, 2), (17, 1)} <= set(got)
    assert (14, 1) not in got and (15, 1) not in got
    assert all(i in (1, 2) for _, i in got)
    assert got[10, 1].coverage > 0.9 and not got[10, 1].reparameterised and got[10, 1].n_slots >= 8
    assert got[12, 1].reparameterised and got[12, 1].slot_consistency == 1.0
    assert got[17, 1].slot_consistency < 1.0


def test_slots_must_be_consistent(make_docs, spark):
    item = "if 5 red cars need 5 blue lamps and 5 green doors then 5 old men pay 5 new coins for 5 grey hats on 5 dry days"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    same = item.replace("5", "8")
    chaos = item
    for n in ("1", "2", "3", "4", "6", "7", "9"):
        chaos = chaos.replace("5", n, 1)
    got = found(make_docs([(1, same), (2, chaos)]), bench)
    assert set(got) == {(1, 1)} and got[1, 1].reparameterised


def test_awkward_rows_and_clean(messy, bench, make_docs, spark):
    extra = make_docs([(None, ITEM), (6, ITEM), (20, ITEM), (20, ITEM)])
    docs = messy.unionByName(extra, allowMissingColumns=True)
    assert set(found(docs, bench)) == {(None, 1), (6, 1), (20, 1)}
    left = D.clean(docs, bench)
    assert left.columns == docs.columns
    assert left.count() == messy.count()  # rows that share an id with a dirty text stay
    assert D.matches(make_docs([]), bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.matches(docs, none).count() == 0
    assert D.clean(docs, none).count() == docs.count()


def test_shuffle_path_gives_the_same(make_docs, bench, monkeypatch):
    docs = make_docs([(i, wrap(ITEM, i) if i % 3 else prose(EN, i, 60)) for i in range(12)])
    want = sorted(map(tuple, D.matches(docs, bench).collect()))
    monkeypatch.setattr(D, "bounded_broadcast", lambda df, n, limit=0: df)
    assert want and sorted(map(tuple, D.matches(docs, bench).collect())) == want


def test_covered_positions(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([([0],), ([0, 1, 2],), ([0, 20],), ([3, 7, 30],)], "at array<int>")
    assert [r[0] for r in df.select(D.covered(F.col("at"))).collect()] == [8, 10, 16, 20]
