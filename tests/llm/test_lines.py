"""Line templates against a slow restatement."""

import math
import re
from collections import defaultdict

import pytest

from strata.llm import line_templates as L
from tests.llm.conftest import EN, prose


def keys_of(line):
    tokens = [t.lower() for t in re.findall(r"[^\x20\x09-\x0D]+", line)]
    tokens = ["<*>" if re.search(r"[0-9@]|://|^www\.", t) else t for t in tokens]
    n = len(tokens)
    if n < L.MIN_TOKENS:
        return None, []
    fields = []
    if n >= L.MIN_FIELD_TOKENS:
        for g in range(L.FIELDS):
            free = {p for p in range(L.LEADING, n) if (p - L.LEADING) * L.FIELDS // (n - L.LEADING) == g}
            fields.append((n, g, tuple("*" if p in free else t for p, t in enumerate(tokens))))
    return tuple(tokens), fields


def slow(rows):
    docs = [(math.inf if d is None else d, (t or "").split("\n") if t is not None else None) for d, t in rows]
    first, last = {}, {}
    for d, lines in docs:
        for line in lines or []:
            k = keys_of(line)[0]
            if k:
                first[k], last[k] = min(d, first.get(k, d)), max(d, last.get(k, d))
    late = lambda d, line: (k := keys_of(line)[0]) is not None and first[k] < d
    f1 = defaultdict(list)
    for d, lines in docs:
        for line in lines or []:
            if not late(d, line):
                for k in keys_of(line)[1]:
                    f1[k].append(d)
    out = []
    for (d, lines), (i, t) in zip(docs, rows):
        if t is None:
            out.append((i, 0, 0, None))
            continue
        kept = [x for x in lines if not late(d, x) and all(min(f1[k]) == d or min(f1[k]) == max(f1[k]) for k in keys_of(x)[1])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept) if len(kept) < len(lines) else t))
    return out


def as_rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.fixture(scope="module")
def rows():
    notice = "please read the notes of this site before you post number {} in the forum today"
    out = [(i, "\n".join([prose(EN, i, 40), notice.format(i), "all rights are reserved by the site", prose(EN, i + 1, 25), "short line"]))
           for i in range(30)]
    base = prose(EN, 900, 40).split()
    for v in range(12):  # one word differs, at different places
        words = list(base)
        words[5 + 3 * v % 30] = f"variant{chr(97 + v)}"
        out.append((100 + v, "head " * v + "\n" + " ".join(words) + "\n\n"))
    return out + [(50, "the same line twice in one document only\nthe same line twice in one document only"),
                  (None, "all rights are reserved by the site"), (60, None), (61, ""), (62, "\n\n"), (63, "all  rights ARE reserved by the site "),
                  (64, "only one row has this line of words"), (64, "only one row has this line of words")]


def test_against_slow_restatement(make_docs, rows):
    assert as_rows(L.dedup(make_docs(rows))) == sorted(slow(rows), key=repr)


def test_shuffle_path_gives_the_same(make_docs, rows, monkeypatch):
    monkeypatch.setattr(L, "bounded_broadcast", lambda df, n, limit=0: df)
    assert as_rows(L.dedup(make_docs(rows))) == sorted(slow(rows), key=repr)


def test_real_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    want = slow([tuple(r) for r in docs.collect()])
    assert any(w[2] for w in want)
    assert as_rows(L.dedup(docs)) == sorted(want, key=repr)


def test_long_repeated_passage_stays_once(make_docs):
    passage = prose(EN, 77, 70)
    docs = make_docs([(i, f"{prose(EN, 300 + i, 30)}\n{passage}\n{prose(EN, 400 + i, 30)}") for i in (9, 4, 7, 5)])
    assert {r.doc_id for r in L.dedup(docs).collect() if passage in r.text} == {4}


def test_clean_and_awkward_rows(messy, make_docs):
    got = L.clean(messy)
    assert got.columns == messy.columns
    left = {r.doc_id: r for r in got.collect()}
    assert {1, 2, 3, 4, 5, 7, 8, 9} <= set(left) and 6 not in left  # 6 is a copy of 1
    assert left[3].text is None and left[4].text == "" and left[1].text == prose(EN, 1, 80) and left[1].n_chars == 1
    assert L.clean(make_docs([])).count() == 0
    assert L.dedup(make_docs([])).count() == 0


def test_rows_of_different_figures_stay(make_docs):
    first = "1 2 3 4 5 6\n| 10 | 20 | 30 | 40 |\nBolts 1.25 1.30 1.35 1.40 1.45\n7 8 9 10 11 12"
    other = "12.5 13.6 14.2 15.1 16.0 17.9\n| 11 | 21 | 31 | 41 |\nBolts 2.25 2.30 2.35 2.40 2.45\n7  8 9 10 11 12"
    long_rows = [" ".join(str(100 * d + (0 if i < 11 else d) + i) if i >= 11 else str(i) for i in range(14)) for d in (1, 2)]
    docs = make_docs([(1, first), (2, other), (3, "21 22 23 24 25 26"), (4, long_rows[0]), (5, long_rows[1]),
                      (6, "order 17 of alice was sent on 2024-01-05"), (7, "order 18 of alice was sent on 2024-02-06")])
    got = {r.doc_id: (r.n_dropped, r.text) for r in L.dedup(docs).collect()}
    assert got[1] == (0, first) and got[2] == (1, "\n".join(other.split("\n")[:3]))  # the equal row alone goes
    assert [got[d][0] for d in (3, 4, 5, 6, 7)] == [0, 0, 0, 0, 1]
    assert {r.doc_id for r in L.clean(docs).collect()} == {1, 2, 3, 4, 5, 6}
