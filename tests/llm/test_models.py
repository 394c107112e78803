"""Language identification, quality ranking and toxicity: held-out accuracy and awkward rows."""

import math

import numpy as np
import pytest

from strata.llm import charlm, langid, quality_rank, toxicity
from strata.llm.common import crc_mod
from pyspark.sql import functions as F
from tests.llm.conftest import DE, EN, prose

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


# -- character models --------------------------------------------------------------------------------


def grams(words, order):
    out = {}
    for w in words:
        for g in charlm.grams_of(w, order):
            out[g] = out.get(g, 0) + 1
    return sorted(out.items())


def test_kneser_ney_is_a_distribution():
    words = "the then there them other mother brother bother both bath".split() * 3 + ["that", "thin"]
    alphabet = {c for w in words for c in w} | {charlm.END, charlm.START}
    m = charlm.KneserNey(grams(words, 3), 3, len(alphabet))
    for context in ("th", "zz", charlm.START * 2, "er", "xt"):
        total = sum(math.exp(m.logp(context + c)) for c in alphabet)
        assert 0.9 < total <= 1.0 + 1e-9  # the floor keeps one share for unknown characters
    assert m.word("mother") > m.word("xqzwvk")


def test_hash_tables_agree_with_the_models():
    models = {"en": charlm.KneserNey(grams(EN, 4), 4, 40), "de": charlm.KneserNey(grams(DE, 4), 4, 40)}
    t = charlm.Tables.build(models)
    words = EN + DE + ["unseen", "qqq", "é", "über", "x" * 50, "日本"]
    got = t.words(words)
    for i, w in enumerate(words):
        for j, m in enumerate(models.values()):
            assert got[i, j] == pytest.approx(m.word(w), rel=1e-4), w
    assert t.words([]).shape == (0, 2)


def test_counts_cover_all_texts(spark):
    texts = [("a", prose(EN, i, 50)) for i in range(20)] + [("b", None), ("b", "")]
    df = spark.createDataFrame(texts, "model string, text string").select(
        "model", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("raw"))
    want = dict(grams([w for _, t in texts[:20] for w in charlm.words_of(t.encode())], 4))
    assert {r.gram: r.n for r in charlm.count_grams(df.repartition(5), 4).collect()} == want


# -- language identification --------------------------------------------------------------------------


def test_language_held_out_accuracy(tables):
    docs, _ = tables
    model = langid.fit(docs, langid.training_rows())
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(crc_mod("doc_id", 3) == 1)
    rows = got.collect()
    assert len(rows) > 250 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_awkward_rows(messy, make_docs):
    model = langid.fit(messy, F.lit(True))
    got = langid.predict(messy, model).collect()
    assert len(got) == messy.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].lang_pred == "en" and by[2][0].lang_pred == "de" and by[5][0].lang_pred == "en"
    assert {(r.lang_pred, r.score) for i in (3, 4, 7) for r in by[i]} == {("und", 0.0)}
    assert by[6][0] == by[6][1]
    other = langid.predict(make_docs([(1, "щука плавает в реке " * 20), (2, "12 34 ... 5²")]), model).collect()
    assert other[0].rejected and other[1].lang_pred in ("und",)
    empty = make_docs([])
    assert langid.predict(empty, model).count() == 0
    untaught = langid.fit(empty, F.lit(True))
    assert {r.lang_pred for r in langid.predict(messy, untaught).collect()} == {"und"}


def test_spark_fit_equals_the_local_fit(spark):
    words = {"en": EN, "de": DE, "x": ["a", "aa", "日本", "b"]}
    counts = spark.createDataFrame([(m, g, n) for m, w in words.items() for g, n in grams(w, 4)], "model string, gram string, n bigint")
    fitted = charlm.fit_tables(counts, 4)
    alphabet = len({c for w in words.values() for g, _ in grams(w, 4) for c in g})
    want = {m: charlm.KneserNey(grams(w, 4), 4, alphabet) for m, w in words.items()}
    got = charlm.KneserNey.collected(fitted)
    assert sorted(got) == sorted(want)
    for name, m in want.items():
        assert got[name].floor == m.floor
        for k in range(1, 5):
            assert got[name].prob[k] == pytest.approx(m.prob[k], rel=1e-9)
            assert got[name].back[k] == pytest.approx(m.back[k], rel=1e-9)
    assert fitted.n_entries == sum(len(t) for m in want.values() for t in (*m.prob, *m.back))
    asked = sorted({g for w in [*EN, *DE, "unseen", "日", "qqq"] for g in charlm.grams_of(w, 4)})
    rows = charlm.resolve(spark.createDataFrame([(g,) for g in asked], "gram string"), fitted).collect()
    assert sorted(r.gram for r in rows) == asked
    for r in rows:
        assert r.v == pytest.approx([want[m].logp(r.gram) for m in fitted.names], rel=1e-9), r.gram


def test_language_tables_too_large_to_travel(tables, messy, make_docs):
    docs = tables[0].select("doc_id", "text", "lang").union(messy.select("doc_id", "text", "lang"))
    near, far = langid.fit(docs, langid.training_rows()), langid.fit(docs, langid.training_rows(), local_entries=0)
    assert near.tables is not None and far.tables is None
    key = lambda r: (repr(r.doc_id), r.lang_pred, r.score)
    one, other = (sorted(langid.predict(docs, m).collect(), key=key) for m in (near, far))
    assert [(r.doc_id, r.lang_pred, r.rejected) for r in one] == [(r.doc_id, r.lang_pred, r.rejected) for r in other]
    for a, b in zip(one, other):
        assert a.score == pytest.approx(b.score, abs=1e-4) and (a.cross_entropy or 0) == pytest.approx(b.cross_entropy or 0, rel=1e-4)
    empty = make_docs([])
    assert langid.predict(empty, far).count() == 0


def test_rare_ngrams_behind_many_frequent_ones_count(make_docs):
    rng = np.random.default_rng(3)
    words = ["".join(chr(97 + c) for c in row) for row in rng.integers(0, 26, size=(50_000, 8))]
    assert len({w[i:i + 4] for w in words for i in range(5)}) > 150_000
    common = " ".join(words + words)
    model = langid.fit(make_docs([(1, common, "a"), (2, common, "b"), (3, "ŋøþ", "b")]), F.lit(True))
    assert min(model.fitted.n_grams.values()) > 200_000 and model.tables is None
    (got,) = langid.predict(make_docs([(9, "ŋøþ")]), model).collect()
    assert got.lang_pred == "b" and got.score > 0.5


def test_the_calibration_measures_each_text_once(tables, monkeypatch, capsys):
    own, plans = langid.cut, []

    def spy(df, label):
        if label == "lang-calibration":
            df.explain()
            plans.append(capsys.readouterr().out)
        return own(df, label)
    monkeypatch.setattr(langid, "cut", spy)
    model = langid.fit(tables[0], langid.training_rows())
    assert model.tables is not None and len(plans) == 1
    assert plans[0].count("ArrowEvalPython") == 1


def test_words_are_looked_up_in_pieces(monkeypatch):
    t = charlm.Tables.build({"en": charlm.KneserNey(grams(EN, 4), 4, 40), "de": charlm.KneserNey(grams(DE, 4), 4, 40)})
    words = ["x" * 50, *EN, *DE, "é", "日本", "y" * 70]
    whole = t.words(words)
    sizes, own = [], charlm.Tables._lookup
    monkeypatch.setattr(charlm, "_CELLS", 40)
    monkeypatch.setattr(charlm.Tables, "_lookup", lambda self, cps, at, k: (k == 4 and sizes.append(len(at)), own(self, cps, at, k))[1])
    assert np.array_equal(t.words(words), whole)
    assert max(sizes) * 2 <= 40 + 2 * 71 and len(sizes) > 10


# -- quality -----------------------------------------------------------------------------------------


def test_quality_held_out_accuracy(tables):
    docs, labels = tables
    model = quality_rank.fit(docs, labels)
    rows = quality_rank.score(docs, model).join(labels, "doc_id").where(crc_mod("doc_id", 4) == 2).collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert np.mean([r.predicted for r in good]) > 0.97 and np.mean([1 - r.predicted for r in bad]) > 0.8
    assert all((r.score >= 0.7) == bool(r.predicted) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([g.score > b.score for g in good for b in bad]) > 0.98


def test_bradley_terry_orders_by_preference():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    strength = x @ np.array([2.0, -1.0, 0.0])
    y = (strength + rng.normal(scale=0.3, size=400) > 0).astype(int)
    m = quality_rank.fit_arrays(x, y)
    assert np.corrcoef(m.raw(x), strength)[0, 1] > 0.98
    assert np.mean((m.score(x) >= quality_rank.CUT) == (y == 1)) > 0.9


def test_quality_awkward_rows(messy, make_docs, tables, spark):
    _, labels = tables
    model = quality_rank.fit(messy, labels.limit(0))  # no labels: nothing is rejected
    rows = quality_rank.score(messy, model).collect()
    assert len(rows) == messy.count() and {r.predicted for r in rows} == {1}
    assert quality_rank.keep_good(messy, model).columns == messy.columns
    assert quality_rank.keep_good(messy, model).count() == messy.count()
    taught = spark.createDataFrame([(1, 1), (2, 1), (4, 0), (7, 0), (None, 1), (5, None)], "doc_id long, quality int")
    model = quality_rank.fit(messy, taught, F.lit(True))
    scores = {}
    for r in quality_rank.score(messy, model).collect():
        scores.setdefault(r.doc_id, []).append(r)
    assert scores[4][0].score == scores[3][0].score == scores[7][0].score  # NULL, empty and blank alike
    assert scores[1][0].score > scores[4][0].score
    assert quality_rank.score(make_docs([]), model).count() == 0


# -- toxicity ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def toxic_model(tables):
    return toxicity.fit(*tables)


def test_toxicity_held_out(tables, toxic_model):
    docs, labels = tables
    rows = toxicity.score(docs, toxic_model).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id").collect()
    clean = [r for r in rows if r.toxic == 0 and r.doc_id]
    assert np.mean([r.predicted for r in clean]) < 0.02
    english = [r for r in rows if r.toxic == 1 and r.lang == "en"]
    assert np.mean([r.predicted for r in english]) > 0.75
    assert all(0 <= r.score <= 1 and (r.score >= 0.5) == bool(r.predicted) for r in rows)


@pytest.mark.parametrize("hidden,plain", [("1d10t", "idiot"), ("m0r0n", "moron"), ("tr@sh", "trash"), ("stuuuupid", "stupid"), ("$tupid", "stupid"),
                                          ("l.o.s.e.r", "loser"), ("s t u p i d", "stupid"), ("cl0wn5", "clowns"), ("p-a-t-h-e-t-i-c", "pathetic")])
def test_restores_hidden_words(toxic_model, hidden, plain):
    d = toxicity.Decoder(toxic_model.lm)
    got, n = toxicity.restore(f"the {hidden} and".encode(), d)
    assert n == 1 and got.split()[1].rstrip("s") == plain.rstrip("s")


def test_leaves_plain_text_alone(toxic_model):
    d = toxicity.Decoder(toxic_model.lm)
    for text in ("The and of. A an i b", "mail me at foo.15@mail0.example.com", "token = 2abc3ff2ca8fb1e4c565a0eb63815530a948bdde",
                 "call +1 (614) 555-8001 or 10.0.0.1", "Ered*** reed*** ing&&&", "", "été où naïve ÉCOLE!!"):
        assert toxicity.restore(text.encode(), d) == (text.lower(), 0)


def test_hidden_words_score_like_plain_ones(make_docs, toxic_model):
    body = prose(EN, 3, 60)
    plain = f"{body} you idiot you moron you worthless stupid scum {body}"
    hidden = f"{body} you 1d10t you m0r0n you w0rthle$$ stuuupid s c u m {body}"
    rows = {r.doc_id: r for r in toxicity.score(make_docs([(1, plain), (2, hidden), (3, body)]), toxic_model).collect()}
    assert rows[1].predicted == rows[2].predicted == 1 and rows[3].predicted == 0
    assert rows[2].n_restored >= 4 and abs(rows[1].score - rows[2].score) < 0.3


def test_toxicity_awkward_rows(messy, make_docs, toxic_model, tables):
    rows = toxicity.score(messy, toxic_model).collect()
    assert len(rows) == messy.count() and all(r.predicted == 0 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4, 7)}) == 1
    assert toxicity.score(make_docs([]), toxic_model).count() == 0
    untaught = toxicity.fit(messy, tables[1].limit(0))
    assert {r.score for r in toxicity.score(messy, untaught).collect()} == {0.0}


def test_toxicity_tables_too_large_to_travel(tables, toxic_model, messy, make_docs):
    docs, labels = tables
    far = toxicity.fit(docs, labels, local_entries=0)
    assert toxic_model.travels and not far.travels and far.lexicon == toxic_model.lexicon
    assert far.weights == pytest.approx(toxic_model.weights, rel=1e-9)
    extra = make_docs([(9_001, "you s t u p 1 d 1d10t and m0r0n, st..upid l.o.s.e.r " * 5), (9_001, "a b c d 3 f")])
    some = docs.select("doc_id", "text").union(messy.select("doc_id", "text")).union(extra.select("doc_id", "text"))
    one, other = (sorted(toxicity.score(some, m).collect(), key=repr) for m in (toxic_model, far))
    assert one == other and sum(r.n_restored > 0 for r in one) > 10
    assert toxicity.score(make_docs([]), far).count() == 0


@pytest.mark.parametrize("hidden,plain", [("st..upid", "stupid"), ("id--iot", "idiot"), ("1 d 1 0 t", "idiot"), ("st" + "u" * 40 + "pid", "stupid")])
def test_restores_what_hardly_shows(toxic_model, hidden, plain):
    d = toxicity.Decoder(toxic_model.lm)
    got, n = toxicity.restore(f"the {hidden} and".encode(), d)
    assert n == 1 and got.split()[1].rstrip("s") == plain.rstrip("s")


def test_restores_runs_of_any_length(toxic_model, monkeypatch):
    d = toxicity.Decoder(toxic_model.lm)
    hidden = " ".join("stupididiotmoronloser" * 10)  # 210 letters
    got, n = toxicity.restore(f"the , {hidden}".encode(), d)
    assert n == 1 and sum(w in ("stupid", "idiot", "moron", "loser") for w in got.split()) >= 20  # how words are parted is the model's guess
    phrase = "stupid-m0ron-and-a-stupid-1d10t-and-l0ser"
    assert {"moron", "idiot", "loser"} <= set(toxicity.restore(phrase.encode(), d)[0].split())
    monkeypatch.setattr(toxicity, "_SETTLE", 10 ** 9)
    assert toxicity.restore(f"the , {hidden}".encode(), toxicity.Decoder(toxic_model.lm)) == (got, n)


def test_gate_misses_nothing(toxic_model, monkeypatch):
    rng = np.random.default_rng(11)
    chars = list("   aabbst1050..--__**!@$'(,\néſ€哈哈Kſ٣—")
    texts = ["".join(rng.choice(chars, rng.integers(1, 14))) for _ in range(6000)]
    d = toxicity.Decoder(toxic_model.lm)
    gated = [toxicity.restore(t.encode(), d) for t in texts]
    assert sum(n for _, n in gated) > 500
    assert any(not toxicity.suspicious(t.encode()) for t in texts)
    monkeypatch.setattr(toxicity, "suspicious", lambda raw: 3)
    assert [toxicity.restore(t.encode(), d) for t in texts] == gated


def test_a_repeated_id_stays_within_the_label_sample(spark, make_docs):
    """The bound of the sample holds for rows, whatever repeats an id or a label."""
    from strata.llm import quality_rank as R
    docs = make_docs([(1, f"text {i % 50}") for i in range(20_000)] + [(2, "other"), (3, None)])
    labels = spark.createDataFrame([(1, 1), (1, 0), (1, 1), (2, 1), (3, 0), (None, 1)], "doc_id long, quality int")
    rows = R.labelled_sample(docs, labels, "quality", F.lit(True), 10).collect()
    assert sorted((r._id, r._y) for r in rows) == [(1, 0), (1, 1), (2, 1), (3, 0)]
    assert rows == R.labelled_sample(docs.repartition(7), labels, "quality", F.lit(True), 10).collect() or sorted(rows, key=repr) == sorted(
        R.labelled_sample(docs.repartition(7), labels, "quality", F.lit(True), 10).collect(), key=repr)


def test_one_token_without_blanks_costs_in_proportion():
    import time

    from strata.llm import toxicity as X
    began = time.time()
    for token in ("a1" * 100_000 + "€x/", "x" * 200_000 + "/", "ab.c" * 50_000 + "/=", "1" * 200_000):
        assert X._SUSPECT.search(token) is None
    assert X._SUSPECT.search('say "id1ot"!, ok').group(1) and time.time() - began < 3


def test_the_calibration_reads_every_training_text(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join("".join(rng.choice(list("abcdefgh"), 4)) for _ in range(rng.integers(1, 6))), "en") for i in range(4_300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, F.lit(True))
    h = []
    for _, text, _ in rows:
        chars, x = langid.entropies(model.tables, [text.encode()])
        h.append((x[0][0], chars[0]))
    mean = float(np.median([x for x, _ in h]))
    spread = float(np.median([abs(x - mean) * np.sqrt(n) for x, n in h])) * 1.4826
    assert abs(model.mean["en"] - mean) <= 1 / langid.GRID and abs(model.spread["en"] - spread) <= 2e-3
    seen = []
    measured = langid.measured
    monkeypatch.setattr(langid, "measured", lambda rows, *a: (seen.append(rows.count()), measured(rows, *a))[1])
    langid.fit(df, F.lit(True))
    assert seen == [len(rows)]
