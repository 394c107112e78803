"""One text of about 5 MB among short ones: whole results in bounded time."""

import pytest
from pyspark.sql import functions as F

from strata.llm import langid, licenses, quality_rank, quality_rules, toxicity
from tests.llm.conftest import DE, EN, prose

SF = "/root/testdata/sf0.01"
N = 1_000


@pytest.fixture(scope="module")
def long_docs(make_docs):
    """Document 1 repeats document 2 ``N`` times, with a license line at its end."""
    body = "\n".join(prose(EN, k, 60) for k in range(15))
    tail = "\nLicensed under the MIT license."
    assert len(body) * N > 4_500_000
    return make_docs([(1, (body + "\n") * N + tail, "en"), (2, body, "en"), (3, prose(DE, 4, 300), "de")])


def test_rules_count_the_whole_text(long_docs):
    rows = {r.doc_id: r for r in quality_rules.ledger(long_docs).collect()}
    assert rows[1].n_words == N * rows[2].n_words + 5


def test_license_at_the_end_is_found(long_docs):
    rows = {r.doc_id: r for r in licenses.scan(long_docs).collect()}
    assert rows[1].n_base == 1 and rows[1].first_word == rows[1].n_words - 4 and rows[2].labels == ""


def test_language_of_the_whole_text(long_docs):
    model = langid.fit(long_docs, F.col("doc_id") != 1)
    rows = {r.doc_id: r for r in langid.predict(long_docs, model).collect()}
    assert (rows[1].lang_pred, rows[3].lang_pred) == ("en", "de")
    assert rows[1].cross_entropy == pytest.approx(rows[2].cross_entropy, rel=1e-2)


def test_toxic_words_at_the_end_count(long_docs, spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    end = " you 1d10t you m0r0n you w0rthle$$ stuuupid s c u m " * 20
    more = long_docs.where("doc_id = 1").select("doc_id", F.concat("text", F.lit(end)).alias("text"))
    (plain,), (foul,) = (toxicity.score(d, model).collect() for d in (long_docs.where("doc_id = 1"), more))
    assert foul.n_restored >= plain.n_restored + 80 and foul.score > plain.score


def test_quality_of_the_whole_text(long_docs, spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_rank.score(long_docs, quality_rank.fit(docs, labels)).collect()
    assert len(rows) == 3 and all(0 <= r.score <= 1 for r in rows)
