"""Registered queries against their SQL, and the pipeline's stages."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as P
from strata.llm import near_dup
from strata.llm.queries import ORACLES, QUERIES
from tools.check import TABLES, canon

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = set(E.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[key](spark, SF)
    cols, rows = canon(df.columns, df.collect())
    rel = con.sql(ORACLES[key])
    assert (cols, rows) == canon(rel.columns, rel.fetchall())


CONTRACT = {
    "op2_": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op3_": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
             "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op4_": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
             "base_labels": "string", "labels": "string", "score": "double"},
    "op6_": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op7_": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op8_": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op9_": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op10_": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
}


@pytest.mark.parametrize("prefix", sorted(CONTRACT))
def test_contract_columns(spark, prefix):
    name = next(n for n in QUERIES if n.startswith(prefix))
    df = QUERIES[name](spark, SF)
    assert dict(df.dtypes).items() >= CONTRACT[prefix].items()
    table = "pages" if prefix == "op10_" else "documents"
    assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


MORE = {
    "op11_": {"part": "string", "filter_order": "string", "step": "int", "kept": "bigint", "removed": "bigint", "redundant": "bigint",
              "unique_fails": "bigint", "good_lost": "bigint", "toxic_lost": "bigint", "shapley": "bigint"},
    "op12_": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint", "n_leaves": "bigint",
              "saved_tokens": "bigint", "ends_sha256": "string"},
    "op13_": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
}


@pytest.mark.parametrize("prefix", sorted(MORE))
def test_contract_columns_of_the_others(spark, prefix):
    df = QUERIES[next(n for n in QUERIES if n.startswith(prefix))](spark, SF)
    assert dict(df.dtypes).items() >= MORE[prefix].items()


def test_pipeline_stages(spark, make_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n, before = docs.count(), docs
    for name, stage in P.STAGES:
        after = stage(spark, before, SF)
        if name != "mix":
            assert after.columns == docs.columns
        after = after.persist()
        assert 0 < after.count() <= n, name
        n, before = after.count(), after
    assert before.count() == n and before.where(F.col("taken") > 0).count() > 0
    assert sorted(map(tuple, P.run(spark, SF).collect())) == sorted(map(tuple, before.collect()))


def test_pipeline_on_awkward_and_empty_tables(spark, messy, make_docs):
    for docs in (messy, make_docs([])):
        for name, stage in P.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= docs.count()
            docs = out if name != "mix" else docs


def test_near_dups_stage_takes_copies_from_four_fifths_on(spark, make_docs):
    rows = []
    for k in (8, 9, 10, 11, 12):  # 104 words, 100 shingles: the last k words differ, similarity (100 - k) / (100 + k)
        words = [f"w{k}n{i}" for i in range(104)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:-k] + [f"x{w}" for w in words[-k:]]))]
    docs = make_docs(rows)
    kept = {r.doc_id for r in P.near_dups(spark, docs, SF).collect()}
    assert kept == {16, 18, 20, 22, 24, 25}  # 0.85, 0.83, 0.82, 0.80 go; 0.79 stays
    assert {r.doc_id for r in near_dup.near_duplicates(docs).collect() if not r.kept} == {17}  # operator 7: 0.85
