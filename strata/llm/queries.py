"""Catalogue entries opN_<name> of the corpus operators and their DuckDB restatements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, filter_audit, langid, licenses, line_templates, mixing, near_dup, prefix_trie, quality_rank, quality_rules, simhash, site_style, toxicity
from strata.llm.common import crc_mod, read


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality_rules.ledger(read(spark, sf_dir, "documents"))
    base = quality_rules.verdict("base")
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~base).alias("base_failed"),
        "failure_bits", (base & quality_rules.verdict()).alias("kept"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


def _held_out(docs: DataFrame, mod: int, fold: int):
    return F.coalesce(crc_mod("doc_id", mod) == fold, F.lit(False)).alias("held_out")


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.dedup(read(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs, langid.training_rows()))
    return found.select("doc_id", _held_out(found, 3, 1), "lang_pred", "score", "cross_entropy", "rejected")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read(spark, sf_dir, "documents")).drop("text_key")


def op8_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = quality_rank.score(docs, quality_rank.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", _held_out(scored, 4, 2), "score", "predicted")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", _held_out(scored, 5, 0), "score", "predicted", "n_restored")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.main_text(read(spark, sf_dir, "pages"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))


def op13_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_source_mixing": op2_source_mixing,
    "op3_quality_rules": op3_quality_rules,
    "op4_license_scan": op4_license_scan,
    "op5_line_templates": op5_line_templates,
    "op6_language_id": op6_language_id,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_quality_rank": op8_quality_rank,
    "op9_toxicity": op9_toxicity,
    "op10_main_text": op10_main_text,
    "op11_filter_audit": op11_filter_audit,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_simhash_bktree": op13_simhash_bktree,
}

ORACLES: dict[str, str] = {
    "op1_decontaminate": decontaminate.oracle(),
    "op2_source_mixing": mixing.oracle(),
    "op3_quality_rules": quality_rules.oracle(),
    "op5_line_templates": line_templates.oracle(),
    "op11_filter_audit": filter_audit.oracle(),
    "op12_prefix_trie": prefix_trie.oracle(),
}
