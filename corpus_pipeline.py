"""Corpus pipeline: documents to a mixed, deduplicated, decontaminated training set.

Stages, each reading what the one before wrote:

1. ``quality``     documents that the pairwise-ranking quality model rejects go (learned from ``labels``);
2. ``lines``       recurring line templates go but in the first document, and documents left without a word;
3. ``near_dups``   one document of each near-duplicate group stays (its smallest id; similarity from ``NEAR_PERCENT``);
4. ``benchmark``   documents that hold a benchmark item go;
5. ``mix``         one row per document left: the words that the mixture takes of it.

All but the last return the columns they were given.  Rows with a NULL id pass stages 3 to 5; rows
that repeat an id and text are one document to stage 3, which keeps one of them.  Empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, line_templates, mixing, near_dup, quality_rank
from strata.llm.common import cut, cut_mark, drop_cuts, read
from strata.session import tune


#: Similarity of five-word shingles from which the stage takes two documents for near copies.  Operator 7's own
#: contract starts at 85.
NEAR_PERCENT = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return quality_rank.keep_good(docs, quality_rank.fit(docs, read(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return line_templates.clean(docs)


def near_dups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return near_dup.keep_first(docs, percent=NEAR_PERCENT)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return mixing.mix(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_dups", near_dups), ("benchmark", benchmark), ("mix", mix)]

#: The first stage is a trained model, which SQL cannot restate.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read back for the next.

    A stage's intermediate tables, and the result it read, are deleted once its own result is written.
    """
    tune(spark)
    docs, mark = read(spark, sf_dir, "documents"), cut_mark()
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop_cuts(spark, mark, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
