"""Column profiles from mergeable sketches (Q6, approximate aggregates).

A batch is summarised once: rows and NULLs exactly, least and greatest value as text, distinct values by a HyperLogLog sketch,
quantiles by a KLL sketch of the numeric value, and the most frequent values by counts of the batch's heavy values.  All
but the quantiles are taken from the batch's distinct values, which are counted once.  The summary is one row a column, a few kB, stored under the batch's id; profiles over any set of batches merge summaries and
read no data.  Merging is associative and commutative, and a repeated batch replaces its own summary.

Errors: distinct counts have a relative standard error of about ``1.04 / sqrt(2^LG_K)`` (1.6 % at ``LG_K`` = 12); ranks
of quantiles are off by about 1.65 % at ``KLL_K`` = 200, with 99 % confidence.  Top values are exact for every value with more
than ``rows / TOP_CAPACITY`` rows of each batch that holds it, since such a value cannot drop out of a batch's counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.stored import path_exists

LG_K, KLL_K, TOP_CAPACITY = 12, 200, 1000
QUANTILES = (0.25, 0.5, 0.75, 0.95)


def cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, value`` (as text): one row per cell that is not NULL."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("cell")).select("cell.*").where(F.col("value").isNotNull())


#: What a text that is a number can begin with; others are not parsed (a failed parse costs an exception).
_NUMERIC = r"^[\x00-\x20]*[-+]?([0-9.]|(?i:inf|nan))"


def counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``cells``, each value once with its rows ``n``.

    Values are summed before the shuffle, numbers as numbers: a text is made of a value and not of a row.
    """
    def one(c: str) -> DataFrame:
        kind, value = df.schema[c].dataType, F.col(c)
        if isinstance(kind, (T.FloatType, T.DoubleType)):  # grouping takes -0.0 for 0.0, their texts differ
            negative = F.when(value == 0, value.cast("string") == "-0.0").otherwise(F.lit(False))
            parts, text = [value.alias("v"), negative.alias("z")], F.when(F.col("z"), F.lit("-0.0")).otherwise(F.col("v").cast("string"))
        elif isinstance(kind, T.IntegralType):
            parts, text = [value.alias("v")], F.col("v").cast("string")
        else:
            parts, text = [value.cast("string").alias("v")], F.col("v")
        found = df.where(value.isNotNull()).select(*parts)
        return found.groupBy(*found.columns).agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("column"), text.alias("value"), "n")

    return reduce(DataFrame.unionByName, [one(c) for c in columns])


def number_of(df: DataFrame, column: str) -> Column:
    """The value as a number, as its text would be read; NULL if it is none."""
    if isinstance(df.schema[column].dataType, (T.IntegralType, T.DoubleType, T.DecimalType)):
        return F.col(column).cast("double")  # the number nearest to the text too
    text = F.col(column).cast("string")
    return F.when(text.rlike(_NUMERIC), text.try_cast("double"))


def summarise(df: DataFrame, columns: Sequence[str], capacity: int = TOP_CAPACITY) -> DataFrame:
    """One summary row per column."""
    def one(c: str):  # every column's aggregates in one pass over the rows
        return F.struct(F.lit(c).alias("column"), F.count(F.lit(1)).alias("rows"),
                        F.kll_sketch_agg_double(number_of(df, c), F.lit(KLL_K)).alias("quantile_sketch"))

    sketches = df.agg(F.array(*[one(c) for c in columns]).alias("all")).select(F.inline("all"))
    counted = counts(df, columns)
    values = counted.groupBy("column").agg(
        F.sum("n").alias("filled"), F.min("value").alias("least"), F.max("value").alias("greatest"),
        F.hll_sketch_agg("value", F.lit(LG_K)).alias("distinct_sketch"))
    # a column of NULLs has no value: its sketch is that of nothing
    none = F.hll_sketch_agg(F.lit(None).cast("string"), F.lit(LG_K))
    ranked = counted.withColumn("rank", F.row_number().over(Window.partitionBy("column").orderBy(F.col("n").desc(), "value")))
    top = ranked.where(F.col("rank") <= capacity).groupBy("column").agg(F.map_from_entries(F.collect_list(F.struct("value", "n"))).alias("top"))
    out = sketches.join(values, "column", "left").join(top, "column", "left").crossJoin(df.agg(none.alias("none")))
    return out.select("column", "rows", (F.col("rows") - F.coalesce("filled", F.lit(0))).alias("nulls"), "least", "greatest",
                      F.coalesce("distinct_sketch", "none").alias("distinct_sketch"), "quantile_sketch", "top")


def store(spark: SparkSession, path: str, df: DataFrame, columns: Sequence[str], batch_id) -> None:
    """Summarise a batch and put it under its id (a replay replaces it)."""
    summarise(df, columns).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def merged(spark: SparkSession, path: str) -> DataFrame:
    """The stored summaries of all batches as one summary per column."""
    parts = spark.read.parquet(path)
    whole = parts.groupBy("column").agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.kll_merge_agg_double("quantile_sketch", KLL_K).alias("quantile_sketch"))
    top = (parts.select("column", F.explode_outer("top").alias("value", "n")).where(F.col("value").isNotNull())
           .groupBy("column", "value").agg(F.sum("n").alias("n")))
    best = top.groupBy("column").agg(F.max_by("value", F.struct("n", "value")).alias("top_value"), F.max("n").alias("top_count"))
    return whole.join(best, "column", "left")


def read_profile(spark: SparkSession, path: str) -> DataFrame | None:
    """``column, rows, nulls, least, greatest, approx_distinct, p25, p50, p75, p95, top_value, top_count``."""
    if not path_exists(spark, path):
        return None
    m = merged(spark, path)
    numbers = F.kll_sketch_get_n_double("quantile_sketch") > 0
    quantiles = {f"p{int(q * 100)}": F.when(numbers, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(q))) for q in QUANTILES}
    return m.withColumns({"approx_distinct": F.hll_sketch_estimate("distinct_sketch"), **quantiles}).drop("distinct_sketch", "quantile_sketch")
