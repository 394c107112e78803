"""Counted rows: a mergeable state for distinct rows and maxima over a table that changes.

``SELECT DISTINCT`` and ``max`` cannot be kept up to date from new rows alone, because a changed row takes its old values
away.  A counted state keeps every distinct row with the number of table rows behind it.  Counts add and subtract, so a
batch of changes is a small signed frame, batches may come in any order, and a row whose count falls to zero is gone.

Layout: parquet partitioned by ``_bucket``, a hash of the group columns, so all rows of a group lie in one
bucket.  A batch rewrites the buckets that it touches and no others.

Replays: every row remembers the last batch that changed it and its count before that.  A batch that is applied again starts
from that count, bucket by bucket, so it counts once however often it is repeated (only the last batch can be).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.stored import path_exists, read_stored, remember_schema

COUNT, BEFORE, LAST, KEY, BUCKET, DELTA = "_n", "_n_before", "_last", "_key", "_bucket", "_delta"


def bucket_of(group: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*[F.col(c) for c in group]), F.lit(buckets)).cast("int")


def signed_counts(rows: DataFrame, sign: str, columns: Sequence[str]) -> DataFrame:
    """``columns`` and ``_delta``: how often each distinct row came, less how often it went."""
    return rows.groupBy(*columns).agg(F.sum(sign).alias(DELTA)).where(F.col(DELTA) != 0)


def apply(spark: SparkSession, path: str, delta: DataFrame, group: Sequence[str], batch_id, buckets: int) -> list[int]:
    """Add a batch's signed counts; returns the touched buckets (at most ``buckets``)."""
    columns = [c for c in delta.columns if c != DELTA]
    key = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    new = delta.withColumns({KEY: key, BUCKET: bucket_of(group, buckets)})
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())
    if not touched:
        return []
    batch = F.lit(str(batch_id))
    if not path_exists(spark, f"{path}/_schema.json"):
        out = new.select(*columns, KEY, F.col(DELTA).alias(COUNT), F.lit(0).cast("long").alias(BEFORE), batch.alias(LAST), BUCKET)
    else:
        old = read_stored(spark, path).where(F.col(BUCKET).isin(touched)).select(KEY, BUCKET, COUNT, BEFORE, LAST, F.struct(*columns).alias("old"))
        both = old.join(new.select(KEY, BUCKET, DELTA, F.struct(*columns).alias("new")), [KEY, BUCKET], "full_outer")
        base = F.when(F.col(LAST) == batch, F.col(BEFORE)).otherwise(F.coalesce(COUNT, F.lit(0)))
        hit = F.col(DELTA).isNotNull()
        out = both.select(
            *[F.coalesce(F.col("new")[c], F.col("old")[c]).alias(c) for c in columns], KEY,
            F.when(hit, base + F.col(DELTA)).otherwise(F.col(COUNT)).alias(COUNT), F.when(hit, base).otherwise(F.col(BEFORE)).alias(BEFORE),
            F.when(hit, batch).otherwise(F.col(LAST)).alias(LAST), BUCKET).where((F.col(COUNT) != 0) | (F.col(LAST) == batch))
    remember_schema(spark, path, out.schema)
    (out.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path))
    return touched


def live(spark: SparkSession, path: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """Distinct rows that the table holds now, with their counts; whole, or of some buckets."""
    rows = read_stored(spark, path)
    if buckets is not None:
        rows = rows.where(F.col(BUCKET).isin(list(buckets)))
    return rows.where(F.col(COUNT) > 0).drop(KEY, BEFORE, LAST)
