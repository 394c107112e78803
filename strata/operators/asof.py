"""As-of join: every fact with the version of its key that was valid at the fact's time (K15 with J1).

A range join (``valid_from <= at < valid_to``) would meet every version of a key with every fact of it, and an
equi-join on the key puts a hot key into one task.  Here facts and versions are laid in one order of (key, time), range-partitioned,
so a key with a third of all rows spans many tasks of like size.  Inside a range the last version is carried forward by a
window; what a range's first key had before the range begins comes from a frame of at most two rows a range.  No pair
of fact and version is built.

A version holds from ``valid_from`` until the next version of its key.  Versions at the same time: the greatest ``seq`` holds.  A
version with ``deleted`` true says that the key had no value from then on.  Facts with a NULL key or time, or before the first
version, have none; with ``how="inner"`` they go.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import fresh_dir


def as_of_join(facts: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, valid_from: str, columns: Sequence[str],
               seq: Column | None = None, deleted: Column | None = None, how: str = "left", prefix: str = "",
               partitions: int | None = None, scratch: str | None = None) -> DataFrame:
    """All columns of ``facts`` and, as ``prefix + name``, the ``columns`` of the valid version.

    Rows are written once to ``scratch`` (default: a fresh folder under the shared work root; delete it when
    the result is stored), so that every later read sees the same ranges.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how}")
    spark = facts.sparkSession
    n = partitions or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    scratch = scratch or fresh_dir(spark, "as-of")
    key, none = [f"_k{i}" for i in range(len(keys))], F.lit(None)
    version = F.struct(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(columns)],
                       F.coalesce(deleted, F.lit(False)).alias("gone") if deleted is not None else F.lit(False).alias("gone"))
    fact = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    seq = seq if seq is not None else F.lit(0)
    present = F.lit(True)
    for c in (*keys, valid_from):
        present = present & F.col(c).isNotNull()
    right = versions.where(present).select(
        *[F.col(k).alias(a) for k, a in zip(keys, key)], F.col(valid_from).alias("_at"), F.lit(0).alias("_side"), F.struct(seq.alias("s")).alias("_seq"),
        F.lit(0).cast("long").alias("_spread"), version.alias("_version"))
    left = facts.select(
        *[F.col(k).alias(a) for k, a in zip(keys, key)], F.col(at).alias("_at"), F.lit(1).alias("_side"),
        F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]).alias("_spread"), fact.alias("_fact"))
    order = [*key, "_at", "_side", "_seq", "_spread"]
    laid = right.unionByName(left, allowMissingColumns=True).repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id())
    laid.write.parquet(scratch)
    laid = spark.read.schema(laid.schema).parquet(scratch)

    same_key = F.struct(*key)
    so_far = Window.partitionBy("_pid", *key).orderBy("_at", "_side", "_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = laid.withColumn("_here", F.last("_version", ignorenulls=True).over(so_far))
    # the ends of every range: its first key, and its last key with the last version of that key in the range
    place = F.struct("_at", "_side", "_seq")
    last_versions = laid.where("_side = 0").groupBy("_pid", same_key.alias("_key")).agg(F.max_by("_version", place).alias("_version"))
    ends = laid.groupBy("_pid").agg(F.min(same_key).alias("_first"), F.max(same_key).alias("_last"))
    tails = ends.select("_pid", F.col("_last").alias("_key")).join(last_versions, ["_pid", "_key"], "left").select("_pid", "_key", F.lit(1).alias("_end"), "_version")
    heads = ends.select("_pid", F.col("_first").alias("_key"), F.lit(0).alias("_end"), none.cast(laid.schema["_version"].dataType).alias("_version"))
    before = Window.partitionBy("_key").orderBy("_pid", "_end").rowsBetween(Window.unboundedPreceding, -1)
    carried = (tails.unionByName(heads).withColumn("_carried", F.last("_version", ignorenulls=True).over(before))
               .where("_end = 0").select("_pid", F.col("_key").alias("_first"), "_carried"))
    met = here.where("_side = 1").join(F.broadcast(carried), "_pid", "left")  # one row a range
    valid = F.coalesce("_here", F.when(F.col("_first").eqNullSafe(same_key), F.col("_carried")))
    out = met.withColumn("_v", valid)
    known = F.coalesce(~F.col("_v")["gone"], F.lit(False)) & F.col("_at").isNotNull()
    if how == "inner":
        out = out.where(known)
    return out.select("_fact.*", *[F.when(known, F.col("_v")[f"v{i}"]).alias(f"{prefix}{c}") for i, c in enumerate(columns)])
