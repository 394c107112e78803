"""Gold kept up to date from changes alone (K8, D9, M1, M5-M9): no full scan of the wide table, no full rebuild of a mart.

``run_gold_incremental`` does three things, each a stream with a checkpoint of its own:

1. *New transactions.*  As ``run_gold``: the accepted rows that gold has not seen are enriched and put into the wide table.
2. *Changed dimensions.*  The change feeds of silver merchants and users name the keys that changed.  Those keys are joined to the
   wide table's key column to find the partitions that hold them; only these are read, only the rows of changed
   keys get the current attributes, and only their partitions are rewritten.  A dimension row that arrives after its
   transactions therefore reaches them.
3. *Marts.*  The wide table keeps a change feed (steps 1 and 2 both write into it).  Each change is taken back with its old values
   and added with its new ones: the fact mart takes changed rows by key, the dimension marts keep counted states
   (``operators/counted.py``), and only the buckets that a batch touched are computed anew.

Marts are read with ``mart(spark, layout, name)``.  Results equal a rebuild from all rows, whatever the order and number of
runs.  Silver must run with ``changes=("merchants", "users")``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import changes as C
from strata.operators import counted as N
from strata.operators import upsert as U
from strata.plans import gold as G
from strata.plans.jobs import accepted_path, silver_current, transaction_part, wide_path
from strata.session import side_by_side
from strata.sources.stored import delete_path, path_exists, read_stored, remember_schema, staged, stored_schema
from strata.streaming.ingest import DEFAULT_MAX_FILES_PER_TRIGGER, Layout

#: What each silver dimension gives the wide table.
DIMENSIONS = {"merchants": ("merchant_id", G.MERCHANT_ATTRIBUTES), "users": ("user_id", G.PERSON_ATTRIBUTES)}


@dataclass(frozen=True)
class CountedMart:
    """A mart over distinct rows: the rows, the columns that one bucket keeps together, and the mart of a bucket's rows."""
    rows: Callable[..., DataFrame]
    group: tuple[str, ...]
    build: Callable[[DataFrame], DataFrame] = lambda live: live.drop(N.COUNT)


def _users(live: DataFrame) -> DataFrame:
    per_channel = live.groupBy("user_id", "channel").agg(F.sum(N.COUNT).alias("n"), *[F.max(c).alias(c) for c in G.USER_ATTRIBUTES])
    return G.users_from_channels(per_channel)


COUNTED = {
    "dim_merchant": CountedMart(G.merchant_rows, ("merchant_id",)),
    "dim_user": CountedMart(G.user_rows, ("user_id",), _users),
    "dim_channel": CountedMart(G.channel_rows, ("channel_id",)),
    "dim_date": CountedMart(G.date_rows, ("date_key",)),
}


@dataclass
class GoldRun:
    """What a run did: rows put into the wide table by each step, changes taken, buckets of states touched."""
    new_rows: int = 0
    refreshed_rows: int = 0
    changes: int = 0
    buckets: dict[str, int] = field(default_factory=dict)


def state_path(layout: Layout, name: str) -> str:
    return layout.table("gold", f"state_{name}")


def mart_path(layout: Layout, name: str) -> str:
    return layout.table("gold", f"live_{name}")


def mart(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    if name == "fact_transactions":
        return U.read_keyed(spark, mart_path(layout, name)).select(*G.FACT_COLUMNS)
    return read_stored(spark, mart_path(layout, name)).drop(N.BUCKET)


# -- wide table -----------------------------------------------------------------------------------


def put_new(spark: SparkSession, layout: Layout, batch: DataFrame, batch_id: int, buckets: int) -> int:
    """Enrich a batch of accepted rows with the current dimensions and put them into the wide table."""
    rows = G.enrich(batch, silver_current(spark, layout, "merchants"), silver_current(spark, layout, "users"), keep=("_seq",))
    with staged(rows, "enriched", n=F.count(F.lit(1))) as (rows, n):
        U.keep_one(spark, wide_path(layout), rows, ["transaction_id"], F.col("_seq"), buckets=buckets, hold=False,
                   part=transaction_part(spark), batch_id=f"new-{batch_id}", changes=True)
        return int(n["n"])


def holding(spark: SparkSession, wide: str, keys: DataFrame, key: str) -> list[tuple[str, int]] | DataFrame:
    """Partitions of the wide table with a row of one of ``keys``; reads the key column alone."""
    return U.touched(U.read_keyed(spark, wide).select(key, U.PART, U.BUCKET).join(keys, key, "left_semi"))


def refresh_dimension(spark: SparkSession, wide: str, changed: DataFrame, key: str, dimension: DataFrame,
                      attributes: dict[str, str], batch_id, buckets: int = U.DEFAULT_BUCKETS, part: str | None = None) -> int:
    """Give the wide rows of ``changed`` keys the dimension's current attributes; returns the number of rows that differ."""
    keys = changed.select(key).where(F.col(key).isNotNull()).distinct().persist(StorageLevel.MEMORY_AND_DISK)
    try:
        pairs = holding(spark, wide, keys, key)
        if isinstance(pairs, list) and not pairs:
            return 0
        stored = U.read_keyed(spark, wide, pairs).join(keys, key, "left_semi")
        now = dimension.join(keys, key, "left_semi").select(key, *[F.col(src).alias(f"_new_{name}") for name, src in attributes.items()])
        differs = F.lit(False)
        for name in attributes:
            differs = differs | ~F.col(name).eqNullSafe(F.col(f"_new_{name}"))
        # a hot key's rows meet one dimension row: AQE splits the larger side
        rows = stored.join(now, key, "left").where(differs).withColumns({n: F.col(f"_new_{n}") for n in attributes})
        rows = rows.withColumns({"risk_score": G.risk_score(F.col("risk_level"), F.col("status"), F.col("is_reverse")),
                                 **G.processed_columns()}).select(*[c for c in stored.columns if c not in (U.PART, U.BUCKET, C.HASH)])
        # read several times while the table that it comes from is rewritten
        with staged(rows, "refresh", n=F.count(F.lit(1))) as (rows, n):
            if n["n"] or C.recorded(spark, wide, batch_id):
                U.upsert(spark, wide, rows, ["transaction_id"], buckets=buckets, hold=False, part=part, batch_id=batch_id, changes=True)
            return int(n["n"])
    finally:
        keys.unpersist()


# -- marts ----------------------------------------------------------------------------------------


def _rebuild(spark: SparkSession, layout: Layout, name: str, m: CountedMart, touched: Sequence[int], buckets: int) -> None:
    """Compute the touched buckets of a mart from its state; a bucket that has no row left goes."""
    path, live = mart_path(layout, name), N.live(spark, state_path(layout, name), touched)
    rows = m.build(live.drop(N.BUCKET)).withColumn(N.BUCKET, N.bucket_of(m.group, buckets))
    remember_schema(spark, path, rows.schema)
    (rows.hint("rebalance", N.BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(N.BUCKET).parquet(path))
    filled = {r[0] for r in live.select(N.BUCKET).distinct().collect()}  # at most the number of buckets
    for b in set(touched) - filled:
        delete_path(spark, f"{path}/{N.BUCKET}={b}")


def apply_changes(spark: SparkSession, layout: Layout, changes: DataFrame, batch_id, buckets: int, run: GoldRun | None = None) -> None:
    """Bring all marts up to date with a batch of the wide table's changes."""
    run = run or GoldRun()
    sign = F.when(F.col(C.CHANGE).isin(C.INSERT, C.AFTER), F.lit(1)).otherwise(F.lit(-1))
    rows = changes.withColumn("_sign", sign)  # stored files: each mart reads the columns it needs
    run.changes += rows.count()

    def fact() -> None:
        U.keep_one(spark, mart_path(layout, "fact_transactions"), G.fact_transactions(rows.where("_sign > 0"), C.VERSION),
                   ["transaction_id"], F.struct(C.VERSION), buckets=buckets, hold=False, part=transaction_part(spark), batch_id=batch_id)

    def counted(name: str, m: CountedMart) -> None:
        columns = m.rows(rows).columns
        delta = N.signed_counts(m.rows(rows, "_sign"), "_sign", columns).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = N.apply(spark, state_path(layout, name), delta, m.group, batch_id, buckets)
        finally:
            delta.unpersist()
        run.buckets[name] = run.buckets.get(name, 0) + len(touched)
        if touched:
            _rebuild(spark, layout, name, m, touched, buckets)

    side_by_side([fact, *[lambda name=name, m=m: counted(name, m) for name, m in COUNTED.items()]], 5)


# -- the job --------------------------------------------------------------------------------------


def _drain(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    (stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .start().awaitTermination())


def run_gold_incremental(spark: SparkSession, layout: Layout, buckets: int | None = None,
                         max_files_per_trigger: int | None = None) -> GoldRun:
    buckets = buckets or U.default_buckets(spark)
    limit = max_files_per_trigger or DEFAULT_MAX_FILES_PER_TRIGGER
    run, wide, feed = GoldRun(), wide_path(layout), accepted_path(layout)

    def new(batch: DataFrame, batch_id: int) -> None:
        run.new_rows += put_new(spark, layout, batch, batch_id, buckets)

    if path_exists(spark, feed):
        _drain(spark.readStream.schema(stored_schema(spark, feed)).option("maxFilesPerTrigger", str(limit)).parquet(feed),
               layout.checkpoint("gold_incremental_new"), new)
    if not path_exists(spark, wide):
        return run
    for name, (key, attributes) in DIMENSIONS.items():
        target = layout.table("silver", name)
        if not path_exists(spark, f"{C.feed_path(target)}/_schema.json"):
            continue

        def refresh(batch: DataFrame, batch_id: int, name=name, key=key, attributes=attributes) -> None:
            run.refreshed_rows += refresh_dimension(spark, wide, batch, key, silver_current(spark, layout, name), attributes,
                                                    f"{name}-{batch_id}", buckets, transaction_part(spark))

        _drain(C.stream_changes(spark, target, limit), layout.checkpoint(f"gold_incremental_{name}"), refresh)
    _drain(C.stream_changes(spark, wide, limit), layout.checkpoint("gold_incremental_marts"),
           lambda batch, batch_id: apply_changes(spark, layout, batch, batch_id, buckets, run))
    return run
