"""Keyed tables on plain parquet: upsert (K3), SCD type 1 (K4), SCD type 2 (K15), one row per key (T4).

Layout: a parquet folder partitioned by ``_part`` and ``_bucket``.  ``_part`` is an immutable piece of the
key (the day inside a transaction id, say; ``all`` if the key has none), ``_bucket`` a hash of the key
inside it.  Keys, bucket count and part expression are stored with the table in ``_keyed.json`` and win
over what a caller passes, so a changed session setting cannot split a key's home in two.

A batch rewrites the partitions it touches and no others: it finds them, reads them (pruned by a list of up
to ``LISTED`` partitions, joined on the stored partition columns beyond that), merges, and writes them back with
dynamic partition overwrite.  With a day in the key a one-day batch rewrites one day.  Stored rows cross one exchange,
by ranges of (part, bucket, key hash): it brings the rows of a key together and lays them out for the write.  In a table
that keeps changes only those cross it that a bitmap of the batch's key hashes does not rule out (``apart``); the others
are written back from the scan.

A stream of many small batches would rewrite the same partitions once a batch.  With ``defer=True`` a batch of a
newest-wins table is laid beside it, in ``<target>_pending``, one folder per batch id; ``settle`` merges all of them in one
pass.  Until then readers merge what is pending, and a run that died leaves nothing unread.

With ``changes=True`` (stored with the table) every batch leaves its row-level differences in
``<target>_changes`` before the table is written (K19, ``operators/changes.py``).

Rows whose key or sequence holds a NULL have no home.  They are kept beside the table in
``<target>_unkeyed`` (``unkeyed()`` reads them), one folder per batch id, so a replay replaces its own.

Limits: the commit is not atomic across partitions.  If a job dies inside its commit, partitions that
were deleted but not yet replaced have lost the rows that the batch did not bring; replay from the layer
below, or use a table format with atomic commits.  Deletes are stored as tombstones.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import changes as C
from strata.operators.dedup import latest_by
from strata.session import fresh_dir
from strata.sources.stored import delete_path, path_exists, read_stored, read_text, remember_schema, write_text

PART, BUCKET, SEQ, OP = "_part", "_bucket", "_seq", "_op"
SPREAD, FRESH, KEPT = "_spread", "_fresh", "_kept"
MARK, GROUP, MARKED = "_mark", "_group", "_marked"
DELETE = "DELETE"
META_FILE = "_keyed.json"
#: Buckets inside one part of a new table; size them to part bytes / ~1 GB.
DEFAULT_BUCKETS = 64
#: Touched partitions that are listed on the driver to prune a read (two short values each).
LISTED = 10_000
#: Bits of the bitmap by which stored rows are told from a batch's (32 MB), wanted a key, and in one of its rows.
MARKS, MARKS_A_KEY, _GROUP = 1 << 28, 16, 1 << 15
#: Rows a file gets on average if a batch of a new table is written as it lies, without an exchange for the write.
FILE_ROWS = 20_000
BUCKETS_CONF = "strata.keyed.buckets"


class KeyedTableError(ValueError):
    """A batch does not fit the stored table's keys."""


@dataclass(frozen=True)
class Home:
    """Where a key lives: fixed when the table is created."""

    keys: list[str]
    buckets: int
    part: str | None = None  # SQL over the key columns
    changes: bool = False    # keeps a change feed


def default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get(BUCKETS_CONF, str(DEFAULT_BUCKETS)))


def stored_home(spark: SparkSession, target: str) -> Home | None:
    text = read_text(spark, f"{target}/{META_FILE}")
    return Home(**json.loads(text)) if text else None


def home_of(spark: SparkSession, target: str, keys: Sequence[str], buckets: int, part: str | None, changes: bool = False) -> Home:
    """The stored layout, or the given one, stored now.  A table begins to keep changes when it is first asked to."""
    home = stored_home(spark, target)
    if home is not None and home.keys != list(keys):
        raise KeyedTableError(f"{target} is keyed by {home.keys}, not by {list(keys)}")
    if home is None or changes and not home.changes:
        home = replace(home, changes=True) if home else Home(list(keys), int(buckets), part, changes)
        write_text(spark, f"{target}/{META_FILE}", json.dumps(asdict(home)))
    return home


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def housed(df: DataFrame, home: Home) -> DataFrame:
    part = F.coalesce(F.nullif(F.expr(home.part).cast("string"), F.lit("")), F.lit("none")) if home.part else F.lit("all")
    return df.withColumns({PART: part, BUCKET: bucket_of(home.keys, home.buckets)})


def _whole(df: DataFrame, columns: Sequence[str]) -> Column:
    """No column, and no field of a struct column, is NULL (a struct itself never is)."""
    ok = F.lit(True)
    for c in columns:
        kind = df.schema[c].dataType
        ok = ok & F.col(c).isNotNull()
        for f in kind.fields if isinstance(kind, T.StructType) else []:
            ok = ok & F.col(c)[f.name].isNotNull()
    return ok


def _set_aside(df: DataFrame, target: str, batch_id) -> None:
    (df.withColumn("_batch", F.lit(str(batch_id))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(f"{target}_unkeyed"))


def unkeyed(spark: SparkSession, target: str) -> DataFrame | None:
    """Rows that a keyed table could not take; None if there never were any."""
    return spark.read.parquet(f"{target}_unkeyed") if path_exists(spark, f"{target}_unkeyed") else None


def _write_parts(spark: SparkSession, df: DataFrame, path: str, dealt: bool = False) -> None:
    """Few files per partition; ``rebalance`` (not ``repartition``) lets AQE split an oversized one,
    e.g. a hot key's SCD2 history, over several tasks.  Rows ``dealt`` by ``together`` already lie so."""
    remember_schema(spark, path, df.schema)
    ((df if dealt else df.hint("rebalance", PART, BUCKET)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(PART, BUCKET).parquet(path))


def together(current: DataFrame | None, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored and incoming rows (``_fresh``), all rows of a key in one task and each part in neighbouring ones."""
    both = incoming.withColumn(FRESH, F.lit(True))
    if current is not None:
        both = current.withColumn(FRESH, F.lit(False)).unionByName(both, allowMissingColumns=True)
    return both.withColumn(SPREAD, F.xxhash64(*keys)).repartitionByRange(PART, BUCKET, SPREAD)


def _per_key(keys: Sequence[str]) -> Window:
    """Windows over ``together`` rows that need no further exchange: part, bucket and spread follow from the key."""
    return Window.partitionBy(PART, BUCKET, SPREAD, *keys)


def _newest(both: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    return latest_by(both, [PART, BUCKET, SPREAD, *keys], [order], null_keys=False).drop(FRESH, SPREAD)


@contextmanager
def held(df: DataFrame, hold: bool = True):
    """Persist a batch that is read twice (partition list, then merge); release it afterwards.

    ``hold=False`` when the batch's input is stored already (staged files, a change feed).
    """
    if not hold:
        yield df
        return
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def apart(current: DataFrame, incoming: DataFrame, keys: Sequence[str], n_keys: int) -> tuple[DataFrame | None, DataFrame]:
    """Stored rows split into those whose key the batch does not hold, and the others.

    The batch's key hashes are marks in a bitmap of bounded size that travels to the stored rows.  A mark may be another
    key's, so a few of the others are not the batch's either; a row without one never is.  A batch too large for the bitmap
    leaves all rows to the others.
    """
    bits = max(_GROUP, 1 << (MARKS_A_KEY * n_keys - 1).bit_length())
    if bits > MARKS:
        if 2 * n_keys > MARKS:
            return None, current
        bits = MARKS
    mark = F.pmod(F.xxhash64(*keys), F.lit(bits))
    place = {MARK: mark, GROUP: F.floor(mark / _GROUP)}
    marks = incoming.withColumns(place).groupBy(GROUP).agg(F.bitmap_construct_agg(F.col(MARK) % _GROUP).alias(MARKED))
    byte = F.substring(F.col(MARKED), (F.col(MARK) % _GROUP / 8).cast("int") + 1, F.lit(1))
    asked = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col(MARK) % 8).cast("int")) == 1
    found = current.withColumns(place).join(F.broadcast(marks), GROUP, "left").withColumn(
        MARKED, F.coalesce(asked, F.lit(False)))  # at most MARKS bits
    return found.where(~F.col(MARKED)).drop(*place, MARKED), found.where(MARKED).drop(*place, MARKED)


def touched(batch: DataFrame) -> list[tuple[str, int]] | DataFrame:
    """Distinct (part, bucket) pairs of a batch: a list, or the frame itself if there are more than ``LISTED``."""
    pairs = batch.select(PART, BUCKET).distinct()
    listed = pairs.limit(LISTED + 1).collect()
    return sorted((r[0], r[1]) for r in listed) if len(listed) <= LISTED else pairs


def read_keyed(spark: SparkSession, path: str, pairs: list[tuple[str, int]] | DataFrame | None = None) -> DataFrame:
    """The table, or the given partitions of it (a list prunes by part and bucket, then exactly; a frame is joined)."""
    df = read_stored(spark, path)
    if pairs is None:
        late = pending(spark, path)
        if late is not None:  # a run died before it settled
            keys = stored_home(spark, path).keys
            df = latest_by(df.unionByName(late, allowMissingColumns=True), keys, [F.col(SEQ).desc()])
        return df
    if isinstance(pairs, DataFrame):
        return df.join(pairs, [PART, BUCKET], "left_semi")
    parts, buckets = sorted({p for p, _ in pairs}), sorted({b for _, b in pairs})
    df = df.where(F.col(PART).isin(parts) & F.col(BUCKET).isin(buckets))
    if len(set(pairs)) == len(parts) * len(buckets):
        return df  # every part with every bucket: the filters are exact
    exact = spark.createDataFrame(pairs, f"{PART} string, {BUCKET} int")
    return df.join(F.broadcast(exact), [PART, BUCKET], "left_semi")  # at most LISTED short rows


def _exists(spark: SparkSession, target: str) -> bool:
    return stored_home(spark, target) is not None and path_exists(spark, f"{target}/_schema.json")


def pending(spark: SparkSession, target: str) -> DataFrame | None:
    """Rows of deferred batches; None if there are none."""
    path = f"{target}_pending"
    return read_stored(spark, path).drop("_batch") if path_exists(spark, path) else None


def _defer(spark: SparkSession, target: str, rows: DataFrame, batch_id) -> None:
    out = rows.withColumn("_batch", F.lit(str(batch_id)))
    remember_schema(spark, f"{target}_pending", out.schema)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(f"{target}_pending")


def settle(spark: SparkSession, target: str) -> None:
    """Merge all deferred batches into the table: each touched partition is rewritten once.  Repeating it changes nothing."""
    late = pending(spark, target)
    if late is None:
        return
    keys = stored_home(spark, target).keys
    order = F.col(SEQ).desc()
    n, kinds = late.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*keys))).first()
    if 2 * kinds < n:
        late = latest_by(late, keys, [order], null_keys=False)
    pairs = touched(late)
    if pairs:
        _write_parts(spark, _newest(together(read_keyed(spark, target, pairs), late, keys), keys, order), target, True)
    delete_path(spark, f"{target}_pending")


def _merge(spark: SparkSession, target: str, batch: DataFrame, keys: Sequence[str], required: Sequence[str], combine,
           buckets: int, part: str | None, hold: bool, batch_id, keep_unkeyed: bool = False, changes: bool = False,
           first=None, reduce=None, alone: bool = False, defer: bool = False) -> None:
    """Split off rows without a home, then replace the touched partitions.

    Either by ``combine(current or None, incoming)``, or by the rows ``together`` whose rank ``first`` is 1 (``alone``: a batch is its
    own result where nothing is stored).  ``reduce`` makes a batch with many rows a key smaller before it is merged; ``defer``
    leaves the merge to ``settle``.
    """
    existed = _exists(spark, target)
    home = home_of(spark, target, keys, buckets, part, changes)
    if home.changes and C.finished(spark, target, batch_id):
        return  # a replay: its changes are in the feed and in the table
    defer = defer and existed and not home.changes
    if existed and not defer:
        settle(spark, target)
    if home.changes:
        batch = C.with_hash(batch)
    with held(batch, hold) as batch:
        ok = _whole(batch, required)
        n, n_whole, kinds = batch.agg(F.count(F.lit(1)), F.count_if(ok), F.approx_count_distinct(F.when(ok, F.xxhash64(*keys)))).first()
        homeless = batch.where(~ok)
        if n > n_whole:
            if keep_unkeyed:  # a part of the table that belongs to this batch alone
                _write_parts(spark, homeless.withColumns({PART: F.lit(f"unkeyed-{batch_id}"), BUCKET: F.lit(0)}), target)
            else:
                _set_aside(homeless, target, batch_id)
        incoming = housed(batch.where(ok), home)
        if reduce and 2 * kinds < n_whole:
            incoming = reduce(incoming)
        if defer:
            if n_whole:
                _defer(spark, target, incoming, batch_id)
            return
        pairs = touched(incoming) if existed else None
        current = read_keyed(spark, target, pairs) if pairs else None
        record = home.changes and not C.recorded(spark, target, batch_id)
        if first is None:
            if current is not None or not existed:
                _write_parts(spark, combine(current, incoming), target)
            return
        if current is not None and home.changes:
            current = C.with_hash(current)
        if alone and current is None:  # nothing to merge with
            if record:
                C.record(spark, target, C.difference(None, incoming, keys, hidden=(PART, BUCKET)), batch_id)
            if not existed:
                _write_parts(spark, incoming, target, home.changes and _lies_well(incoming, n_whole))
            if home.changes:
                C.finish(spark, target, batch_id)
            return
        rest = None
        if current is not None and home.changes:
            rest, current = apart(current, incoming, keys, n_whole)
        both = together(current, incoming, keys).withColumn(KEPT, first == 1)
        # read by the feed and by the table
        with held(_with_change(both, keys) if record else both, record) as both:
            if record:
                C.record(spark, target, both.where(F.col(C.CHANGE).isNotNull()).drop(PART, BUCKET, FRESH, SPREAD, KEPT), batch_id)
            if current is not None or not existed:
                merged = both.where(KEPT).drop(FRESH, SPREAD, KEPT, C.CHANGE)
                _write_parts(spark, merged if rest is None else rest.unionByName(merged, allowMissingColumns=True), target, True)
        if home.changes:
            C.finish(spark, target, batch_id)


def _lies_well(rows: DataFrame, n: int) -> bool:
    """Every task's file in every partition would get ``FILE_ROWS`` rows on average."""
    pairs = touched(rows)
    return isinstance(pairs, list) and n >= FILE_ROWS * len(pairs) * rows.rdd.getNumPartitions()


def _with_change(both: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows ``together`` with what the merge makes of them (``_change``, NULL for none): a key's stored row against the kept one.

    Both lie in one task already, so they are told by windows and move no further.
    """
    alive = F.coalesce(F.col(OP), F.lit("UPSERT")) != DELETE if OP in both.columns else F.lit(True)
    state = F.struct(alive.alias("alive"), F.col(C.HASH).alias("hash"))
    ends = both.withColumns({"_was": F.max(F.when(~F.col(FRESH), state)).over(_per_key(keys)),
                             "_is": F.max(F.when(F.col(KEPT), state)).over(_per_key(keys))})
    was, is_ = (F.coalesce(F.col(c)["alive"], F.lit(False)) for c in ("_was", "_is"))
    differs = ~F.col("_was")["hash"].eqNullSafe(F.col("_is")["hash"])
    came, went = F.col(FRESH) & F.col(KEPT), ~F.col(FRESH) & ~F.col(KEPT)
    return ends.withColumn(C.CHANGE, F.when(came & is_ & ~was, F.lit(C.INSERT)).when(came & is_ & was & differs, F.lit(C.AFTER))
                           .when(went & was & is_ & differs, F.lit(C.BEFORE)).when(went & was & ~is_, F.lit(C.DELETED))).drop("_was", "_is")


def upsert(spark: SparkSession, target: str, batch: DataFrame, keys: Sequence[str], buckets: int = DEFAULT_BUCKETS,
           hold: bool = True, part: str | None = None, batch_id="manual", changes: bool = False) -> None:
    """MERGE by key - matched rows are replaced whole, new keys inserted.

    ``batch`` must hold at most one row per key (deduplicate first).  ``changes`` keeps a change feed; batch ids
    must then tell batches apart.
    """
    # a key's incoming rows, or its stored ones if there are none
    first = F.rank().over(_per_key(keys).orderBy(F.col(FRESH).desc()))
    _merge(spark, target, batch, keys, keys, None, buckets, part, hold, batch_id, changes=changes, first=first, alone=True)


def keep_one(spark: SparkSession, target: str, rows: DataFrame, keys: Sequence[str], seq: Column, newest: bool = True,
             buckets: int = DEFAULT_BUCKETS, hold: bool = True, part: str | None = None, batch_id="manual",
             keep_unkeyed: bool = False, changes: bool = False, defer: bool = False) -> None:
    """T4: one row per key over all batches - the newest (or oldest) by ``seq``, whatever order they arrive in.

    ``keep_unkeyed`` leaves rows without a key in the table (all of them) instead of beside it.  ``defer`` lays the batch
    beside the table until ``settle``; only the newest rows can wait so.
    """
    if defer and not newest:
        raise ValueError("only newest-wins batches can be deferred")
    order = F.col(SEQ).desc() if newest else F.col(SEQ).asc()
    _merge(spark, target, rows.withColumn(SEQ, seq), keys, [*keys, SEQ], None, buckets, part, hold, batch_id, keep_unkeyed, changes,
           first=F.row_number().over(_per_key(keys).orderBy(order)),
           reduce=lambda incoming: latest_by(incoming, keys, [order], null_keys=False), defer=defer)


def scd1_apply(spark: SparkSession, target: str, rows: DataFrame, keys: Sequence[str], seq: Column,
               buckets: int = DEFAULT_BUCKETS, hold: bool = True, part: str | None = None, batch_id="manual",
               changes: bool = False, defer: bool = False) -> None:
    """SCD type 1 from a change feed, robust to out-of-order arrival.

    Each stored row keeps its sequence value (``_seq``); a change is applied only if its sequence is
    greater than the stored one, so an older change that arrives late is ignored.  Deletes
    (``_op = 'DELETE'``) are stored as tombstones so a late older upsert cannot resurrect the key;
    readers use :func:`scd1_current`.
    """
    if OP not in rows.columns:
        rows = rows.withColumn(OP, F.lit("UPSERT"))
    keep_one(spark, target, rows, keys, seq, True, buckets, hold, part, batch_id, changes=changes, defer=defer)


def scd1_current(spark: SparkSession, target: str) -> DataFrame:
    """Reader view of an SCD1 table: live rows only, control columns hidden."""
    df = read_keyed(spark, target)
    return df.filter(F.col(OP) != DELETE).drop(SEQ, OP, BUCKET, PART, C.HASH)


def next_in_order(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str],
                  prefix: str = "_next_", partitions: int | None = None, scratch: str | None = None) -> DataFrame:
    """For every row, ``columns`` of the next row of the same key in ``order`` (NULL on a key's last row).

    Equivalent to ``lead(c) OVER (PARTITION BY keys ORDER BY order)`` but without
    putting a whole key in one task: rows are range-partitioned on (keys, order),
    so a hot key is split across many partitions of similar size; the ranges are
    written to ``scratch`` under the shared work root (the caller may delete it once the
    result is stored) so every later read sees the same ranges.  ``lead`` then runs per range
    partition, and each partition's last row takes its successor from the first
    row of the next non-empty partition - a frame of at most ``partitions`` rows.
    Keys must not be NULL.
    """
    spark = df.sparkSession
    n = partitions or max(spark.sparkContext.defaultParallelism,
                          int(spark.conf.get("spark.sql.shuffle.partitions")))
    sort_cols = [*keys, order]
    carried = list(dict.fromkeys([*keys, *columns]))
    scratch = scratch or fresh_dir(spark, "ranges")
    stamped = df.repartitionByRange(n, *[F.col(c) for c in sort_cols]).withColumn("_pid", F.spark_partition_id())
    stamped.write.parquet(scratch)
    ranged = spark.read.schema(stamped.schema).parquet(scratch)
    within = Window.partitionBy("_pid").orderBy(*sort_cols)
    local = ranged.withColumns({"_has_next": F.lead(F.lit(True)).over(within),
                                **{f"_ln_{c}": F.lead(c).over(within) for c in carried}})
    firsts = ranged.groupBy("_pid").agg(
        F.min_by(F.struct(*carried), F.struct(*sort_cols)).alias("_first"))
    successor = firsts.select("_pid", F.lead("_first").over(Window.orderBy("_pid")).alias("_succ"))
    joined = local.join(F.broadcast(successor), "_pid", "left")
    nxt = {c: F.when(F.col("_has_next"), F.col(f"_ln_{c}")).otherwise(F.col("_succ")[c]) for c in carried}
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & (nxt[k] == F.col(k))
    out = joined.withColumns({f"{prefix}{c}": F.when(same_key, nxt[c]) for c in columns})
    return out.drop("_pid", "_has_next", "_succ", *[f"_ln_{c}" for c in carried])


def scd2_apply(spark: SparkSession, target: str, changes: DataFrame, keys: Sequence[str], seq: Column, valid_from: Column,
               buckets: int = DEFAULT_BUCKETS, hold: bool = True, part: str | None = None, batch_id="manual") -> None:
    """K15 (extension): SCD type 2 history with validity intervals.

    Every distinct change is a version; ``_valid_to`` is the next version's ``_valid_from`` in sequence
    order (computed by :func:`next_in_order`, so a key with a huge history is still spread over many
    tasks); ``_is_current`` marks the open version.  Re-applying a batch is harmless: versions are
    deduplicated by (key, sequence), so the sequence must be a property of the change (its own time,
    file, content) and not of the run.
    """
    changes = changes.withColumns({SEQ: seq, "_valid_from": valid_from})
    if OP not in changes.columns:
        changes = changes.withColumn(OP, F.lit("UPSERT"))
    scratch = fresh_dir(spark, "ranges")

    def combine(current, incoming):
        both = incoming if current is None else current.drop("_valid_to", "_is_current").unionByName(
            incoming, allowMissingColumns=True)
        history = next_in_order(both.dropDuplicates([*keys, SEQ]), keys, SEQ, ["_valid_from"], scratch=scratch)
        return history.withColumnRenamed("_next__valid_from", "_valid_to").withColumn(
            "_is_current", F.col("_valid_to").isNull() & (F.col(OP) != DELETE))

    try:
        _merge(spark, target, changes, keys, [*keys, SEQ], combine, buckets, part, hold, batch_id)
    finally:
        delete_path(spark, scratch)
