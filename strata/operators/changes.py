"""Change frames of keyed tables (K19): what every batch changed, row by row.

A keyed table that keeps changes stores a hash of each row's content (``_row_hash``: all columns whose names do
not begin with ``_``).  Before a batch is merged, the stored rows of the batch's keys are held against what the merge
will make of them, and the differences are written as one folder of ``<target>_changes``:

* ``insert``          a key that had no live row;
* ``update_before``,
  ``update_after``    a live row whose content differs (rows with the same content are no change);
* ``delete``          a live row that a tombstone replaces, as it was.

``_version`` counts the folders in the order in which they were written, ``_batch`` is the batch's id.

Replays: a folder is written before the table is touched and never again for the same batch id.  A batch that died
before its folder was complete finds the table unchanged and writes the folder anew; one that died later keeps the
folder and only repeats the merge, which is idempotent.  A batch whose merge is done as well (``_MERGED`` in its folder) is
left alone.  So the feed holds every change once.  Batch ids must therefore
name batches, as a stream's do.

Only rows of the batch's keys are compared, so the work follows the batch and not the table.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.stored import children, path_exists, read_stored, remember_schema, stored_schema, write_text

HASH, CHANGE, BATCH, VERSION = "_row_hash", "_change", "_batch", "_version"
INSERT, BEFORE, AFTER, DELETED = "insert", "update_before", "update_after", "delete"
_FOLDER = re.compile(r"v(\d+)-(.+)$")


def feed_path(target: str) -> str:
    return f"{target}_changes"


def content_hash(df: DataFrame) -> Column:
    """Hash of a row's content.  NULL fields count as absent, so a column added later changes no older row."""
    content = sorted(c for c in df.columns if not c.startswith("_"))
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in content]), {"ignoreNullFields": "true"}), 256)


def with_hash(df: DataFrame) -> DataFrame:
    """Add ``_row_hash``; rows stored without one (before the table kept changes) get it now."""
    return df.withColumn(HASH, F.coalesce(HASH, content_hash(df)) if HASH in df.columns else content_hash(df))


def _folders(spark: SparkSession, target: str) -> dict[str, tuple[int, str]]:
    """Batch id to (version, folder)."""
    found = (_FOLDER.match(name) for name in children(spark, feed_path(target)))
    return {m[2]: (int(m[1]), f"{feed_path(target)}/{m[0]}") for m in found if m}


def recorded(spark: SparkSession, target: str, batch_id) -> bool:
    """The batch's folder is complete."""
    known = _folders(spark, target).get(str(batch_id))
    return known is not None and path_exists(spark, f"{known[1]}/_SUCCESS")


def finished(spark: SparkSession, target: str, batch_id) -> bool:
    """The batch is in the feed and in the table."""
    known = _folders(spark, target).get(str(batch_id))
    return known is not None and path_exists(spark, f"{known[1]}/_MERGED")


def finish(spark: SparkSession, target: str, batch_id) -> None:
    """Note that the batch's merge is done."""
    known = _folders(spark, target).get(str(batch_id))
    if known is not None:
        write_text(spark, f"{known[1]}/_MERGED", "")


def difference(before: DataFrame | None, after: DataFrame, keys: Sequence[str], hidden: Sequence[str] = ()) -> DataFrame:
    """Change rows between two states of the same keys; both carry ``_row_hash``, tombstones have ``_op = 'DELETE'``."""
    columns = list(dict.fromkeys([*(before.columns if before is not None else []), *after.columns]))
    columns = [c for c in columns if c not in hidden]

    def side(df: DataFrame, name: str) -> DataFrame:
        kinds = {f.name: f.dataType for d in (before, after) for f in d.schema.fields}
        fields = [F.col(f"`{c}`") if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in columns]
        return df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.struct(*fields).alias(name))

    if before is None:  # nothing to compare with
        alive = F.coalesce(F.col("_op"), F.lit("UPSERT")) != "DELETE" if "_op" in columns else F.lit(True)
        return after.where(alive).select(F.lit(INSERT).alias(CHANGE), *[F.col(f"`{c}`") for c in columns])
    both = side(before, "b").join(side(after, "a"), [f"_k{i}" for i in range(len(keys))], "full_outer")

    def live(name: str) -> Column:
        alive = F.col(name).isNotNull()
        return alive & (F.coalesce(F.col(name)["_op"], F.lit("UPSERT")) != "DELETE") if "_op" in columns else alive

    was, is_ = live("b"), live("a")
    changed = was & is_ & ~F.col("b")[HASH].eqNullSafe(F.col("a")[HASH])
    out = F.array_compact(F.array(
        F.when(is_ & ~was, F.struct(F.lit(INSERT).alias(CHANGE), F.col("a").alias("row"))),
        F.when(changed, F.struct(F.lit(BEFORE).alias(CHANGE), F.col("b").alias("row"))),
        F.when(changed, F.struct(F.lit(AFTER).alias(CHANGE), F.col("a").alias("row"))),
        F.when(was & ~is_, F.struct(F.lit(DELETED).alias(CHANGE), F.col("b").alias("row")))))
    return both.select(F.explode(out).alias("x")).select(f"x.{CHANGE}", "x.row.*")


def record(spark: SparkSession, target: str, changes: DataFrame, batch_id) -> None:
    """Write a batch's folder, once: the caller asks ``recorded`` first."""
    folders = _folders(spark, target)
    version, path = folders.get(str(batch_id), (None, None))
    if version is None:
        version = 1 + max((v for v, _ in folders.values()), default=0)
        path = f"{feed_path(target)}/v{version:010d}-{batch_id}"
    rows = changes.withColumns({BATCH: F.lit(str(batch_id)), VERSION: F.lit(version).cast("long")})
    remember_schema(spark, feed_path(target), rows.schema)
    rows.write.mode("overwrite").parquet(path)


def read_changes(spark: SparkSession, target: str, after_version: int = 0) -> DataFrame | None:
    """All changes, or those behind a version; None if the table never kept any."""
    if not path_exists(spark, feed_path(target)):
        return None
    paths = sorted(p for v, p in _folders(spark, target).values() if v > after_version and path_exists(spark, f"{p}/_SUCCESS"))
    schema = stored_schema(spark, feed_path(target))
    return spark.read.schema(schema).parquet(*paths) if paths else read_stored(spark, feed_path(target)).limit(0)


def stream_changes(spark: SparkSession, target: str, max_files: int | None = None) -> DataFrame:
    """The feed as a stream: every change once per checkpoint."""
    reader = spark.readStream.schema(stored_schema(spark, feed_path(target))).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(feed_path(target))
