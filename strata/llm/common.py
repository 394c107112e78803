"""Helpers shared by the corpus operators.

Conventions of the subpackage
-----------------------------
* Operators read only the columns they name; other columns of the input, whatever they are
  called, neither clash nor matter.  Filtering operators hand every input column on.
* A NULL text counts as an empty text unless an operator says otherwise.
* ``\\x20\\x09-\\x0D`` are the blanks; words are the runs between them (``bytes.split()`` without
  an argument splits on exactly these bytes).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from strata.session import fresh_dir
from strata.sources.stored import delete_path

WORD = r"[^\x20\x09-\x0D]+"

#: Rows of a table of a few dozen bytes a row that may be broadcast (about 16 MB in a hash table).
BROADCAST_ROWS = 300_000

#: Texts per Arrow batch: a few MB at usual lengths.  Batches are also bounded in bytes, so very
#: long texts travel in smaller batches.
BATCH_ROWS, BATCH_BYTES = 1024, 16 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


#: Intermediate tables of this process, oldest first.
_CUTS: list[str] = []


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Cuts the lineage on storage that every executor sees, so a lost executor costs at most the
    tasks it was running.  Who knows that tables are no longer read deletes them (``drop_cuts``).
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    _CUTS.append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def cut_mark() -> int:
    """Tables cut so far; pass it to ``drop_cuts`` later."""
    return len(_CUTS)


def drop_cuts(spark: SparkSession, mark: int, *keep: DataFrame) -> None:
    """Delete the tables cut since the mark, but for those that ``keep`` frames are read from."""
    kept = {k.cut_path for k in keep}
    for path in _CUTS[mark:]:
        if path not in kept:
            delete_path(spark, path)
    _CUTS[mark:] = [p for p in _CUTS[mark:] if p in kept]


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that the frame does not use yet (names compare without case)."""
    used = {c.lower() for c in df.columns}
    name, i = stem, 0
    while name.lower() in used:
        i += 1
        name = f"{stem}_{i}"
    return name


def raw(col: str) -> Column:
    """The text as UTF-8 bytes for a Python worker, NULL as empty."""
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


def per_text(make: Callable[[], Callable[[bytes], tuple]], schema: str, arrow: pa.StructType):
    """Column function: one struct per text.  ``make`` runs once per task and returns the text function."""

    @arrow_udf(schema)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn = make()
        names = [f.name for f in arrow]
        for batch in batches:
            rows = [fn(x) for x in batch.to_pylist()]
            cols = list(zip(*rows)) or [()] * len(names)
            yield pa.StructArray.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(cols, arrow)], fields=list(arrow))

    return run


def per_batch(make: Callable[[], Callable[[list[bytes]], pa.Array]], schema: str):
    """Column function: ``make`` runs once per task and returns a function of a whole batch of texts."""

    @arrow_udf(schema)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn = make()
        for batch in batches:
            yield fn(batch.to_pylist())

    return run


def crc_mod(col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (NULL id: NULL)."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(mod))


def bounded_broadcast(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only for a counted, small table; larger ones keep the shuffle join."""
    return F.broadcast(df) if rows <= limit else df
