"""Stored parquet tables: small side files, remembered schemas and reads without footer merging.

A table folder carries its schema in ``_schema.json`` (names that start with ``_`` are invisible to
Spark's readers).  Writers extend it before they add a column; readers pass it to the scan, so a read
opens no footer to find out what columns exist and older files give NULL for newer columns.
"""

from __future__ import annotations

import json
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from strata.session import fresh_dir

SCHEMA_FILE = "_schema.json"


#: Bytes of a row group of staged rows: what a task holds of a file that it writes or reads.
ROW_GROUP = 8 << 20
#: Streams that run side by side may write to one table.
_SCHEMAS = threading.Lock()


class SchemaConflict(RuntimeError):
    """A column arrives with a type that the stored table does not have."""


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; empty if it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small side file as text; None if it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small side file; readers see the old or the new one."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    tmp = spark._jvm.org.apache.hadoop.fs.Path(p.getParent(), f"_tmp-{uuid.uuid4().hex}")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(tmp, p):
        raise OSError(f"could not write {path}")


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    text = read_text(spark, f"{path}/{SCHEMA_FILE}")
    return T.StructType.fromJson(json.loads(text)) if text else None


def _nullable(t: T.DataType) -> T.DataType:
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _nullable(f.dataType), True) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_nullable(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(_nullable(t.keyType), _nullable(t.valueType), True)
    return t


def remember_schema(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """Add a batch's columns to the table's schema (before the batch is written) and return the whole."""
    with _SCHEMAS:
        return _remember(spark, path, schema)


def _remember(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    known = stored_schema(spark, path)
    fields = list(known.fields) if known else []
    by_name = {f.name.lower(): f for f in fields}
    added = False
    for f in schema.fields:
        old, t = by_name.get(f.name.lower()), _nullable(f.dataType)
        if old is None:
            fields.append(T.StructField(f.name, t, True))
            by_name[f.name.lower()] = fields[-1]
            added = True
        elif old.dataType != t:
            raise SchemaConflict(f"{path}: column {f.name} is {old.dataType.simpleString()}, not {t.simpleString()}")
    whole = T.StructType(fields)
    if added:
        write_text(spark, f"{path}/{SCHEMA_FILE}", whole.json())
    return whole


def read_stored(spark: SparkSession, path: str) -> DataFrame:
    """A stored table with its remembered schema (a folder written without one is read as it is)."""
    schema = stored_schema(spark, path)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


@contextmanager
def staged(df: DataFrame, label: str, **counts: Column):
    """The rows of ``df`` as files of their own for as long as they are read, and aggregates taken while they are written.

    For a batch that is read several times.  Unlike persisted rows, which executors hold and, beyond their memory, pass on in
    pieces of ten thousand rows, its size does not show in an executor's memory, and readers take only the columns they need.
    """
    spark, path, seen = df.sparkSession, fresh_dir(df.sparkSession, label), Observation()
    try:
        watched = df.observe(seen, *[c.alias(name) for name, c in counts.items()]) if counts else df
        watched.write.option("parquet.block.size", ROW_GROUP).parquet(path)
        yield spark.read.schema(df.schema).parquet(path), {name: seen.get[name] for name in counts}
    finally:
        delete_path(spark, path)
