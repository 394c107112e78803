"""File readers for landing sources.

A source is read as a list of files.  The stream over a landing folder carries file names only
(``new_files``); each micro-batch then reads its files here, so one batch reader serves streams and
static loads alike, and what a file's header or keys say can be looked at before it is read.

* Delimited text (csv / txt) binds columns by the header of each file: files with the same header are
  read together, declared columns by name, others as undeclared text.  A file whose header names no
  declared column at all is read by position, as a header that says nothing.  Rows with too many or too
  few fields for their file go to the corrupt-record column (PERMISSIVE).
* JSON (multi-line arrays or objects by default, or JSON lines) uses Spark's JSON source with the
  declared columns plus the undeclared top-level keys that schema inference finds in the batch's files
  (files with keys that differ only in case are parsed as maps).
* Undeclared values arrive in ``_extra_fields``; ``apply_evolution`` merges, rescues or refuses them.
* ``_source_file`` and ``_file_time`` (modification time) come from the hidden ``_metadata`` column.
"""

from __future__ import annotations

import csv
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import constants as K
from strata.sources.spec import SourceSpec, SpecError, build_schema

CORRUPT = "_corrupt_record"
EXTRA = "_extra_fields"
SOURCE_FILE, FILE_TIME = "_source_file", "_file_time"
DATE_FORMAT = K.READ_DATE_FORMAT
TIMESTAMP_FORMAT = K.READ_TIMESTAMP_FORMAT
DEFAULT_DELIMITER = K.DEFAULT_DELIMITERS
#: Columns that ingestion itself writes: an undeclared field of that name is rescued, never merged.
RESERVED = (CORRUPT, EXTRA, SOURCE_FILE, FILE_TIME, "_ingestion_ts", "_source_name", "_source_format", "_schema_version",
            "_batch_id", "_part", "_bucket", "_seq", "_op", "_valid_from", "_valid_to", "_is_current", "_record_hash", "_raw_record")

_FILE_LIST = "path string, modificationTime timestamp, length bigint, content binary"


@dataclass(frozen=True)
class Batch:
    """Rows of some files, and the undeclared field names that their headers or keys show."""

    rows: DataFrame
    extra_names: tuple[str, ...] = ()


# --- which files (S5) ---------------------------------------------------------------------------------


def new_files(spark: SparkSession, spec: SourceSpec, max_files: int | None = None) -> DataFrame:
    """Stream of the paths of files not yet seen by the checkpoint; no file is opened."""
    r = spark.readStream.format("binaryFile").schema(_FILE_LIST).option("pathGlobFilter", spec.glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(spec.source_path).select("path")


def list_files(spark: SparkSession, spec: SourceSpec, path: str | None = None) -> list[str]:
    """Paths that match the pattern now."""
    found = (spark.read.format("binaryFile").option("pathGlobFilter", spec.glob).load(path or spec.source_path).select("path"))
    return sorted(r[0] for r in found.collect())


# --- delimited text (S6, S8) ----------------------------------------------------------------------------


def _first_line(spark: SparkSession, path: str, encoding: str) -> str:
    """One line of one file: a header is all that reaches the driver."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    raw = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        stream = codec.createInputStream(raw) if codec is not None else raw
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, encoding))
        return (reader.readLine() or "").lstrip("\ufeff")
    finally:
        raw.close()


def _all_read(names: list[str]) -> Column:
    """Always true, but reads the named columns.

    The CSV parser sees surplus or missing fields only if every column is asked for, and Spark refuses scans
    that need nothing but the corrupt-record column.
    """
    return F.hash(*[F.col(f"`{n}`") for n in names]) >= F.lit(-2 ** 31)


def _delimited(spark: SparkSession, spec: SourceSpec, schema: T.StructType, files: list[str]) -> DataFrame:
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    return (
        spark.read.format("csv").schema(with_corrupt)
        .option("header", str(bool(spec.header)).lower())
        .option("enforceSchema", "true")
        .option("sep", spec.delimiter or DEFAULT_DELIMITER.get(spec.fmt, ","))
        .option("encoding", spec.encoding or "UTF-8")
        .option("multiLine", str(bool(spec.multiline)).lower())
        .option("dateFormat", DATE_FORMAT)
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .load(files)
        .where(_all_read(schema.fieldNames()))
        .withColumns({SOURCE_FILE: F.col("_metadata.file_path"), FILE_TIME: F.col("_metadata.file_modification_time")})
    )


def _extras(pairs: list[tuple[str, Column]]) -> Column:
    """``map<string,string>`` of the undeclared values that are not NULL; NULL if there are none."""
    if not pairs:
        return F.lit(None).cast("map<string,string>")
    entries = F.filter(F.array(*[F.struct(F.lit(n).alias("k"), c.cast("string").alias("v")) for n, c in pairs]),
                       lambda e: e["v"].isNotNull())
    return F.when(F.size(entries) > 0, F.map_from_entries(entries))


def read_delimited(spark: SparkSession, spec: SourceSpec, schema: T.StructType, files: list[str]) -> Batch:
    """Files with one header are read together, columns bound by name."""
    declared = {f.name.lower(): f for f in schema.fields}
    groups: dict[tuple[str, ...], list[str]] = {}
    sep = spec.delimiter or DEFAULT_DELIMITER.get(spec.fmt, ",")
    for f in files:
        line = _first_line(spark, f, spec.encoding or "UTF-8") if spec.header else ""
        names = tuple(n.strip() for n in next(csv.reader([line], delimiter=sep), [])) if line else ()
        plain = not any(n.lower() in declared for n in names) or tuple(n.lower() for n in names) == tuple(declared)
        groups.setdefault(() if plain else names, []).append(f)
    parts, extra = [], {}
    for names, members in groups.items():
        if not names:
            rows, bound, others = _delimited(spark, spec, schema, members), {f.name: F.col(f"`{f.name}`") for f in schema.fields}, []
        else:
            fields, bound, others = [], {}, []
            for i, n in enumerate(names):
                d = declared.get(n.lower())
                if d is not None and d.name not in bound:
                    fields.append(d)
                    bound[d.name] = F.col(f"`{d.name}`")
                else:
                    fields.append(T.StructField(f"_undeclared_{i}", T.StringType(), True))
                    label = n or f"column {i + 1}"
                    while label in dict(others):  # a header that repeats a name
                        label += "_"
                    others.append((label, F.col(f"_undeclared_{i}")))
            rows = _delimited(spark, spec, T.StructType(fields), members)
        extra.update(dict.fromkeys(n for n, _ in others))
        parts.append(rows.select(
            *[bound.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields],
            _extras(others).alias(EXTRA), CORRUPT, SOURCE_FILE, FILE_TIME))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return Batch(out, tuple(extra))


# --- JSON (S7) ---------------------------------------------------------------------------------------------


@contextmanager
def _exact_names(spark: SparkSession):
    """``v`` and ``V`` are two keys while a JSON schema is found."""
    before = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)


def _typed(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, T.DateType):
        return F.try_to_date(value, DATE_FORMAT)
    if isinstance(dtype, T.TimestampType):
        return F.try_to_timestamp(value, F.lit(TIMESTAMP_FORMAT))
    return value.try_cast(dtype)


def read_json(spark: SparkSession, spec: SourceSpec, schema: T.StructType, files: list[str]) -> Batch:
    """Spark's JSON source; undeclared top-level keys come from schema inference over the same files."""
    multiline = True if spec.multiline is None else bool(spec.multiline)

    def reader():
        return (spark.read.format("json").option("multiLine", str(multiline).lower()).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", CORRUPT).option("primitivesAsString", "true")
                .option("encoding", spec.encoding or "UTF-8").option("lineSep", "\n"))

    declared = [f.name for f in schema.fields]
    with _exact_names(spark):
        keys = [n for n in reader().load(files).schema.fieldNames() if n != CORRUPT]
    others = [n for n in keys if n not in declared]
    _bounded(spec, others)
    names = [*declared, *others]
    if len({n.lower() for n in names}) < len(names):
        # keys that differ only in case cannot be columns of one scan
        value = {n: F.col("_m")[n] for n in names}
        raw = _json_maps(spark, spec, files, multiline)
    else:
        wanted = T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, CORRUPT]])
        raw = reader().schema(wanted).load(files).where(_all_read(names[:1])).select(
            F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"), F.col(CORRUPT).alias("_bad"),
            F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_modification_time").alias("_time"))
        value = {n: F.col("_row")[n] for n in names}
    return Batch(raw.select(
        *[_typed(value[f.name], f.dataType).alias(f.name) for f in schema.fields],
        _extras([(n, value[n]) for n in others]).alias(EXTRA), F.col("_bad").alias(CORRUPT),
        F.col("_file").alias(SOURCE_FILE), F.col("_time").alias(FILE_TIME)), tuple(others))


def _json_maps(spark: SparkSession, spec: SourceSpec, files: list[str], multiline: bool) -> DataFrame:
    """Records as ``map<string,string>`` with every key as written; a file (or line) that does not parse is ``_bad``."""
    text = F.decode(F.col("content"), spec.encoding or "UTF-8")
    lines = spark.read.format("binaryFile").load(files).select(
        F.col("path").alias("_file"), F.col("modificationTime").alias("_time"),
        (text if multiline else F.explode(F.split(text, "\r?\n"))).alias("value")).where(F.trim("value") != "")
    one, many = F.from_json("value", "map<string,string>"), F.from_json("value", "array<map<string,string>>")
    records = F.coalesce(many, F.when(one.isNotNull(), F.array(one)))
    return lines.select("_file", "_time", F.when(records.isNull(), F.col("value")).alias("_bad"),
                        F.explode(F.coalesce(records, F.array(F.lit(None).cast("map<string,string>")))).alias("_m"))


READERS = {"csv": read_delimited, "txt": read_delimited, "json": read_json}


def get_reader(file_format: str):
    """Reader by format name (case-insensitive)."""
    r = READERS.get((file_format or "").lower())
    if r is None:
        raise SpecError(f"unsupported file_format '{file_format}'; valid: {sorted(READERS)}")
    return r


def read_batch(spark: SparkSession, spec: SourceSpec, files: list[str]) -> Batch:
    """The rows of some files of a source."""
    schema = build_schema(spec)
    reader = get_reader(spec.fmt)
    if not files:
        empty = T.StructType([*schema.fields, T.StructField(EXTRA, T.MapType(T.StringType(), T.StringType())),
                              T.StructField(CORRUPT, T.StringType()), T.StructField(SOURCE_FILE, T.StringType()),
                              T.StructField(FILE_TIME, T.TimestampType())])
        return Batch(spark.createDataFrame([], empty))
    return reader(spark, spec, schema, files)


def read_source(spark: SparkSession, spec: SourceSpec, path: str | None = None) -> DataFrame:
    """Every file that matches the pattern now, as one static frame."""
    get_reader(spec.fmt)
    return read_batch(spark, spec, list_files(spark, spec, path)).rows


# --- corrupt split and schema evolution (S10, S12) --------------------------------------------------------

def good_rows(df: DataFrame) -> DataFrame:
    """Rows that parsed."""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_rows(df: DataFrame, source_name: str) -> DataFrame:
    """Malformed input as bad-record JSON rows: ``record`` holds the raw text."""
    return df.filter(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("record"), F.col(SOURCE_FILE).alias("path"),
        F.lit(source_name).alias("source_name"),
        F.lit("MALFORMED_RECORD").alias("reason"))


class SchemaEvolutionError(RuntimeError):
    pass


def _bounded(spec: SourceSpec, names) -> None:
    if len(names) > spec.max_new_columns:
        raise SchemaEvolutionError(f"[{spec.source_name}] {len(names)} undeclared fields, more than max_new_columns = "
                                   f"{spec.max_new_columns}; are data used as keys?")


def apply_evolution(df: DataFrame, spec: SourceSpec, names: tuple[str, ...] = ()) -> DataFrame:
    """S12 on a batch frame with undeclared fields ``names`` in ``_extra_fields``.

    ``merge`` adds them as text columns, ``rescue`` keeps them as JSON text in the rescued-data column,
    ``fail`` raises.  A field whose name differs from a declared, reserved or other new column only in
    case (or is one of those names) cannot become a column: ``merge`` rescues it.
    """
    mode = (spec.schema_evolution_mode or "merge").lower()
    if mode not in ("merge", "rescue", "fail"):
        raise SpecError(f"schema_evolution_mode '{mode}' is not one of merge | rescue | fail")
    if mode == "rescue":
        return df.withColumn(spec.rescued_data_column, F.to_json(EXTRA)).drop(EXTRA)
    if names and mode == "fail":
        raise SchemaEvolutionError(f"[{spec.source_name}] undeclared fields {sorted(names)} and evolution mode 'fail'")
    _bounded(spec, names)
    taken = {n.lower() for n in (*spec.column_names, *RESERVED, spec.rescued_data_column)}
    new = []
    for n in sorted(names):
        if n.lower() not in taken:
            taken.add(n.lower())
            new.append(n)
    clash = [n for n in names if n not in new]
    if clash:
        rescued = F.map_filter(EXTRA, lambda k, v: k.isin(*clash))
        df = df.withColumn(spec.rescued_data_column, F.when(F.size(rescued) > 0, F.to_json(rescued)))
    return df.withColumns({n: F.col(EXTRA)[n] for n in new}).drop(EXTRA)
