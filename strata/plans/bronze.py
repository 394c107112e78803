"""Bronze sources and jobs around them: source specs, bad-record repair (Q8, S16, K16), reset."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources.landing import MER_COLUMNS, TX_COLUMNS, USR_COLUMNS
from strata.plans.tables import refresh_table
from strata.sources.spec import SourceSpec, parse_specs, select_sources
from strata.sources.stored import SCHEMA_FILE, children, delete_path, path_exists, read_stored
from strata.streaming.ingest import Layout, add_audit_columns, ingest_batch


def _schema(cols, types=None) -> list[dict]:
    types = types or {}
    return [{"column_name": c, "data_type": types.get(c, "string")} for c in cols]


#: The names of the three sources, their files and keys.  All else is a default of ``SourceSpec``.
SOURCES = {
    "transactions": {"file_format": "csv", "file_pattern": "transactions_*.csv", "primary_key": ["transaction_id"],
                     "table_properties": {"quality": "bronze"}, "schema": _schema(TX_COLUMNS)},
    "merchants": {"file_format": "json", "file_pattern": "*.json", "multiline": True, "primary_key": ["merchant_id"],
                  "schema": _schema(MER_COLUMNS)},
    "users": {"file_format": "txt", "file_pattern": "users_*.txt", "delimiter": "|", "primary_key": ["user_id"],
              "schema": _schema(USR_COLUMNS)},
}


def source_specs_json(landing: str, **overrides) -> str:
    """The sources as a spec file (JSON text), pointed at ``landing``; ``overrides`` maps source name to fields to replace."""
    return json.dumps([{"source_name": name, "source_path": f"{landing}/{name}", "active": True, **fields, **overrides.get(name, {})}
                       for name, fields in SOURCES.items()])


def source_specs(landing: str, **overrides) -> dict[str, SourceSpec]:
    return {s.source_name: s for s in parse_specs(source_specs_json(landing, **overrides))}


# --- Q8: bad-record repair ------------------------------------------------------------------------------

BAD_RECORD_SCHEMA = T.StructType([
    T.StructField("record", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("source_name", T.StringType()), T.StructField("reason", T.StringType()),
])


def repaired_users(bad: DataFrame, delimiter: str = "|") -> DataFrame:
    """Rebuild user rows whose name was split in two (9 fields instead of 8).

    ``get`` (not ``[]``) keeps out-of-range access NULL under ANSI mode; rows of
    any other shape stay in the bad-record area for a person to look at.
    """
    parts = F.split(F.col("record"), "\\" + delimiter)
    p = [F.get(parts, i) for i in range(9)]
    rebuilt = bad.filter(F.size(parts) == 9).select(
        p[0].alias("user_id"), F.concat_ws(" ", p[1], p[2]).alias("full_name"),
        p[3].alias("document_id"), p[4].alias("email"), p[5].alias("phone"),
        p[6].alias("country"), p[7].alias("segment"), p[8].alias("registration_date"))
    return rebuilt.filter(F.col("user_id").isNotNull())


class RepairWriter:
    """``foreachBatch`` of the repair stream: each bad file is repaired exactly once
    (the stream's checkpoint remembers processed files, so nothing is moved)."""

    def __init__(self, spec: SourceSpec, layout: Layout, bad_path: str):
        self.spec, self.layout, self.bad_path, self.rows = spec, layout, bad_path, 0

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        fixed = add_audit_columns(repaired_users(batch, self.spec.delimiter or "|"), self.spec)
        fixed = fixed.withColumns({"_source_file": F.lit(self.bad_path), "_file_time": F.current_timestamp()})
        self.rows += ingest_batch(batch.sparkSession, fixed, self.spec, self.layout, f"repair-{batch_id}")


def repair_bad_users(spark: SparkSession, spec: SourceSpec, layout: Layout) -> int:
    """availableNow stream over the users' bad-record folder into bronze users."""
    _, _, bad_path = layout.spec_paths(spec)
    stream = (spark.readStream.schema(BAD_RECORD_SCHEMA).option("recursiveFileLookup", "true")
              .option("pathGlobFilter", "*.json").json(bad_path))
    writer = RepairWriter(spec, layout, bad_path)
    q = (stream.writeStream.foreachBatch(writer)
         .option("checkpointLocation", layout.checkpoint(f"{spec.source_name}_repair"))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return writer.rows


def count_bad_records(spark: SparkSession, bad_path: str) -> int:
    """Rows in a source's bad-record folder; 0 when the folder is missing or empty."""
    if not path_exists(spark, bad_path):
        return 0
    return spark.read.schema(BAD_RECORD_SCHEMA).option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", "*.json").json(bad_path).count()


# --- K13: reset ------------------------------------------------------------------------------------------


def empty_table(spark: SparkSession, path: str) -> None:
    """Truncate a stored table: its rows, keys and run markers go, its remembered columns stay."""
    for name in children(spark, path):
        if name != SCHEMA_FILE:
            delete_path(spark, f"{path}/{name}")
    delete_path(spark, f"{path}_unkeyed")


def reset_source(spark: SparkSession, spec: SourceSpec, layout: Layout,
                 delete_bad_records: bool = True) -> dict[str, str]:
    """Truncate the source's table and forget its stream state, each step isolated.

    A registered table keeps working: its partitions are synchronised with the empty folder.
    """
    target, ckpt, bad = layout.spec_paths(spec)
    name = f"`{spec.target_schema or 'bronze'}`.`{spec.table}`"

    def sync() -> None:
        if spark.catalog.tableExists(name):
            refresh_table(spark, name)

    steps = {"table": lambda: empty_table(spark, target), "checkpoint": lambda: delete_path(spark, ckpt)}
    if delete_bad_records:
        steps["bad_records"] = lambda: delete_path(spark, bad)
    steps["registered"] = sync
    out = {}
    for step, run in steps.items():
        try:
            run()
            out[step] = "OK"
        except Exception as e:  # noqa: BLE001 - report per step, keep going
            out[step] = f"ERROR {type(e).__name__}: {str(e)[:200]}"
    return out


def reset_sources(spark: SparkSession, specs: list[SourceSpec], layout: Layout, source_filter: str = "all",
                  delete_bad_records: bool = True) -> list[tuple[str, str, int, int]]:
    """Reset every selected source, one failing alone; ``(source, status, rows left, bad rows left)``."""
    out = []
    for spec in select_sources(specs, source_filter):
        steps = reset_source(spark, spec, layout, delete_bad_records)
        target, _, bad = layout.spec_paths(spec)
        try:
            left = read_stored(spark, target).count() if path_exists(spark, target) else 0
            bad_left = count_bad_records(spark, bad)
            status = "OK" if not left and set(steps.values()) == {"OK"} else "FAILED"
        except Exception:  # noqa: BLE001
            left, bad_left, status = -1, -1, "FAILED"
        out.append((spec.source_name, status, left, bad_left))
    return out


def file_load_no(path_col: Column, stem: str) -> Column:
    """Drop number encoded in a landed file name ``<stem>_<drop>_<n>.<ext>``."""
    return F.regexp_extract(path_col, stem + r"_(\d+)_\d+\.[a-z]+$", 1).cast("int")
