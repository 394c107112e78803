"""Source specifications (S1-S4, S9, C15): the small JSON control plane.

A spec file is a list of source objects, or ``{"ingestion_archetypes": [...]}``.
Only sources with ``"active": true`` are used.  Schemas are declared, never
inferred; every field is nullable.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import SparkSession
from pyspark.sql import types as T

TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(), "integer": T.IntegerType(), "int": T.IntegerType(),
    "long": T.LongType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "float": T.FloatType(), "boolean": T.BooleanType(), "bool": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "short": T.ShortType(),
}
_DECIMAL = re.compile(r"^\s*decimal\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)\s*$", re.IGNORECASE)

FORMATS = ("csv", "txt", "json")
EVOLUTION_MODES = ("merge", "rescue", "fail")
WRITE_MODES = ("append", "overwrite", "merge", "scd2")
LOAD_MODES = ("available_now", "streaming", "batch")


class SpecError(ValueError):
    """A configuration problem in one source (reported per source, never fatal for others)."""


def resolve_type(name: str) -> T.DataType:
    """S3: type name (case-insensitive) or ``decimal(p,s)`` -> Spark type."""
    if name is None:
        raise SpecError("missing data_type")
    m = _DECIMAL.match(name)
    if m:
        return T.DecimalType(int(m.group(1)), int(m.group(2)))
    if name.strip().lower().startswith("decimal"):
        raise SpecError(f"malformed decimal type '{name}', expected decimal(p,s)")
    t = TYPE_NAMES.get(name.strip().lower())
    if t is None:
        raise SpecError(f"unsupported type '{name}'; valid: {sorted(TYPE_NAMES)} + decimal(p,s)")
    return t


@dataclass(frozen=True)
class SourceSpec:
    """One ingestion source."""
    source_name: str
    source_path: str
    file_format: str
    columns: tuple[tuple[str, str], ...]
    file_pattern: str | None = None
    delimiter: str | None = None
    encoding: str = "UTF-8"
    header: bool = True
    multiline: bool | None = None
    primary_key: tuple[str, ...] = ()
    deduplication_mode: str = "none"
    write_mode: str = "append"
    target_schema: str = "bronze"
    target_table: str | None = None
    checkpoint_location: str | None = None
    bad_records_path: str | None = None
    rescued_data_column: str = "_rescued_data"
    schema_version: int = 1
    schema_evolution_mode: str = "merge"
    enable_observability: bool = True
    infer_column_types: bool = False
    table_properties: dict[str, str] = field(default_factory=dict)
    max_files_per_trigger: int | None = None
    max_new_columns: int = 200
    sequence_column: str | None = None
    load_mode: str = "available_now"
    trigger_interval: str = "1 minute"
    active: bool = False

    @property
    def fmt(self) -> str:
        return (self.file_format or "").lower()

    @property
    def table(self) -> str:
        return self.target_table or self.source_name

    @property
    def glob(self) -> str:
        return self.file_pattern or f"*.{self.fmt}"

    @property
    def recency_column(self) -> str | None:
        """Column that says which of two rows of a key is newer: declared, else the first timestamp column."""
        return self.sequence_column or next((c for c, t in self.columns if (t or "").strip().lower() == "timestamp"), None)

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @classmethod
    def from_dict(cls, d: dict[str, Any]) -> "SourceSpec":
        cols = tuple((c.get("column_name"), c.get("data_type")) for c in (d.get("schema") or []))
        known = {f for f in cls.__dataclass_fields__}
        kw = {k: v for k, v in d.items() if k in known and k not in ("schema", "columns")}
        if "primary_key" in kw:
            kw["primary_key"] = tuple(kw["primary_key"] or ())
        if kw.get("table_properties") is None:
            kw.pop("table_properties", None)
        for k in ("header", "multiline", "delimiter"):
            if k in kw and kw[k] is None:
                kw.pop(k)
        return cls(columns=cols, **kw)


def build_schema(spec: SourceSpec) -> T.StructType:
    """Declared schema, all fields nullable; inference is refused."""
    if spec.infer_column_types:
        raise SpecError(f"[{spec.source_name}] infer_column_types=true is not allowed: schemas are declared")
    if not spec.columns:
        raise SpecError(f"[{spec.source_name}] no schema declared")
    return T.StructType([T.StructField(n, resolve_type(t), True) for n, t in spec.columns])


def parse_specs(text: str) -> list[SourceSpec]:
    parsed = json.loads(text)
    items = parsed if isinstance(parsed, list) else parsed.get("ingestion_archetypes", [])
    return [SourceSpec.from_dict(d) for d in items]


def load_specs(spark: SparkSession, path: str, active_only: bool = True) -> list[SourceSpec]:
    """Read the spec file through Spark (works on any Hadoop file system).

    The file is configuration-sized; bringing its text to the driver is fine.
    """
    text = spark.read.text(path, wholetext=True).first()[0]
    specs = parse_specs(text)
    return [s for s in specs if s.active] if active_only else specs


def select_sources(specs: list[SourceSpec], name: str = "all") -> list[SourceSpec]:
    """``all`` or one source by name (case-insensitive)."""
    wanted = (name or "all").strip().lower()
    if wanted == "all":
        return list(specs)
    chosen = [s for s in specs if s.source_name.lower() == wanted]
    if not chosen:
        raise SpecError(f"source '{name}' not found or inactive; active sources: "
                        f"{[s.source_name for s in specs]}")
    return chosen


def runtime_setting(spark: SparkSession, key: str, default: str) -> str:
    """Runtime setting with a default (catalog, landing path, spec path...)."""
    return spark.conf.get(key, default)
