"""Control plane: types, schemas, spec loading and source selection."""

import json

import pytest
from pyspark.sql import types as T

from strata.sources.files import get_reader
from strata.sources.spec import (SpecError, build_schema, load_specs, parse_specs, resolve_type,
                                 select_sources)


def test_resolve_type():
    assert resolve_type("STRING") == T.StringType()
    assert resolve_type("bigint") == T.LongType()
    assert resolve_type("decimal(18, 2)") == T.DecimalType(18, 2)
    for bad in ("varchar2", "decimal(18)", "decimal(a,b)"):
        with pytest.raises(SpecError):
            resolve_type(bad)


SPECS = [
    {"source_name": "a", "source_path": "/x", "file_format": "csv", "active": True,
     "schema": [{"column_name": "id", "data_type": "int"}]},
    {"source_name": "B", "source_path": "/x", "file_format": "json", "active": True,
     "schema": [{"column_name": "id", "data_type": "string"}]},
    {"source_name": "off", "source_path": "/x", "file_format": "csv", "active": False, "schema": []},
    {"source_name": "nomark", "source_path": "/x", "file_format": "csv", "schema": []},
]


def test_parse_and_select(tmp_path, spark):
    p = tmp_path / "specs.json"
    p.write_text(json.dumps({"ingestion_archetypes": SPECS}))
    active = load_specs(spark, str(p))
    assert [s.source_name for s in active] == ["a", "B"]
    assert [s.source_name for s in select_sources(active, "b")] == ["B"]
    assert len(select_sources(active, "ALL")) == 2
    with pytest.raises(SpecError):
        select_sources(active, "off")
    p.write_text(json.dumps(SPECS))  # list at the top level works too
    assert len(load_specs(spark, str(p))) == 2


def test_schema_rules():
    a = parse_specs(json.dumps(SPECS))[0]
    schema = build_schema(a)
    assert schema.fields[0].nullable and schema.fields[0].dataType == T.IntegerType()
    with pytest.raises(SpecError):
        build_schema(parse_specs(json.dumps([dict(SPECS[0], infer_column_types=True)]))[0])
    with pytest.raises(SpecError):
        build_schema(parse_specs(json.dumps([dict(SPECS[0], schema=[])]))[0])


def test_reader_registry():
    assert get_reader("CSV") is get_reader("txt")
    with pytest.raises(SpecError):
        get_reader("xml")
