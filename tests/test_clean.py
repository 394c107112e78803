"""C1-C13 on known input/output pairs, NULLs and hostile strings."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from strata.functions import clean as C


def run(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn("v")).collect()]


def test_normalize_amount_pairs(spark):
    got = run(spark, C.normalize_amount,
              ["1,234.56", "1.234,56", "USD 100", "$50.00", "-50", "1,234", "N/A", "0", ".", " 99.9 ", None])
    assert got == [1234.56, 1234.56, 100.0, 50.0, 50.0, 1.234, None, None, None, 99.9, None]


def test_parse_amount_pairs(spark):
    got = run(spark, C.parse_amount,
              ["1,234.56", "12,5", "-50", "1,234", "$50.005", "1.234,56", "-1,234", "USD", None, "N/A"])
    assert got == [Decimal("1234.56"), Decimal("12.50"), Decimal("-50.00"), Decimal("1234.00"),
                   Decimal("50.01"), None, None, None, None, None]


def test_dates_strict_and_multi(spark):
    got = run(spark, C.normalize_date, ["2024-01-05", "05/01/2024", " 2024-01-05 ", "2024-1-5", "2024-13-45",
                                        "2024/01/05", None])
    assert got == [dt.date(2024, 1, 5), dt.date(2024, 1, 5), dt.date(2024, 1, 5), None, None, None, None]
    multi = run(spark, C.parse_date_multi, ["2020-01-15", "15/01/2020", "2020/01/15", "15-01-2020", "N/A", "x"])
    assert multi == [dt.date(2020, 1, 15)] * 4 + [None, None]


def test_clean_string_placeholders(spark):
    got = run(spark, C.clean_string, ["  a  ", "", "   ", "n/a", "Sin Nombre", "desconocido", "NULL", "x\ty", None])
    assert got == ["a", None, None, None, None, None, None, "x\ty", None]


def test_country_status_risk_segment(spark):
    assert run(spark, C.normalize_country, ["peru", "Perú", "COL", "México", "br", "N/A", "XX", None]) == \
        ["PE", "PE", "CO", "MX", "BR", None, "XX", None]
    assert run(spark, C.normalize_status, ["Active", "suspended", "inactivo", " ACTIVO "]) == \
        ["activo", "suspendido", "inactivo", "activo"]
    assert run(spark, C.normalize_risk_level, ["sin clasificar", "ALTO", "na", "x"]) == [None, "alto", None, "x"]
    assert run(spark, C.normalize_segment, ["Standard", "estándar", "vip", "new", "Premium", "other"]) == \
        ["estandar", "estandar", "premium", "nuevo", "premium", "other"]


def test_phone(spark):
    got = run(spark, C.normalize_phone, ["912345678", "+51 912345678", "51-912345678", "555", "(01) 555-1234", None])
    assert got == ["+51912345678", "+51912345678", "+51912345678", "555", "+51015551234", None]


def test_hostile_strings_do_not_raise_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    hostile = ["9" * 400, "1e309", "--1", "1..2", "٣٤٥", "\u0000", "💳 12", "NaN", "Infinity"]
    df = spark.createDataFrame([(v,) for v in hostile], "v string")
    out = df.select(C.normalize_amount("v"), C.parse_amount("v"), C.normalize_date("v"),
                    C.parse_date_multi("v"), C.normalize_phone("v")).collect()
    assert len(out) == len(hostile)


def test_clean_transactions_is_one_projection(spark):
    df = spark.createDataFrame([(" TXN-20240101-00001 ",) + (None,) * 9],
                               ", ".join(f"{c} string" for c in C.TX_BUSINESS_COLUMNS))
    out = C.clean_transactions(df)
    assert out.columns[:10] == C.TX_BUSINESS_COLUMNS
    assert out.first().transaction_id == "TXN-20240101-00001"
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1
