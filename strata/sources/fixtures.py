"""Deterministic dirty source feeds derived from the driver tables.

The same SQL text runs in Spark (tables bound as DataFrames through
``spark.sql(..., orders=df)``) and in DuckDB (tables named directly), so
the differential oracle sees byte-identical inputs.  All dirt is a pure
function of the key - no randomness.

Bronze views add the audit columns an ingestion run would have stamped:
``_ingestion_ts`` = 2024-01-01 + ``load_no`` days (ingestion order),
``_source_name``, ``_source_format`` and ``_schema_version``.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TX_RAW = """
WITH o AS (
  SELECT o_orderkey AS k, o_custkey AS ck, o_orderstatus AS st, o_orderpriority AS pr,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) AS amt,
         CAST(CAST(o_orderdate AS DATE) AS STRING) AS d, 0 AS v FROM {orders}
  UNION ALL
  SELECT o_orderkey, o_custkey, 'F', o_orderpriority, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING),
         CAST(CAST(o_orderdate AS DATE) AS STRING), 1 FROM {orders} WHERE o_orderkey % 10 = 3
)
SELECT
  CASE WHEN k % 97 = 0 THEN NULL WHEN k % 89 = 0 THEN 'TX' || CAST(k AS STRING)
       ELSE '  TXN-' || replace(d,'-','') || '-' || lpad(CAST(k % 100000 AS STRING),5,'0') || ' ' END AS transaction_id,
  CASE WHEN k % 83 = 0 THEN 'usr' || CAST(ck AS STRING) ELSE 'USR-' || lpad(CAST(ck AS STRING),6,'0') END AS user_id,
  CASE WHEN k % 79 = 0 THEN NULL ELSE 'MCH-' || lpad(CAST(k % 110 AS STRING),5,'0') END AS merchant_id,
  CASE WHEN k % 73 = 0 THEN NULL WHEN k % 71 = 0 THEN 'fax' WHEN pr = '1-URGENT' THEN ' WEB' WHEN pr = '2-HIGH' THEN 'App '
       WHEN pr = '3-MEDIUM' THEN 'pos' WHEN pr = '5-LOW' THEN 'Kiosko' ELSE 'web' END AS channel,
  CASE k % 4 WHEN 0 THEN 'Pago' WHEN 1 THEN 'retiro' WHEN 2 THEN 'REVERSA' ELSE 'payment' END AS transaction_type,
  CASE WHEN k % 67 = 0 THEN 'N/A' WHEN k % 61 = 0 THEN '0' WHEN k % 5 = 0 THEN '$' || amt WHEN k % 5 = 1 THEN replace(amt,'.',',')
       WHEN k % 5 = 2 THEN 'USD ' || amt WHEN k % 5 = 3 THEN ' ' || amt || ' ' ELSE amt END AS amount,
  CASE WHEN k % 2 = 0 THEN ' usd' ELSE 'pen ' END AS currency,
  CASE WHEN k % 59 = 0 THEN '2024-13-45' WHEN k % 3 = 0 THEN substr(d,9,2) || '/' || substr(d,6,2) || '/' || substr(d,1,4) ELSE d END AS transaction_date,
  CASE WHEN k % 53 = 0 THEN NULL WHEN k % 47 = 0 OR (v = 1 AND k % 40 = 13) THEN 'desconocida' WHEN st = 'F' THEN 'APROBADO' WHEN st = 'O' THEN ' pendiente ' ELSE 'Rechazado' END AS status,
  CASE WHEN k % 8 = 2 THEN '  ' WHEN k % 4 = 2 THEN 'TXN-' || replace(d,'-','') || '-' || lpad(CAST((k + 1) % 100000 AS STRING),5,'0') ELSE NULL END AS reference_id,
  v AS load_no, CAST(k AS STRING) || '-' || CAST(v AS STRING) AS _row_id,
  'landing/transactions_' || CAST(v AS STRING) || '.csv' AS _source_file
FROM o
"""

MER_RAW = """
SELECT 'MCH-' || lpad(CAST(s_suppkey AS STRING),5,'0') AS merchant_id, ' ' || s_name AS merchant_name,
  CASE s_suppkey % 3 WHEN 0 THEN 'Retail' WHEN 1 THEN ' moda ' ELSE 'salud' END AS category,
  CASE s_nationkey % 6 WHEN 0 THEN 'peru' WHEN 1 THEN 'COL' WHEN 2 THEN 'México' WHEN 3 THEN 'br' WHEN 4 THEN 'N/A' ELSE 'XX' END AS country,
  CASE s_suppkey % 4 WHEN 0 THEN '2020-01-15' WHEN 1 THEN '15/01/2020' WHEN 2 THEN '2020/01/15' ELSE '15-01-2020' END AS affiliation_date,
  CASE WHEN v = 2 THEN 'suspended' WHEN s_suppkey % 7 = 0 THEN 'inactivo' ELSE 'Active' END AS status,
  CASE WHEN v = 1 AND s_suppkey % 5 = 0 THEN 'sin clasificar' WHEN s_acctbal < 2000 THEN 'ALTO' WHEN s_acctbal < 6000 THEN 'medio' ELSE 'bajo' END AS risk_level,
  v AS load_no, CAST(s_suppkey AS STRING) || '-' || CAST(v AS STRING) AS _row_id, 'landing/merchants_' || CAST(v AS STRING) || '.json' AS _source_file
FROM {supplier} CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1 UNION ALL SELECT 2) vv
WHERE v = 0 OR (v = 1 AND s_suppkey % 2 = 0) OR (v = 2 AND s_suppkey % 6 = 0)
"""

USR_RAW = """
SELECT CASE WHEN c_custkey % 211 = 0 AND v = 0 THEN 'NULL' ELSE 'USR-' || lpad(CAST(c_custkey AS STRING),6,'0') END AS user_id,
  CASE WHEN c_custkey % 31 = 0 THEN 'SIN NOMBRE' ELSE c_name END AS full_name,
  CAST(10000000 + c_custkey AS STRING) AS document_id,
  CASE WHEN c_custkey % 29 = 0 THEN 'sin_correo' WHEN c_custkey % 23 = 0 THEN 'not-an-email' ELSE 'User' || CAST(c_custkey AS STRING) || '@Mail.COM' END AS email,
  CASE c_custkey % 4 WHEN 0 THEN '9' || lpad(CAST(c_custkey AS STRING),8,'0') WHEN 1 THEN '+51 9' || lpad(CAST(c_custkey AS STRING),8,'0')
       WHEN 2 THEN '51-9' || lpad(CAST(c_custkey AS STRING),8,'0') ELSE '555' END AS phone,
  CASE c_nationkey % 5 WHEN 0 THEN 'Chile' WHEN 1 THEN 'ARG' WHEN 2 THEN 'ecuador' WHEN 3 THEN 'BRAZIL' ELSE 'PE' END AS country,
  CASE WHEN v = 1 THEN 'vip' WHEN c_mktsegment = 'BUILDING' THEN 'Standard' WHEN c_mktsegment = 'MACHINERY' THEN 'new' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'estándar' ELSE 'Premium' END AS segment,
  CASE c_custkey % 2 WHEN 0 THEN '2019-03-04' ELSE '04/03/2019' END AS registration_date,
  v AS load_no, CAST(c_custkey AS STRING) || '-' || CAST(v AS STRING) AS _row_id, 'landing/users_' || CAST(v AS STRING) || '.txt' AS _source_file
FROM {customer} CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1) vv WHERE v = 0 OR c_custkey % 4 = 1
"""

CDC_RAW = """
SELECT user_id AS key, ts AS sequence_ts, event_id AS tie, CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPSERT' END AS op,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS attr, CAST(value AS DECIMAL(18,2)) AS val FROM {events}
"""

# Deliveries of events in three drops (ten days each).  Some come a drop late, some twice in their drop, some again in the next
# drop with a time twelve days on.
EV_RAW = """
WITH b AS (SELECT event_id, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS amount, ts,
  CASE WHEN day(ts) <= 10 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 2 END AS d FROM {events})
SELECT event_id, user_id, event_type, amount, ts, d + CASE WHEN event_id % 40 = 7 AND d < 2 THEN 1 ELSE 0 END AS load_no FROM b
UNION ALL SELECT event_id, user_id, event_type, amount, ts, d FROM b WHERE event_id % 25 = 3 AND event_id % 40 <> 7
UNION ALL SELECT event_id, user_id, event_type, amount, ts + INTERVAL '12' DAY, d + 1 FROM b WHERE event_id % 35 = 4 AND event_id % 40 <> 7 AND d < 2
"""

# Payments and reversals that refer to them some days later (to none that exists, or too late, now and then).
PAY_RAW = """
SELECT o_orderkey AS payment_id, o_custkey AS payer, CAST(o_totalprice AS DECIMAL(18,2)) AS paid, CAST(o_orderdate AS TIMESTAMP) AS paid_at,
  CASE WHEN CAST(o_orderdate AS TIMESTAMP) < TIMESTAMP '1998-01-01 00:00:00' THEN 0 ELSE 1 END + CASE WHEN o_orderkey % 90 = 34 AND CAST(o_orderdate AS TIMESTAMP) < TIMESTAMP '1997-01-01 00:00:00' THEN 1 ELSE 0 END AS load_no
FROM {orders}
"""
REV_RAW = """
SELECT o_orderkey * 10 AS reversal_id, CASE WHEN o_orderkey % 70 = 4 THEN -o_orderkey ELSE o_orderkey END AS reference_id,
  CAST(o_orderdate AS TIMESTAMP) + INTERVAL '6' HOUR + INTERVAL '1' DAY * CAST(o_orderkey % 9 AS INT) AS reversed_at,
  CASE WHEN CAST(o_orderdate AS TIMESTAMP) < TIMESTAMP '1998-01-01 00:00:00' THEN 0 ELSE 1 END AS load_no
FROM {orders} WHERE o_orderkey % 10 = 4
"""

FIXTURES = {
    "ev_raw": (EV_RAW, ("events",)),
    "pay_raw": (PAY_RAW, ("orders",)),
    "rev_raw": (REV_RAW, ("orders",)),
    "tx_raw": (TX_RAW, ("orders",)),
    "mer_raw": (MER_RAW, ("supplier",)),
    "usr_raw": (USR_RAW, ("customer",)),
    "cdc_raw": (CDC_RAW, ("events",)),
}

# Source metadata stamped on the bronze views (name, format).
BRONZE_SOURCES = {
    "tx_raw": ("transactions", "csv"),
    "mer_raw": ("merchants", "json"),
    "usr_raw": ("users", "txt"),
}
INGESTION_EPOCH = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# On Spark the version fan-out is a generator, not a join with a constant table.
SPARK_REWRITES = {
    "CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1 UNION ALL SELECT 2) vv": "LATERAL VIEW explode(array(0, 1, 2)) vv AS v",
    "CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1) vv": "LATERAL VIEW explode(array(0, 1)) vv AS v",
}


def spark_sql_text(name: str) -> str:
    sql, _ = FIXTURES[name]
    for old, new in SPARK_REWRITES.items():
        sql = sql.replace(old, new)
    return sql


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of ``tx_raw``, ``mer_raw``, ``usr_raw``, ``cdc_raw`` as a lazy DataFrame."""
    _, tables = FIXTURES[name]
    return spark.sql(spark_sql_text(name), **{t: table(spark, sf_dir, t) for t in tables})


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as the bronze table an ingestion run would have produced."""
    source, fmt = BRONZE_SOURCES[name]
    return with_fixture_audit(fixture(spark, sf_dir, name), source, fmt)


def with_fixture_audit(df: DataFrame, source: str, fmt: str, schema_version: int = 1) -> DataFrame:
    at = F.timestamp_add("DAY", F.col("load_no"), F.lit(INGESTION_EPOCH).cast("timestamp_ntz"))
    return df.withColumns({
        "_ingestion_ts": at,
        "_file_time": at,
        "_source_name": F.lit(source),
        "_source_format": F.lit(fmt),
        "_schema_version": F.lit(schema_version),
    })


# --- the same inputs for DuckDB -------------------------------------------------------

@lru_cache(maxsize=None)
def fixture_sql(name: str) -> str:
    sql, tables = FIXTURES[name]
    return sql.format(**{t: t for t in tables})


def bronze_sql(name: str) -> str:
    source, fmt = BRONZE_SOURCES[name]
    return (
        f"SELECT *, TIMESTAMP '{INGESTION_EPOCH}' + to_days(CAST(load_no AS INTEGER)) AS _ingestion_ts, "
        f"'{source}' AS _source_name, '{fmt}' AS _source_format, 1 AS _schema_version "
        f"FROM ({fixture_sql(name)}) f"
    )


def with_ctes(body: str, *names: str, bronze_names: tuple[str, ...] = ()) -> str:
    """Prefix an oracle query with fixture CTEs (raw and/or bronze forms)."""
    ctes = [f"{n} AS ({fixture_sql(n)})" for n in names]
    ctes += [f"{n}_bronze AS ({bronze_sql(n)})" for n in bronze_names]
    return "WITH " + ",\n".join(ctes) + "\n" + body
