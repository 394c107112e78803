"""The query catalogue: one entry per capability, each ``(spark, sf_dir) -> DataFrame``.

Every entry reads the driver tables (through the deterministic fixtures)
and runs over the whole of them.  Run-dependent values (wall-clock
timestamps, random ids) are left out of the returned projection so that the
result can be compared against an independent SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import clean as C
from strata.functions import constants as K
from strata.plans import gold as G
from strata.plans import silver as S
from strata.sources.fixtures import bronze, fixture

FIXED_RUN_ID = "catalog-run"


# --- shared silver / gold inputs ----------------------------------------------------------------

def tx_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.checked(bronze(spark, sf_dir, "tx_raw"), S.TRANSACTIONS)


def tx_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.current_state(S.valid_rows(tx_checked(spark, sf_dir), S.TRANSACTIONS), S.TRANSACTIONS)


def current(spark: SparkSession, sf_dir: str, entity: S.Entity) -> DataFrame:
    raw = {"merchants": "mer_raw", "users": "usr_raw"}[entity.name]
    changes = S.checked(bronze(spark, sf_dir, raw), entity)
    return S.current_state(S.valid_rows(changes, entity), entity)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.enrich(tx_valid(spark, sf_dir), current(spark, sf_dir, S.MERCHANTS),
                    current(spark, sf_dir, S.USERS))


def _stable(df: DataFrame) -> DataFrame:
    """Drop run-dependent columns (wall clock)."""
    return df.drop(*[c for c in G.RUN_DEPENDENT if c in df.columns])


# --- C*: cleaning -------------------------------------------------------------------------------

def q_clean_transactions(spark, sf_dir):
    prepared = S.prepare(bronze(spark, sf_dir, "tx_raw"), S.TRANSACTIONS)
    return prepared.select(*C.TX_BUSINESS_COLUMNS, "load_no", "_source_file", "_record_hash")


def q_clean_amount_decimal(spark, sf_dir):
    tx = fixture(spark, sf_dir, "tx_raw")
    return tx.groupBy(F.col("amount").alias("raw_amount")).agg(
        F.count(F.lit(1)).alias("n"),
    ).select("raw_amount", "n", C.parse_amount("raw_amount").alias("amount_decimal"),
             C.normalize_amount("raw_amount").alias("amount_double"))


def q_clean_dates_multi(spark, sf_dir):
    mer = fixture(spark, sf_dir, "mer_raw").select(F.col("affiliation_date").alias("raw_date"))
    usr = fixture(spark, sf_dir, "usr_raw").select(F.col("registration_date").alias("raw_date"))
    tx = fixture(spark, sf_dir, "tx_raw").select(F.col("transaction_date").alias("raw_date"))
    dates = mer.unionByName(usr).unionByName(tx)
    return dates.groupBy("raw_date").agg(F.count(F.lit(1)).alias("n")).select(
        "raw_date", "n", C.parse_date_multi("raw_date").alias("multi_date"),
        C.normalize_date("raw_date").alias("tx_date"))


def q_clean_merchants(spark, sf_dir):
    prepared = S.prepare(bronze(spark, sf_dir, "mer_raw"), S.MERCHANTS)
    return prepared.select(*C.MERCHANT_BUSINESS_COLUMNS, "load_no", "_record_hash")


def q_clean_users(spark, sf_dir):
    prepared = S.prepare(bronze(spark, sf_dir, "usr_raw"), S.USERS)
    return prepared.select(*C.USER_BUSINESS_COLUMNS, "load_no", "_record_hash")


def q_catalogue_membership(spark, sf_dir):
    """C14: cleaned transaction values against the reference lists and the (wider) lists that the rules accept."""
    clean = S.prepare(bronze(spark, sf_dir, "tx_raw"), S.TRANSACTIONS)
    lists = {"channel": (K.VALID_CHANNELS, K.TX_RULE_CHANNELS), "transaction_type": (K.VALID_TRANSACTION_TYPES, K.TX_RULE_TYPES),
             "status": (K.VALID_TRANSACTION_STATUS, K.TX_RULE_STATUS), "currency": (K.VALID_CURRENCIES, K.VALID_CURRENCIES)}
    values = clean.select(F.explode(F.array(*[F.struct(
        F.lit(field).alias("field"), F.coalesce(F.col(field).isin(*listed), F.lit(False)).alias("listed"),
        F.coalesce(F.col(field).isin(*accepted), F.lit(False)).alias("accepted")) for field, (listed, accepted) in lists.items()])).alias("v"))
    return values.groupBy("v.field").agg(F.count_if("v.listed").alias("listed"), F.count_if("v.accepted").alias("accepted"),
                                         F.count(F.lit(1)).alias("total"))


# --- W1 / quality ----------------------------------------------------------------------------------

def q_dedup_latest(spark, sf_dir):
    prepared = S.prepare(bronze(spark, sf_dir, "tx_raw"), S.TRANSACTIONS)
    return S.latest(prepared, S.TRANSACTIONS).select(
        *C.TX_BUSINESS_COLUMNS, "_ingestion_ts", "_source_file", "_record_hash")


def q_quality_valid(spark, sf_dir):
    return tx_valid(spark, sf_dir).drop("_seq")


def q_quality_rejected_reason(spark, sf_dir):
    return S.rejected_rows(tx_checked(spark, sf_dir)).select(
        "transaction_id", "rejection_reason", "rejected_field", "_source_file", "_record_hash")


def q_quality_error_array(spark, sf_dir):
    checked = tx_checked(spark, sf_dir)
    return checked.select("transaction_id", "_record_hash", "quality_errors",
                          (F.size("quality_errors") == 0).alias("is_valid"))


def q_quality_error_text(spark, sf_dir):
    checked = S.checked(bronze(spark, sf_dir, "usr_raw"), S.USERS)
    return checked.select("user_id", "load_no", "_record_hash",
                          F.array_join("quality_errors", "; ").alias("quality_error_text"),
                          (~F.col("_rejected")).alias("is_valid"))


def q_rejects_by_reason(spark, sf_dir):
    rejected = S.rejected_rows(tx_checked(spark, sf_dir))
    return rejected.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("rejected_count"))


def q_quarantine_records(spark, sf_dir):
    """Quarantine rows of all three sources (fan-in by ``unionByName``), run columns dropped."""
    parts = [
        S.quarantine_records(S.rejected_rows(tx_checked(spark, sf_dir)), S.TRANSACTIONS, FIXED_RUN_ID),
        S.quarantine_records(S.rejected_rows(S.checked(bronze(spark, sf_dir, "mer_raw"), S.MERCHANTS)),
                             S.MERCHANTS, FIXED_RUN_ID),
        S.quarantine_records(S.rejected_rows(S.checked(bronze(spark, sf_dir, "usr_raw"), S.USERS)),
                             S.USERS, FIXED_RUN_ID),
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select("quarantine_id", "source_name", "target_table", "rejection_reason",
                      "rejected_field", "raw_record", "source_file")


# --- SCD1 current state ---------------------------------------------------------------------------------

def q_scd1_merchants(spark, sf_dir):
    return current(spark, sf_dir, S.MERCHANTS).select(*C.MERCHANT_BUSINESS_COLUMNS, "_source_file")


def q_scd1_users(spark, sf_dir):
    return current(spark, sf_dir, S.USERS).select(*C.USER_BUSINESS_COLUMNS, "_source_file")


# --- gold -----------------------------------------------------------------------------------------

def q_enrich_transactions(spark, sf_dir):
    return _stable(enriched(spark, sf_dir))


def q_risk_score(spark, sf_dir):
    e = enriched(spark, sf_dir)
    return e.groupBy("risk_level", "status", "is_reverse", "risk_score").agg(
        F.count(F.lit(1)).alias("n"))


def q_calendar_keys(spark, sf_dir):
    e = enriched(spark, sf_dir)
    return e.select("transaction_id", "transaction_date", "date_key", "year", "quarter", "month",
                    "week_of_year", "day_of_month")


def q_channel_mapping(spark, sf_dir):
    e = enriched(spark, sf_dir)
    return e.groupBy("channel", "channel_id", "channel_name").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(18,2)").alias("amount"))


def _mart(name):
    def run(spark, sf_dir):
        return _stable(G.MARTS[name](enriched(spark, sf_dir)))
    run.__name__ = f"q_{name}"
    return run


QUERIES = {
    "clean_transactions": q_clean_transactions,
    "clean_amount_decimal": q_clean_amount_decimal,
    "clean_dates_multi": q_clean_dates_multi,
    "clean_merchants": q_clean_merchants,
    "clean_users": q_clean_users,
    "catalogue_membership": q_catalogue_membership,
    "dedup_latest": q_dedup_latest,
    "quality_valid": q_quality_valid,
    "quality_rejected_reason": q_quality_rejected_reason,
    "quality_error_array": q_quality_error_array,
    "quality_error_text": q_quality_error_text,
    "rejects_by_reason": q_rejects_by_reason,
    "quarantine_records": q_quarantine_records,
    "scd1_merchants": q_scd1_merchants,
    "scd1_users": q_scd1_users,
    "enrich_transactions": q_enrich_transactions,
    "risk_score": q_risk_score,
    "calendar_keys": q_calendar_keys,
    "channel_mapping": q_channel_mapping,
    **{name: _mart(name) for name in G.MARTS},
}
