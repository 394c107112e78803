"""Catalogue entries over event time, history, several tables and several levels.

Streams are fed in three drops with a restart after each (one stream per drop on one checkpoint); what is late by the
watermark's rule is dropped, and the SQL restates the rule.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.catalog import current, enriched, tx_checked
from strata.operators import profile as P
from strata.operators import upsert as U
from strata.operators.asof import as_of_join
from strata.operators.integrity import Reference, Unique, violations
from strata.plans import gold as G
from strata.plans import silver as S
from strata.session import fresh_dir
from strata.sources.fixtures import fixture, table
from strata.streaming import event_time as V

DELAY, GAP, EVERY = "1 day", "6 hours", "1 day"
VELOCITY_LIMIT, VELOCITY_SECONDS = 4, 43_200
WITHIN = "5 DAYS"


def _events(spark, sf_dir) -> DataFrame:
    return fixture(spark, sf_dir, "ev_raw").withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks take no TIMESTAMP_NTZ


def _drops(spark, sf_dir, label: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Land the three drops one after the other; after each a new stream goes on from the checkpoint."""
    root, events = fresh_dir(spark, label), _events(spark, sf_dir)
    for d in range(3):
        events.where(F.col("load_no") == d).write.parquet(f"{root}/landing/drop{d}")
        V.drain(build(V.event_stream(spark, f"{root}/landing", events.schema)), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


def q_events_dedup_bounded(spark, sf_dir):
    """T4: repeats within the watermark's delay are dropped, later ones pass; late rows are dropped."""
    return _drops(spark, sf_dir, "dedup-bounded", lambda s: V.dedup_bounded(s, ["event_id"], "ts", DELAY)).select(
        "event_id", "user_id", "event_type", "amount", F.col("ts").cast("timestamp_ntz").alias("ts"))


def _plain_times(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def q_events_tumbling(spark, sf_dir):
    """Daily windows by type, given out when the watermark passes their end."""
    out = _drops(spark, sf_dir, "tumbling", lambda s: V.tumbling(
        s, "ts", EVERY, DELAY, ["event_type"], F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(18,2)").alias("amount")))
    return _plain_times(out, "window_start", "window_end")


def q_events_sessions(spark, sf_dir):
    """Sessions per user, given out when the watermark passes their end."""
    out = _drops(spark, sf_dir, "sessions", lambda s: V.sessions(
        s, "ts", GAP, DELAY, ["user_id"], F.count(F.lit(1)).alias("n"), F.sum("amount").cast("decimal(18,2)").alias("amount")))
    return _plain_times(out, "session_start", "session_end")


def q_events_velocity(spark, sf_dir):
    """Alerts of a keyed state with event-time timers: four events of a user within twelve hours."""
    out = _drops(spark, sf_dir, "velocity", lambda s: V.velocity_alerts(s, VELOCITY_LIMIT, VELOCITY_SECONDS, DELAY))
    return _plain_times(out, "alert_ts", "first_ts")


def q_reversal_match(spark, sf_dir):
    """Reversals with the payment that they refer to within five days before; a last drop far ahead closes all state."""
    root = fresh_dir(spark, "reversal-match")
    pay, rev = fixture(spark, sf_dir, "pay_raw"), fixture(spark, sf_dir, "rev_raw")
    ahead = F.lit("2030-01-01").cast("timestamp")
    beat = table(spark, sf_dir, "region").limit(1)
    pay_beat = beat.select(*[(ahead if c == "paid_at" else F.lit(-1).cast(t)).alias(c) for c, t in pay.dtypes])
    rev_beat = beat.select(*[(ahead if c == "reversed_at" else F.lit(-2).cast(t)).alias(c) for c, t in rev.dtypes])
    for d in range(3):
        (pay.where(F.col("load_no") == d) if d < 2 else pay_beat).write.parquet(f"{root}/pay/drop{d}")
        (rev.where(F.col("load_no") == d) if d < 2 else rev_beat).write.parquet(f"{root}/rev/drop{d}")
        matched = V.match_back(V.event_stream(spark, f"{root}/rev", rev.schema).drop("load_no"),
                               V.event_stream(spark, f"{root}/pay", pay.schema).drop("load_no"),
                               "reference_id", "payment_id", "reversed_at", "paid_at", WITHIN, DELAY)
        V.drain(matched, f"{root}/out", f"{root}/checkpoint")
    return _plain_times(spark.read.parquet(f"{root}/out"), "reversed_at", "paid_at").select(
        "reversal_id", "reference_id", "reversed_at", "payment_id", "payer", "paid", "paid_at")


# --- history ----------------------------------------------------------------------------------------------

def q_enrich_as_of(spark, sf_dir):
    """Every third event, an hour later, with what its user's history said at that time."""
    root = fresh_dir(spark, "as-of-history")
    cdc = fixture(spark, sf_dir, "cdc_raw").withColumn("_op", F.col("op"))
    for part in (1, 0):
        U.scd2_apply(spark, f"{root}/t", cdc.where(F.col("tie") % 2 == part), ["key"], F.struct("sequence_ts", "tie"), F.col("sequence_ts"), buckets=16,
                     batch_id=part)
    facts = table(spark, sf_dir, "events").where(F.col("event_id") % 3 == 0).select(
        "event_id", F.col("user_id").alias("key"), (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("at"))
    return as_of_join(facts, U.read_keyed(spark, f"{root}/t"), ["key"], "at", "_valid_from", ["attr", "val", "tie"],
                      seq=F.col("tie"), deleted=F.col("op") == "DELETE", prefix="as_of_")


# --- several tables, profiles, levels -------------------------------------------------------------------------

def q_referential_errors(spark, sf_dir):
    """Q6: accepted transactions whose merchant, user or reversed payment does not exist, or whose key repeats, as quarantine records."""
    checked = tx_checked(spark, sf_dir).where(~F.col("_rejected")).drop("_rejected", "rejection_reason", "rejected_field", "quality_errors")
    parents = {"merchants": current(spark, sf_dir, S.MERCHANTS), "users": current(spark, sf_dir, S.USERS), "transactions": checked}
    rules = [Reference(("merchant_id",), "merchants", ("merchant_id",)), Reference(("user_id",), "users", ("user_id",)),
             Reference(("reference_id",), "transactions", ("transaction_id",), F.col("transaction_type") == "reversa"),
             Unique(("transaction_id",))]
    bad = violations(checked, rules, parents).withColumn("quality_errors", F.array("rejection_reason"))
    return S.quarantine_records(bad, S.TRANSACTIONS, "catalog-run").select(
        "source_name", "target_table", "rejection_reason", "rejected_field", "raw_record", "source_file")


PROFILED = ["l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_linestatus", "l_returnflag"]


def q_column_profile(spark, sf_dir):
    """Q6: profiles from stored sketches of three batches (one replayed), held against exact values.

    Distinct counts may be off by three standard errors, the median's rank by the sketch's error.
    """
    path, lines = f"{fresh_dir(spark, 'profile')}/lineitem", table(spark, sf_dir, "lineitem")
    for batch in (0, 1, 2, 1):
        P.store(spark, path, lines.where(F.col("l_orderkey") % 3 == batch), PROFILED, batch)
    found = P.read_profile(spark, path)
    # 0.0 and -0.0 are one value, though two texts
    zero = {f.name: F.when(F.col(f.name) == 0, F.lit(0.0)).otherwise(F.col(f.name)).cast(f.dataType) for f in lines.schema.fields
            if f.name in PROFILED and isinstance(f.dataType, T.FractionalType) and not isinstance(f.dataType, T.DecimalType)}
    counted = P.counts(lines.withColumns(zero) if zero else lines, PROFILED).withColumn("number", F.col("value").try_cast("double"))
    n, numbers = F.col("n"), F.sum(F.when(F.col("number").isNotNull(), F.col("n")))

    def share(hit):
        return F.try_divide(F.coalesce(F.sum(F.when(hit, n)), F.lit(0)), numbers)
    # every value once, with its rows: exact distinct counts and ranks in one pass
    exact = counted.join(F.broadcast(found.select("column", "p50")), "column").groupBy("column").agg(
        F.count(F.lit(1)).alias("distinct"), share(F.col("number") < F.col("p50")).alias("below"), share(F.col("number") <= F.col("p50")).alias("upto"))
    error = 3 * 1.04 / 2 ** (P.LG_K / 2)
    return found.join(exact, "column").select(
        "column", "rows", "nulls", "least", "greatest",
        (F.abs(F.col("approx_distinct") - F.col("distinct")) <= error * F.col("distinct")).alias("distinct_within_error"),
        F.when(F.col("p50").isNotNull(), (F.col("below") <= 0.5 + 0.0165) & (F.col("upto") >= 0.5 - 0.0165)).alias("median_within_error"),
        F.when(F.col("top_count") > F.col("rows") / P.TOP_CAPACITY * 3, F.col("top_count")).alias("top_count"))


LEVELS = [["year", "quarter", "month"], ["year", "quarter"], ["year"], ["year", "channel_name"], ["channel_name"], []]


def q_measure_rollup(spark, sf_dir):
    """Summable measures over six grouping sets."""
    return G.measure_rollup(enriched(spark, sf_dir), LEVELS)


QUERIES = {
    "events_dedup_bounded": q_events_dedup_bounded,
    "events_tumbling": q_events_tumbling,
    "events_sessions": q_events_sessions,
    "events_velocity": q_events_velocity,
    "reversal_match": q_reversal_match,
    "enrich_as_of": q_enrich_as_of,
    "referential_errors": q_referential_errors,
    "column_profile": q_column_profile,
    "measure_rollup": q_measure_rollup,
}
