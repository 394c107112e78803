"""Rules (invariant valid + rejected = input), dedup, silver goldens."""

from pyspark.sql import functions as F

from strata.operators.dedup import latest_by
from strata.plans import silver as S
from strata.sources.fixtures import bronze


def test_valid_plus_rejected_is_input(spark, sf_small):
    checked = S.checked(bronze(spark, sf_small, "tx_raw"), S.TRANSACTIONS).cache()
    total = checked.count()
    valid = checked.filter(~F.col("_rejected")).count()
    rejected = checked.filter(F.col("_rejected")).count()
    assert valid + rejected == total
    # every rejected row has a reason and a field, every valid row has neither
    assert checked.filter(F.col("_rejected") & F.col("rejection_reason").isNull()).count() == 0
    assert checked.filter(~F.col("_rejected") & F.col("rejection_reason").isNotNull()).count() == 0
    assert checked.filter(F.col("_rejected") != (F.size("quality_errors") > 0)).count() == 0


def test_null_channel_is_rejected_not_lost(spark):
    cols = S.TRANSACTIONS.columns
    row = ("TXN-20240101-00001", "USR-000001", "MCH-00001", None, "pago", "10.00", "pen",
           "2024-01-01", "aprobado", None)
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in cols)).withColumns({
        "_ingestion_ts": F.current_timestamp(), "_file_time": F.current_timestamp(), "_source_file": F.lit("f"), "_source_name": F.lit("t"),
        "_source_format": F.lit("csv"), "_schema_version": F.lit(1)})
    out = S.checked(df, S.TRANSACTIONS).first()
    assert out._rejected and out.rejection_reason == "channel: nulo crítico" and out.rejected_field == "channel"


def test_latest_by_keeps_null_keys_and_newest(spark):
    df = spark.createDataFrame(
        [("a", 1, "old"), ("a", 2, "new"), (None, 1, "n1"), (None, 2, "n2"), ("b", 5, "only")],
        "k string, ts int, v string")
    out = sorted(((r.k, r.v) for r in latest_by(df, ["k"], [F.col("ts").desc()]).collect()), key=repr)
    assert out == sorted([("a", "new"), (None, "n1"), (None, "n2"), ("b", "only")], key=repr)


def test_latest_by_plans_partial_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("k"), F.col("id").alias("ts"))
    plan = latest_by(df, ["k"], [F.col("ts").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_latest_by_reads_the_input_once_without_null_keys(spark, sf_small):
    valid = S.valid_rows(S.checked(bronze(spark, sf_small, "tx_raw"), S.TRANSACTIONS), S.TRANSACTIONS)
    plan = S.current_state(valid, S.TRANSACTIONS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # the feed itself is a union over orders


def test_rejected_newer_version_does_not_hide_an_older_valid_one(spark, sf_small):
    checked = S.checked(bronze(spark, sf_small, "tx_raw"), S.TRANSACTIONS).cache()
    state = S.current_state(S.valid_rows(checked, S.TRANSACTIONS), S.TRANSACTIONS).select("transaction_id", "_source_file")
    newer = checked.where("load_no = 1 and _rejected").select("transaction_id")
    older = checked.where("load_no = 0 and not _rejected").select("transaction_id")
    both = {r[0] for r in newer.intersect(older).collect()}
    assert both and both <= {r[0] for r in state.where(F.col("_source_file").contains("_0.")).collect()}


def test_goldens_sf001(spark):
    b = bronze(spark, "/root/testdata/sf0.01", "tx_raw")
    checked = S.checked(b, S.TRANSACTIONS).cache()
    assert b.count() == checked.count() == 16500
    assert checked.filter(~F.col("_rejected")).count() == 12084
    assert checked.filter(F.col("_rejected")).count() == 4416
    total = checked.agg(F.sum("amount").cast("decimal(18,2)")).first()[0]
    assert str(total) == "4012373919.99"
    state = S.current_state(S.valid_rows(checked, S.TRANSACTIONS), S.TRANSACTIONS)
    assert state.count() == 11125
    assert str(state.agg(F.sum("amount").cast("decimal(18,2)")).first()[0]) == "2802533049.93"
