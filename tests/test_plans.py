"""Plan-shape guarantees of the batch catalogue (sf0.001): the scale design, checked."""

import re

import pytest

import __spark_entry__ as E
from strata import catalog as BATCH

SF = "/root/testdata/sf0.001"
SLOW_PATH = re.compile(r"BatchEvalPython|ArrowEvalPython|CartesianProduct|BroadcastNestedLoopJoin")


def executed(spark, key):
    df = E.queries()[key](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(BATCH.QUERIES))
def test_no_python_eval_or_nested_loops(spark, key):
    assert not SLOW_PATH.findall(executed(spark, key))


@pytest.mark.parametrize("key", ["fact_transactions", "dim_user", "quarantine_records", "scd1_users"])
def test_inputs_are_scanned_once_and_never_dealt_round_robin(spark, key):
    plan = executed(spark, key).split("+- == Initial Plan ==")[0]
    assert "RoundRobinPartitioning" not in plan and "REPARTITION_BY_NUM" not in plan
    scans = len(re.findall(r"FileScan parquet", plan))
    # orders twice (the feed is a union over it), supplier and customer once
    assert scans == {"fact_transactions": 4, "dim_user": 4, "quarantine_records": 4, "scd1_users": 1}[key]


def test_dedup_limits_rows_before_the_shuffle(spark):
    plan = executed(spark, "dedup_latest")
    assert "WindowGroupLimit" in plan and "Partial" in plan
    partial = plan.index("Partial")
    assert "Exchange hashpartitioning(transaction_id" in plan[:partial]


def test_marts_aggregate_map_side(spark):
    plan = executed(spark, "dim_user")
    assert "partial_max_by" in plan and "partial_count" in plan
    assert "SortMergeJoin" not in plan or "Broadcast" in plan


def test_scans_prune_columns(spark):
    # the users feed never uses the account balance: the scan must not read it
    plan = executed(spark, "scd1_users")
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert scans and all("c_custkey" in s and "c_acctbal" not in s for s in scans)


def test_cleaners_and_rules_are_evaluated_once_per_row(spark):
    """The filter on the verdict must not pull a second copy of the cleaners, nor of the rules, below it."""
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan, cleaning = (executed(spark, k).split("+- == Initial Plan ==")[0] for k in ("quality_valid", "clean_transactions"))
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)
    for once in ("regexp_replace", "gettimestamp"):
        assert plan.count(once) == cleaning.count(once) > 0, once
    rules = 3  # shapes of transaction, user and merchant ids; each of the two branches of the feed's union shows them
    assert plan.count("RLIKE") - cleaning.count("RLIKE") in (rules, 2 * rules)
    assert "Generate inline" in plan
