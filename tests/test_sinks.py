"""Keyed sinks: upsert idempotence, SCD1 arrival-order independence and tombstones, SCD2."""

import pytest
from pyspark.sql import functions as F

from strata.operators import upsert as U
from strata.session import fresh_dir


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_replaces_and_inserts_idempotently(spark):
    target = fresh_dir(spark, "t-upsert")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    second = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    U.upsert(spark, target, first, ["k"], buckets=4)
    U.upsert(spark, target, second, ["k"], buckets=4)
    U.upsert(spark, target, second, ["k"], buckets=4)  # replay
    assert rows(U.read_keyed(spark, target), "k", "v") == [(1, "a"), (2, "B"), (3, "c")]


def days(spark, n_days, per_day=20):
    return spark.range(n_days * per_day).select(
        F.format_string("TXN-202401%02d-%05d", F.col("id") % n_days + 1, F.col("id")).alias("k"), F.lit("x").alias("v"))


def files_of(spark, target):
    return {r[0] for r in U.read_keyed(spark, target).select("_metadata.file_path").distinct().collect()}


DAY = "substr(k, 5, 8)"


def test_a_one_day_batch_rewrites_one_day(spark):
    target = fresh_dir(spark, "t-days")
    U.upsert(spark, target, days(spark, 10), ["k"], buckets=2, part=DAY)
    before = files_of(spark, target)
    batch = spark.createDataFrame([(f"TXN-20240103-{i:05d}", "y") for i in range(2, 200, 10)], "k string, v string")
    U.upsert(spark, target, batch, ["k"], buckets=2, part=DAY)
    after = files_of(spark, target)
    assert {f for f in before - after} == {f for f in before if "_part=20240103" in f}
    assert {f for f in after - before} == {f for f in after if "_part=20240103" in f}
    assert U.read_keyed(spark, target).where("v = 'y'").count() == 20 and U.read_keyed(spark, target).count() == 200


def test_touched_partitions_are_read_by_pruning(spark):
    target = fresh_dir(spark, "t-prune")
    U.upsert(spark, target, days(spark, 10), ["k"], buckets=2, part=DAY)
    plan = U.read_keyed(spark, target, [("20240103", 0)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "20240103" in plan


def test_stored_layout_wins_over_a_changed_setting(spark):
    target = fresh_dir(spark, "t-layout")
    rows_ = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    U.upsert(spark, target, rows_, ["k"], buckets=16)
    U.upsert(spark, target, rows_, ["k"], buckets=32)
    assert U.read_keyed(spark, target).count() == 100 and U.stored_home(spark, target).buckets == 16
    with pytest.raises(U.KeyedTableError):
        U.upsert(spark, target, rows_, ["v"], buckets=16)


def test_null_keys_and_sequences_are_set_aside_once(spark):
    target = fresh_dir(spark, "t-null")
    batch = spark.createDataFrame([(1, 1, "a"), (None, 1, "n"), (2, None, "s"), (None, None, "b")], "k int, seq int, v string")
    for _ in range(3):  # replayed
        U.scd1_apply(spark, target, batch, ["k"], F.struct("seq", F.lit("x").alias("file")), buckets=2, batch_id=5)
        U.upsert(spark, f"{target}-u", batch.drop("seq"), ["k"], buckets=2, batch_id=5)
    assert rows(U.scd1_current(spark, target), "v") == [("a",)]
    assert sorted(r.v for r in U.unkeyed(spark, target).collect()) == ["b", "n", "s"]
    assert rows(U.read_keyed(spark, f"{target}-u"), "v") == [("a",), ("s",)]
    assert sorted(r.v for r in U.unkeyed(spark, f"{target}-u").collect()) == ["b", "n"]


def test_keep_one_does_not_depend_on_batches(spark):
    data = [(k, s, f"{k}{s}") for k in (1, 2, 3) for s in (4, 1, 3)] + [(None, 9, "n1"), (None, 9, "n2")]
    for newest in (True, False):
        states = []
        for cut in ([data], [[r] for r in data], [data[5:], data[:5], data[2:]]):
            target = fresh_dir(spark, "t-keep")
            for i, part in enumerate(cut):
                U.keep_one(spark, target, spark.createDataFrame(part, "k int, seq int, v string"), ["k"], F.col("seq"), newest,
                           buckets=2, batch_id=i, keep_unkeyed=True)
            states.append({r.v for r in U.read_keyed(spark, target).collect()})
        assert states[0] == states[1] == states[2] == {f"{k}{4 if newest else 1}" for k in (1, 2, 3)} | {"n1", "n2"}


def test_scd2_replay_keeps_the_history(spark):
    target = fresh_dir(spark, "t-scd2-replay")
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 3, "n")], "key int, seq int, val string")
    for _ in range(2):
        U.scd2_apply(spark, target, df, ["key"], F.col("seq"), F.col("seq"), buckets=2, batch_id=1)
    assert U.read_keyed(spark, target).count() == 2 and U.unkeyed(spark, target).count() == 1


CHANGES = [  # key, seq, op, val
    (1, 1, "UPSERT", "a1"), (1, 3, "UPSERT", "a3"), (1, 2, "UPSERT", "a2"),
    (2, 1, "UPSERT", "b1"), (2, 2, "DELETE", None), (2, 0, "UPSERT", "b0-late"),
    (3, 5, "UPSERT", "c5"),
]


def test_scd1_order_independent_with_tombstones(spark):
    df = spark.createDataFrame(CHANGES, "key int, seq int, _op string, val string")
    states = []
    for order in ([0, 1, 2, 3, 4, 5, 6], [6, 5, 4, 3, 2, 1, 0], [2, 5, 0, 6, 3, 1, 4]):
        target = fresh_dir(spark, "t-scd1")
        for i in order:
            U.scd1_apply(spark, target, df.filter(F.col("seq").isNotNull()).limit(7)
                         .where(F.struct("key", "seq") == F.struct(F.lit(CHANGES[i][0]), F.lit(CHANGES[i][1]))),
                         ["key"], F.col("seq"), buckets=4)
        states.append(rows(U.scd1_current(spark, target), "key", "val"))
    assert states[0] == [(1, "a3"), (3, "c5")]
    assert states[0] == states[1] == states[2]


def test_scd2_intervals(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "z")], "key int, seq int, val string")
    target = fresh_dir(spark, "t-scd2")
    U.scd2_apply(spark, target, df.filter("seq <> 2"), ["key"], F.col("seq"), F.col("seq"), buckets=4)
    U.scd2_apply(spark, target, df.filter("seq = 2"), ["key"], F.col("seq"), F.col("seq"), buckets=4)
    got = rows(U.read_keyed(spark, target), "key", "val", "_valid_from", "_valid_to", "_is_current")
    assert got == [(1, "a", 1, 2, False), (1, "b", 2, 3, False), (1, "c", 3, None, True), (2, "z", 1, None, True)]


def test_next_in_order_matches_lead_with_hot_key(spark):
    from pyspark.sql import Window
    # key 0 holds half of all rows: it must be split over several range partitions
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 37).alias("k"),
                                  F.col("id").alias("seq"), (F.col("id") * 10).alias("v"))
    got = U.next_in_order(df, ["k"], "seq", ["v"], partitions=8)
    want = df.withColumn("_next_v", F.lead("v").over(Window.partitionBy("k").orderBy("seq")))
    assert rows(got, "k", "seq", "_next_v") == rows(want, "k", "seq", "_next_v")
    per_part = (df.repartitionByRange(8, "k", "seq").filter(F.col("k") == 0)
                .groupBy(F.spark_partition_id().alias("p")).count().count())
    assert per_part > 1


def test_upsert_one_row_per_key_after_replayed_drops(spark, sf_small):
    from strata.plans import silver as S
    from strata.sources.fixtures import bronze
    target = fresh_dir(spark, "t-upsert-drops")
    b = bronze(spark, sf_small, "tx_raw")
    for d in (0, 1, 1):  # the second drop is applied twice
        valid = S.current_state(S.valid_rows(S.checked(b.filter(F.col("load_no") == d), S.TRANSACTIONS), S.TRANSACTIONS), S.TRANSACTIONS)
        U.upsert(spark, target, valid.drop("_seq"), ["transaction_id"], buckets=8)
    t = U.read_keyed(spark, target)
    assert t.count() == t.select("transaction_id").distinct().count()
    assert t.filter(F.col("transaction_id").isNull()).count() == 0


def test_events_of_a_repeated_run_replace_its_own(spark, tmp_path):
    import datetime as dt

    from strata.plans import observe as O
    path, day = str(tmp_path / "log"), dt.datetime(2024, 1, 1)

    def events(layer, sources, run="r1", at=day, status="SUCCESS"):
        return O.event_rows([{"source_name": s, "status": status, "records": n} for n, s in enumerate(sources)], run, layer, now=at)
    O.append_events(spark, events("bronze", ["a", "b"], status="FAILED"), path)
    O.append_events(spark, events("silver", ["a"]), path)
    O.append_events(spark, events("bronze", ["a"], run="r2"), path)
    O.append_events(spark, events("bronze", ["b", "c"], at=day + dt.timedelta(days=1)), path)  # the run is repeated the next day
    O.append_events(spark, [], path)
    got = sorted((r.pipeline_run_id, r.layer, r.source_name, r.status, r.event_date) for r in O.read_events(spark, path).collect())
    assert got == [("r1", "bronze", "a", "FAILED", day.date()), ("r1", "bronze", "b", "SUCCESS", day.date()), ("r1", "bronze", "c", "SUCCESS", day.date()),
                   ("r1", "silver", "a", "SUCCESS", day.date()), ("r2", "bronze", "a", "SUCCESS", day.date())]


def test_deferred_batches_rewrite_the_table_once_and_are_read_before(spark, tmp_path, monkeypatch):
    t, writes, write = str(tmp_path / "t"), [], U._write_parts
    monkeypatch.setattr(U, "_write_parts", lambda *a: (writes.append(a[2]), write(*a)))

    def put(rows, batch_id):
        df = spark.createDataFrame(rows, "k int, seq int, v string")
        U.keep_one(spark, t, df, ["k"], F.col("seq"), buckets=2, batch_id=batch_id, defer=True)

    def state():
        return sorted((r.k, r.v) for r in U.read_keyed(spark, t).collect())
    put([(1, 1, "a"), (2, 5, "b"), (3, 1, "c")], 0)
    put([(1, 2, "A"), (2, 4, "late"), (4, 1, "d")], 1)
    put([(4, 2, "D"), (None, 1, "x")], 2)
    put([(4, 2, "D")], 2)  # replayed
    whole = [(1, "A"), (2, "b"), (3, "c"), (4, "D")]
    assert writes == [t] and state() == whole
    U.settle(spark, t)
    U.settle(spark, t)
    assert writes == [t, t] and state() == whole and U.pending(spark, t) is None
    assert sorted(r.v for r in U.unkeyed(spark, t).collect()) == ["x"]
    with pytest.raises(ValueError):
        U.keep_one(spark, t, spark.createDataFrame([(1, 1, "a")], "k int, seq int, v string"), ["k"], F.col("seq"), newest=False, defer=True)


def test_a_merge_moves_stored_rows_once(spark, tmp_path):
    home = U.Home(["k"], 4)
    rows = U.housed(spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("seq")), home)
    both = U.together(rows, rows.where("k < 100"), ["k"])
    plan = U._newest(both, ["k"], F.col("seq").desc())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan


def test_whole_ranges_of_partitions_are_read_without_a_join(spark):
    target = fresh_dir(spark, "t-exact")
    U.upsert(spark, target, days(spark, 4), ["k"], buckets=2, part=DAY)

    def read(pairs):
        df = U.read_keyed(spark, target, pairs)
        return "Join" in df._jdf.queryExecution().optimizedPlan().toString(), sorted({(r[U.PART], r[U.BUCKET]) for r in df.collect()})
    every = [(f"2024010{d}", b) for d in (1, 2, 3) for b in (0, 1)]
    assert read(every) == (False, every)
    assert read(every[1:]) == (True, every[1:])
