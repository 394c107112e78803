"""Change frames of keyed tables: differences, replays, crashes, streams."""

import pytest
from pyspark.sql import functions as F

from strata.operators import changes as C
from strata.operators import upsert as U

KV = "k long, v string"


def feed(spark, target, *columns):
    return sorted((tuple(r[c] for c in (C.VERSION, C.CHANGE, *columns)) for r in C.read_changes(spark, target).collect()), key=repr)


def put(spark, target, rows, batch_id, schema=KV, **kw):
    U.upsert(spark, target, spark.createDataFrame(rows, schema), ["k"], buckets=4, batch_id=batch_id, changes=True, **kw)


def table(spark, target):
    return {r.k: r.v for r in U.read_keyed(spark, target).collect()}


def test_inserts_updates_and_rows_that_stay(spark, tmp_path):
    t = str(tmp_path / "t")
    put(spark, t, [(1, "a"), (2, "b"), (3, None)], "b0")
    put(spark, t, [(1, "a"), (2, "B"), (3, "c"), (4, "d")], "b1")
    assert feed(spark, t, "k", "v") == sorted([
        (1, "insert", 1, "a"), (1, "insert", 2, "b"), (1, "insert", 3, None),
        (2, "insert", 4, "d"), (2, "update_before", 2, "b"), (2, "update_after", 2, "B"),
        (2, "update_before", 3, None), (2, "update_after", 3, "c")], key=repr)
    assert {r[C.BATCH] for r in C.read_changes(spark, t, after_version=1).collect()} == {"b1"}


def test_a_replay_counts_once(spark, tmp_path):
    t = str(tmp_path / "t")
    for batch_id, rows in (("b0", [(1, "a")]), ("b1", [(1, "b")]), ("b1", [(1, "b")])):
        put(spark, t, rows, batch_id)
    assert feed(spark, t, "k", "v") == [(1, "insert", 1, "a"), (2, "update_after", 1, "b"), (2, "update_before", 1, "a")]


@pytest.mark.parametrize("where", ["record", "table"])
def test_a_batch_that_dies_is_in_the_feed_once(spark, tmp_path, monkeypatch, where):
    t = str(tmp_path / "t")
    put(spark, t, [(k, "a") for k in range(20)], "b0")
    rows = [(k, "b") for k in range(10, 30)]

    def dies(*_):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(C, "record", dies) if where == "record" else m.setattr(U, "_write_parts", dies)
        with pytest.raises(OSError):
            put(spark, t, rows, "b1")
    assert table(spark, t) == {k: "a" for k in range(20)}
    put(spark, t, rows, "b1")
    put(spark, t, rows, "b1")
    got = [(kind, k) for v, kind, k in feed(spark, t, "k") if v == 2]
    assert sorted(got) == sorted([("insert", k) for k in range(20, 30)] + [(x, k) for k in range(10, 20) for x in (C.BEFORE, C.AFTER)])
    assert table(spark, t) == {k: "a" if k < 10 else "b" for k in range(30)}


def test_a_folder_without_its_end_is_not_read_and_is_written_anew(spark, tmp_path):
    t = str(tmp_path / "t")
    put(spark, t, [(1, "a")], "b0")
    folder = next(p for p in (tmp_path / "t_changes").iterdir() if p.name.endswith("-b0"))
    (folder / "_SUCCESS").unlink()
    assert C.read_changes(spark, t).count() == 0 and not C.recorded(spark, t, "b0")
    put(spark, t, [(2, "b")], "b1")
    assert [x[2] for x in feed(spark, t, "k")] == [2]


def test_tombstones_and_late_changes(spark, tmp_path):
    t = str(tmp_path / "t")

    def apply(rows, batch_id):
        df = spark.createDataFrame(rows, "k long, v string, s long, _op string")
        U.scd1_apply(spark, t, df, ["k"], F.struct("s"), buckets=4, batch_id=batch_id, changes=True)
    apply([(1, "a", 5, "UPSERT"), (2, "b", 5, "UPSERT"), (3, None, 5, "DELETE")], 0)
    apply([(1, "old", 4, "UPSERT"), (2, None, 6, "DELETE"), (3, "c", 6, "UPSERT"), (4, None, 1, "DELETE")], 1)
    apply([(2, "again", 7, "UPSERT"), (3, None, 7, "DELETE"), (3, None, 8, "DELETE")], 2)
    assert feed(spark, t, "k", "v") == sorted([
        (1, "insert", 1, "a"), (1, "insert", 2, "b"), (2, "delete", 2, "b"), (2, "insert", 3, "c"),
        (3, "insert", 2, "again"), (3, "delete", 3, "c")], key=repr)


def test_a_column_that_comes_later_changes_nothing_by_being_absent(spark, tmp_path):
    t = str(tmp_path / "t")
    put(spark, t, [(1, "a"), (2, "b")], "b0")
    put(spark, t, [(1, "a", None), (2, "b", "x")], "b1", "k long, v string, w string")
    assert [x for x in feed(spark, t, "k", "w") if x[0] == 2] == [(2, "update_after", 2, "x"), (2, "update_before", 2, None)]


def test_a_table_can_begin_to_keep_changes_and_then_does(spark, tmp_path):
    t = str(tmp_path / "t")
    U.upsert(spark, t, spark.createDataFrame([(1, "a"), (2, "b")], KV), ["k"], buckets=4, batch_id="x")
    assert C.read_changes(spark, t) is None
    put(spark, t, [(1, "a"), (2, "c")], "b0")
    U.upsert(spark, t, spark.createDataFrame([(2, "d")], KV), ["k"], buckets=4, batch_id="b1")  # stored with the table
    assert feed(spark, t, "k", "v") == [(1, "update_after", 2, "c"), (1, "update_before", 2, "b"),
                                        (2, "update_after", 2, "d"), (2, "update_before", 2, "c")]


def test_more_partitions_than_are_listed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(U, "LISTED", 2)
    t = str(tmp_path / "t")
    put(spark, t, [(k, "a") for k in range(50)], "b0")
    put(spark, t, [(k, "b") for k in range(30, 60)], "b1")
    assert table(spark, t) == {k: "a" if k < 30 else "b" for k in range(60)}
    assert len(feed(spark, t, "k")) == 50 + 10 + 40
    assert not isinstance(U.touched(U.housed(spark.createDataFrame([(k, "a") for k in range(50)], KV), U.stored_home(spark, t))), list)


def test_the_feed_as_a_stream_over_restarts(spark, tmp_path):
    t, seen = str(tmp_path / "t"), []
    for batch_id, rows in (("b0", [(1, "a")]), ("b1", [(1, "b"), (2, "x")])):
        put(spark, t, rows, batch_id)
        for _ in range(2):
            (C.stream_changes(spark, t).writeStream.foreachBatch(lambda df, _: seen.extend(map(tuple, df.select(C.CHANGE, "k", "v").collect())))
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination())
    assert sorted(seen) == [("insert", 1, "a"), ("insert", 2, "x"), ("update_after", 1, "b"), ("update_before", 1, "a")]


def test_a_replay_of_a_finished_batch_rewrites_nothing(spark, tmp_path, monkeypatch):
    t = str(tmp_path / "t")
    put(spark, t, [(1, "a"), (2, "x")], "b0")
    put(spark, t, [(1, "b")], "b1")
    monkeypatch.setattr(U, "_write_parts", lambda *_: pytest.fail("rewritten"))
    put(spark, t, [(1, "b")], "b1")
    assert table(spark, t) == {1: "b", 2: "x"} and len(feed(spark, t, "k")) == 4


def test_rows_of_other_keys_stay_out_of_the_exchange(spark, tmp_path, monkeypatch):
    t, own, moved = str(tmp_path / "t"), U.together, []

    def spy(current, incoming, keys):
        moved.append(current and current.count())
        return own(current, incoming, keys)
    monkeypatch.setattr(U, "together", spy)
    put(spark, t, [(k, "a") for k in range(2000)], "b0")
    put(spark, t, [(k, "b") for k in range(1990, 2010)], "b1")
    assert 10 <= moved[-1] < 400
    assert table(spark, t) == {k: "a" if k < 1990 else "b" for k in range(2010)}
    assert sorted(x[1] for x in feed(spark, t, "k") if x[0] == 2) == sorted(["insert"] * 10 + [C.BEFORE] * 10 + [C.AFTER] * 10)


@pytest.mark.parametrize("marks", [1 << 15, 0])
def test_a_batch_too_large_for_the_bitmap(spark, tmp_path, monkeypatch, marks):
    monkeypatch.setattr(U, "MARKS", marks)
    t = str(tmp_path / "t")
    put(spark, t, [(k, "a") for k in range(6000)], "b0")
    put(spark, t, [(k, "b") for k in range(1000, 7000)], "b1")
    assert table(spark, t) == {k: "a" if k < 1000 else "b" for k in range(7000)}
    assert len(feed(spark, t, "k")) == 6000 + 1000 + 10_000


def test_a_first_batch_that_lies_well_is_written_as_it_lies(spark, tmp_path, monkeypatch):
    own, dealt = U._write_parts, []
    monkeypatch.setattr(U, "_write_parts", lambda spark, df, path, d=False: (dealt.append(d), own(spark, df, path, d)))
    monkeypatch.setattr(U, "FILE_ROWS", 10)
    df = spark.range(400).selectExpr("id AS k", "'a' AS v")
    U.upsert(spark, str(tmp_path / "one"), df.coalesce(2), ["k"], buckets=1, batch_id="b0", changes=True)
    U.upsert(spark, str(tmp_path / "many"), df.repartition(200), ["k"], buckets=4, batch_id="b0", changes=True)
    assert dealt == [True, False]
    assert U.read_keyed(spark, str(tmp_path / "one")).count() == U.read_keyed(spark, str(tmp_path / "many")).count() == 400


def test_changes_are_told_where_the_rows_of_a_key_lie(spark):
    """Stored and incoming rows cross one exchange and meet in no join; every kind of change, and of none, is told."""
    home, kind = U.Home(["k"], 4, "k % 2", changes=True), "k int, n int, v string, _op string"
    stored = [(1, 1, "a", "UPSERT"), (2, 1, "b", "UPSERT"), (3, 1, "c", "UPSERT"), (4, 1, None, "DELETE"), (5, 1, "e", "UPSERT"), (6, 1, None, "DELETE"),
              (9, 1, "i", "UPSERT")]
    batch = [(1, 2, "A", "UPSERT"), (2, 2, None, "DELETE"), (3, 0, "late", "UPSERT"), (4, 2, "d", "UPSERT"), (5, 1, "e", "UPSERT"), (6, 2, None, "DELETE"),
             (7, 1, "g", "UPSERT"), (8, 1, None, "DELETE")]
    old, new = (C.with_hash(U.housed(spark.createDataFrame(r, kind), home)) for r in (stored, batch))
    newest = F.row_number().over(U._per_key(["k"]).orderBy(F.col("n").desc())) == 1
    for current, want in ((old, {(1, "a", C.BEFORE), (1, "A", C.AFTER), (2, "b", C.DELETED), (4, "d", C.INSERT), (7, "g", C.INSERT)}),
                          (None, {(1, "A", C.INSERT), (3, "late", C.INSERT), (4, "d", C.INSERT), (5, "e", C.INSERT), (7, "g", C.INSERT)})):
        told = U._with_change(U.together(current, new, ["k"]).withColumn(U.KEPT, newest), ["k"]).where(F.col(C.CHANGE).isNotNull())
        assert {(r.k, r.v, r[C.CHANGE]) for r in told.collect()} == want
        plan = told._jdf.queryExecution().executedPlan().toString()
        assert plan.split("Initial Plan")[-1].count("Exchange") == 1 and "Join" not in plan
