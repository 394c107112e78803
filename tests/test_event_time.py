"""Event-time streams: late rows, restarts, state that ends."""

import datetime as dt

from pyspark.sql import functions as F

from strata.sources.stored import path_exists
from strata.streaming import event_time as V

SCHEMA = "event_id long, user_id long, event_type string, ts timestamp"
T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


class Feed:
    def __init__(self, spark, root, build, schema=SCHEMA):
        self.spark, self.root, self.build, self.schema, self.n = spark, str(root), build, schema, 0

    def drop(self, rows):
        """Land rows, then run a new stream on the old checkpoint; returns the rows that this run gave out."""
        self.n += 1
        df = self.spark.createDataFrame(rows, self.schema)
        df.coalesce(1).write.parquet(f"{self.root}/in/d{self.n}")
        before = self.rows()
        V.drain(self.build(V.event_stream(self.spark, f"{self.root}/in", df.schema)), f"{self.root}/out", f"{self.root}/ckpt")
        after = self.rows()
        for r in before:
            after.remove(r)
        return sorted(after, key=repr)

    def rows(self):
        return list(map(tuple, self.spark.read.parquet(f"{self.root}/out").collect())) if path_exists(self.spark, f"{self.root}/out/_spark_metadata") else []


def test_dedup_forgets_after_the_delay_and_drops_late_rows(spark, tmp_path):
    f = Feed(spark, tmp_path, lambda s: V.dedup_bounded(s, ["event_id"], "ts", "1 hour").select("event_id", "ts"))
    assert f.drop([(1, 1, "a", at(0)), (1, 1, "a", at(0)), (2, 1, "a", at(2))]) == [(1, at(0)), (2, at(2))]
    # watermark 1:00 - event 2 is remembered, event 1 (kept until 1:00) is not; a row at 0:30 is late
    assert f.drop([(2, 1, "a", at(2.5)), (3, 1, "a", at(0.5)), (1, 1, "a", at(3)), (None, 1, "a", at(3))]) == [(1, at(3)), (None, at(3))]
    assert f.drop([(1, 1, "a", at(3.2)), (4, 1, "a", at(9))]) == [(4, at(9))]


def test_tumbling_windows_close_once_and_late_rows_go(spark, tmp_path):
    f = Feed(spark, tmp_path, lambda s: V.tumbling(s, "ts", "1 hour", "1 hour", ["event_type"], F.count(F.lit(1)).alias("n")))
    assert f.drop([(1, 1, "a", at(0.1)), (2, 1, "a", at(0.9)), (3, 1, "b", at(2.5))]) == [(at(0), at(1), "a", 2)]
    # watermark 1:30: 0:xx is closed, 1:40 is not, 1:10 belongs to an open window and counts though it is behind the watermark
    assert f.drop([(4, 1, "a", at(0.5)), (5, 1, "a", at(1.6)), (6, 1, "a", at(1.1)), (7, 1, "b", at(4.2))]) == [
        (at(1), at(2), "a", 2), (at(2), at(3), "b", 1)]
    assert f.drop([(8, 1, "b", at(2.9)), (9, 1, None, at(9))]) == [(at(4), at(5), "b", 1)]


def test_sessions_grow_over_drops(spark, tmp_path):
    f = Feed(spark, tmp_path, lambda s: V.sessions(s, "ts", "1 hour", "2 hours", ["user_id"], F.count(F.lit(1)).alias("n")))
    assert f.drop([(1, 1, "a", at(0)), (2, 1, "a", at(0.5)), (3, 2, "a", at(0)), (4, 1, "a", at(2.5))]) == []
    assert f.drop([(5, 1, "a", at(1.4)), (6, 2, "a", at(4))]) == [(at(0), at(1), 2, 1)]  # 1.4 joins 0.5; 0.5 + 1.4 end at 2.4 > 2
    assert f.drop([(7, 3, "a", at(9))]) == [(at(0), at(2.4), 1, 3), (at(2.5), at(3.5), 1, 1), (at(4), at(5), 2, 1)]


def test_velocity_in_event_time_order_over_restarts(spark, tmp_path):
    f = Feed(spark, tmp_path, lambda s: V.velocity_alerts(s, 3, 3600, "1 hour"))
    assert f.drop([(1, 1, "a", at(0.8)), (2, 1, "a", at(0.1)), (3, 2, "a", at(0)), (4, 2, "a", at(1.5))]) == []
    # 0.5 comes after 0.8, within the delay: the third event within an hour is the one at 0.8
    assert f.drop([(5, 1, "a", at(0.6)), (6, 1, "a", at(1.0)), (7, 9, "a", at(3))]) == [(1, at(0.8), 3, at(0.1))]
    # the run of user 1 goes on to 1.9 without a second alert; after a pause a new run is reported anew
    assert f.drop([(8, 1, "a", at(t)) for t in (2.05, 5, 5.1, 5.2)] + [(9, 2, "a", at(9))]) == [(1, at(5.2), 3, at(5))]
    assert f.drop([(10, 1, "a", at(5.3)), (11, 2, "a", at(20))]) == []  # late


def test_reversals_meet_payments_on_either_side_of_a_restart(spark, tmp_path):
    rev, pay = "reversal_id long, reference_id long, reversed_at timestamp", "payment_id long, paid_at timestamp"

    def land(name, n, rows, schema):
        df = spark.createDataFrame(rows, schema)
        df.write.parquet(str(tmp_path / name / f"d{n}"))
        return df.schema

    seen = set()
    for n, (r, p, given) in enumerate([
        ([(10, 1, at(24)), (11, 2, at(30)), (12, 9, at(30)), (13, None, at(30))], [(1, at(0)), (3, at(40))], {(10, 1)}),
        ([(14, 3, at(41)), (15, 1, at(150))], [(2, at(29)), (2, at(31)), (4, at(150))], {(11, 2), (14, 3), (12, None), (13, None)}),  # 31 is after the reversal
        ([(16, 4, at(900))], [(5, at(900))], {(15, None)})]):
        rs, ps = land("rev", n, r, rev), land("pay", n, p, pay)
        V.drain(V.match_back(V.event_stream(spark, str(tmp_path / "rev"), rs), V.event_stream(spark, str(tmp_path / "pay"), ps), "reference_id", "payment_id",
                             "reversed_at", "paid_at", "2 DAYS", "1 day"), str(tmp_path / "out"), str(tmp_path / "ckpt"))
        now = {(x.reversal_id, x.payment_id) for x in spark.read.parquet(str(tmp_path / "out")).collect()}
        assert now - seen == given
        seen = now
