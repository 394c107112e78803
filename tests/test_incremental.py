"""Counted states, refreshed dimensions and marts that follow changes."""

import random
from datetime import date, datetime
from pathlib import Path

from pyspark.sql import functions as F

from strata.operators import changes as C
from strata.operators import counted as N
from strata.operators import upsert as U
from strata.plans import gold as G
from strata.plans import incremental as I
from strata.plans.jobs import read_wide, wide_path
from strata.sources.stored import remember_schema
from strata.streaming.ingest import Layout


def delta(spark, rows):
    return spark.createDataFrame(rows, f"g string, a string, {N.DELTA} long")


def held(spark, path, **kw):
    return {(r.g, r.a): r[N.COUNT] for r in N.live(spark, path, **kw).collect()}


def test_counts_add_and_subtract_in_any_order_with_replays(spark, tmp_path):
    rng = random.Random(4)
    batches = [[(g, a, rng.choice([1, 2, 3])) for g in ("x", "y", None) for a in ("p", "q", None) if rng.random() < 0.6] for _ in range(3)]
    batches += [[(g, a, -n) for g, a, n in batches[0]]]
    total = {}
    for b in batches:
        for g, a, n in b:
            total[g, a] = total.get((g, a), 0) + n
    total = {k: n for k, n in total.items() if n}
    for k, order in enumerate(([0, 1, 2, 3], [0, 3, 2, 1], [1, 0, 2, 3])):
        path = str(tmp_path / f"s{k}")
        for i in order:
            for _ in range(rng.choice([1, 2, 3])):  # repeated batches count once
                N.apply(spark, path, delta(spark, batches[i]), ["g"], f"b{i}", 5)
        assert held(spark, path) == total


def test_a_batch_applied_to_some_buckets_only_is_finished_by_its_replay(spark, tmp_path, monkeypatch):
    path, rows = str(tmp_path / "s"), [(f"g{i}", "a", 1) for i in range(40)]
    N.apply(spark, path, delta(spark, rows), ["g"], "b0", 8)
    some = [r for r in delta(spark, rows).withColumn("b", N.bucket_of(["g"], 8)).collect() if r.b < 4]
    N.apply(spark, path, delta(spark, [(r.g, r.a, 1) for r in some]), ["g"], "b1", 8)  # as if it had died half way
    N.apply(spark, path, delta(spark, rows), ["g"], "b1", 8)
    assert set(held(spark, path).values()) == {2} and len(held(spark, path)) == 40


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "s")
    N.apply(spark, path, delta(spark, [(f"g{i}", "a", 1) for i in range(40)]), ["g"], "b0", 8)
    before = {p for p in (tmp_path / "s").rglob("*.parquet")}
    touched = N.apply(spark, path, delta(spark, [("g1", "a", -1), ("g1", "b", 1)]), ["g"], "b1", 8)
    after = {p for p in (tmp_path / "s").rglob("*.parquet")}
    assert len(touched) == 1 and {p.parent.name for p in before ^ after} == {f"{N.BUCKET}={touched[0]}"}
    assert held(spark, path, buckets=touched)["g1", "b"] == 1 and ("g1", "a") not in held(spark, path)


# -- gold over small hand-made layers -------------------------------------------------------------

TX = ("transaction_id string, transaction_date date, user_id string, merchant_id string, channel string, amount double, currency string, "
      "transaction_type string, status string, reference_id string, _source_file string, _ingestion_ts timestamp, _seq struct<n:long>")
MER = "merchant_id string, merchant_name string, category string, country string, affiliation_date date, status string, risk_level string"
USR = "user_id string, full_name string, document_id string, email string, phone string, country string, segment string, registration_date date"


class Gold:
    """Silver tables and the accepted feed, filled by hand; ``rebuild`` is the plain full computation."""

    def __init__(self, spark, root):
        self.spark, self.layout, self.n, self.tx, self.dims = spark, Layout(root), 0, {}, {"merchants": {}, "users": {}}

    def dimension(self, name, rows):
        kind, key = (MER, "merchant_id") if name == "merchants" else (USR, "user_id")
        self.n += 1
        df = self.spark.createDataFrame(rows, kind).withColumn("_op", F.lit("UPSERT"))
        U.scd1_apply(self.spark, self.layout.table("silver", name), df, [key], F.struct(F.lit(self.n).alias("n")), buckets=2,
                     batch_id=self.n, changes=True)
        self.dims[name].update({r[0]: r for r in rows})

    def transactions(self, rows):
        self.n += 1
        full = [(t, date(2024, int(t[8:10]), int(t[10:12])), u, m, c, 10.0, "PEN", kind, "aprobado", None, "f",
                 datetime(2024, 1, 1), (self.n,)) for t, u, m, c, kind in rows]
        self.tx.update({r[0]: r for r in full})
        self.spark.createDataFrame(full, TX).write.parquet(f"{self.layout.table('silver', 'transactions_accepted')}/batch_id={self.n}")
        path = self.layout.table("silver", "transactions_accepted")
        remember_schema(self.spark, path, self.spark.createDataFrame([], TX).schema)

    def run(self):
        return I.run_gold_incremental(self.spark, self.layout, buckets=8)

    def rebuild(self):
        s = self.spark
        return G.enrich(s.createDataFrame(list(self.tx.values()), TX), s.createDataFrame(list(self.dims["merchants"].values()), MER),
                        s.createDataFrame(list(self.dims["users"].values()), USR))

    def check(self):
        def plain(df):
            cols = sorted(c for c in df.columns if c not in G.RUN_DEPENDENT)
            return sorted(map(tuple, df.select(*cols).collect()), key=repr)
        whole = self.rebuild()
        assert plain(read_wide(self.spark, self.layout)) == plain(whole)
        for name, build in G.MARTS.items():
            assert plain(I.mart(self.spark, self.layout, name)) == plain(build(whole)), name

    def files(self):
        return {p for p in Path(wide_path(self.layout)).rglob("*.parquet")}


def merchant(k, risk="bajo", name="n"):
    return (f"M{k}", f"{name}{k}", "salud", "PE", None, "activo", risk)


def user(k, segment="nuevo"):
    return (f"U{k}", f"name {k}", str(k), None, None, "PE", segment, None)


def months(k):
    return 1 + k % 3


def test_gold_follows_changes(spark, tmp_path, monkeypatch):
    """One story in steps; after each, the wide table and all marts equal a rebuild."""
    g = Gold(spark, str(tmp_path))
    g.dimension("merchants", [merchant(k) for k in range(5)])
    g.dimension("users", [user(k) for k in range(6)])
    # months are parts of the wide table.  M0 has a third of all rows; M9 and U9 are not known yet; M9 sells in March only
    sold = [(f"TXN-2024{months(k):02d}01-{k:05d}", f"U{k % 6}", "M0" if k % 4 == 0 else "M9" if months(k) == 3 and k % 5 == 0 else f"M{k % 5}",
             ["web", "app", None][k % 3], "pago" if k % 2 else "reversa") for k in range(60)]
    g.transactions([*sold, ("TXN-20240405-00001", "U9", "M1", "web", "pago")])
    assert g.run().new_rows == 61
    g.check()

    # a late dimension row reaches its transactions, and no file of another month changes
    before = g.files()
    g.dimension("merchants", [merchant(9, "alto")])
    run = g.run()
    assert run.new_rows == 0 and run.refreshed_rows == sum(r[2] == "M9" for r in sold) > 0
    assert {p.parent.parent.name for p in before ^ g.files()} == {"_part=202403"}
    assert {r.risk_score for r in read_wide(spark, g.layout).where("merchant_id = 'M9'").collect()} == {60, 75}
    g.check()

    # rows that come again as they were touch nothing
    before = g.files()
    g.dimension("merchants", [merchant(k) for k in range(5)])
    run = g.run()
    assert (run.refreshed_rows, run.changes, g.files()) == (0, 0, before)

    # the only transaction of U9 goes to U1, a new one comes; the marts read no row of the wide table
    g.transactions([("TXN-20240405-00001", "U1", "M1", "web", "pago"), ("TXN-20240501-00007", "U0", "M0", "pos", "pago")])
    real, read = U.read_keyed, []

    def watched(session, path, pairs=None):
        read.append((path, pairs))
        return real(session, path, pairs)
    monkeypatch.setattr(U, "read_keyed", watched)
    run = g.run()
    monkeypatch.undo()
    assert run.changes == 3 and run.buckets["dim_date"] == 1 and run.buckets["dim_user"] <= 3
    assert (wide_path(g.layout), None) not in read
    g.check()
    assert not [r for r in I.mart(spark, g.layout, "dim_user").collect() if r.user_id == "U9"]

    # several dimensions at once, one of them the hot merchant's
    g.dimension("users", [user(9, "premium"), user(1, "premium")])
    g.dimension("merchants", [merchant(0, name="renamed ")])
    assert g.run().refreshed_rows >= 20
    g.check()

    # a mart batch that is applied again changes nothing
    rows = C.read_changes(spark, wide_path(g.layout))
    last = rows.agg(F.max(C.VERSION)).first()[0]
    marts = max(int(p.name) for p in tmp_path.rglob("gold_incremental_marts/commits/*") if p.name.isdigit())
    seen = [v for (v,) in rows.where(F.col(C.VERSION) >= last - 1).select(C.VERSION).distinct().collect()]
    I.apply_changes(spark, g.layout, rows.where(F.col(C.VERSION).isin(seen)), marts, 8)
    g.check()
