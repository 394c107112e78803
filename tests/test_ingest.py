"""Streaming ingestion: two drops, reruns, corrupt split, evolution modes, repair, isolation."""

import json
import os

import pytest
from pyspark.sql import functions as F

from strata.catalog_ingest import Area, BROKEN_SPECS
from strata.operators import upsert as U
from strata.plans.bronze import repair_bad_users, reset_source
from strata.sources import landing as L
from strata.sources.spec import parse_specs
from strata.sources.stored import children
from strata.streaming.ingest import Layout, finish_overwrite, ingest_all, ingest_source, read_table


def test_two_drops_incremental_and_rerun(spark, sf_small):
    a = Area(spark, "t-two-drops")
    spec = a.specs["transactions"]
    a.land(spark, sf_small, "transactions", 0)
    r0 = ingest_source(spark, spec, a.layout)
    a.land(spark, sf_small, "transactions", 1)
    r1 = ingest_source(spark, spec, a.layout)
    r2 = ingest_source(spark, spec, a.layout)  # nothing new
    assert (r0.status, r1.status, r2.status) == ("SUCCESS",) * 3
    assert r0.records == 1500 and r1.records == 150 and r2.records == 0
    t = a.table(spark, "transactions")
    assert t.count() == 1650
    assert sorted(r[0] for r in t.select("_batch_id").distinct().collect()) == ["0", "1"]


def test_corrupt_rows_go_to_bad_records_and_repair_once(spark, sf_small):
    a = Area(spark, "t-corrupt")
    spec = a.specs["users"]
    for d in (0, 1):
        a.land(spark, sf_small, "users", d)
    res = ingest_source(spark, spec, a.layout)
    assert res.status == "SUCCESS" and res.records_failed > 0
    _, _, bad = a.layout.spec_paths(spec)
    bad_df = spark.read.json(bad)
    assert bad_df.count() == res.records_failed
    assert set(bad_df.columns) >= {"record", "path", "reason"}
    fixed1 = repair_bad_users(spark, spec, a.layout)
    fixed2 = repair_bad_users(spark, spec, a.layout)
    assert fixed1 > 0 and fixed2 == 0
    assert a.table(spark, "users").filter(F.col("_source_file") == bad).count() == fixed1


def test_evolution_fail_and_isolation(spark, sf_small):
    a = Area(spark, "t-isolation", merchants={"schema_evolution_mode": "fail"})
    a.land(spark, sf_small, "transactions", 0)
    a.land(spark, sf_small, "merchants", 2, extra_key="contact_email")
    broken = [s for s in parse_specs(BROKEN_SPECS % {"l": a.landing}) if s.active]
    results = {r.source_name: r for r in ingest_all(spark, [a.specs["transactions"], *broken,
                                                          a.specs["merchants"]], a.layout)}
    assert results["transactions"].status == "SUCCESS"
    assert results["merchants"].status == "FAILED" and "contact_email" in results["merchants"].error
    assert all(results[s.source_name].status == "FAILED" for s in broken)


def test_json_object_root_and_lines(spark, tmp_path):
    from strata.sources.files import good_rows, read_source
    from strata.sources.spec import SourceSpec
    (tmp_path / "one.json").write_text(json.dumps({"id": "1", "name": "x"}))
    (tmp_path / "two.json").write_text(json.dumps([{"id": "2"}, {"id": "3", "name": "z", "extra": 1}]))
    (tmp_path / "bad.json").write_text("{not json")
    (tmp_path / "empty.json").write_text("[]")
    spec = SourceSpec("j", str(tmp_path), "json", (("id", "string"), ("name", "string")))
    df = read_source(spark, spec).cache()
    assert sorted(r.id for r in good_rows(df).select("id").collect()) == ["1", "2", "3"]
    assert df.filter(F.col("_corrupt_record").isNotNull()).count() == 1
    lines = tmp_path / "lines"
    lines.mkdir()
    (lines / "a.json").write_text('{"id": "4"}\n{"id": "5"}\n')
    spec2 = SourceSpec("l", str(lines), "json", (("id", "string"),), multiline=False)
    assert good_rows(read_source(spark, spec2)).select("id").count() == 2


def test_reset_then_reingest(spark, sf_small):
    a = Area(spark, "t-reset")
    spec = a.specs["transactions"]
    a.land(spark, sf_small, "transactions", 0)
    ingest_source(spark, spec, a.layout)
    assert set(reset_source(spark, spec, a.layout).values()) == {"OK"}
    again = ingest_source(spark, spec, a.layout)
    assert again.records == 1500 and a.table(spark, "transactions").count() == 1500


def test_count_bad_records(spark, sf_small, tmp_path):
    from strata.plans.bronze import count_bad_records
    assert count_bad_records(spark, str(tmp_path / "missing")) == 0
    a = Area(spark, "t-badcount")
    spec = a.specs["users"]
    a.land(spark, sf_small, "users", 0)
    res = ingest_source(spark, spec, a.layout)
    assert count_bad_records(spark, a.layout.spec_paths(spec)[2]) == res.records_failed > 0


def test_load_mode_streaming_runs_until_stopped(spark, sf_small):
    a = Area(spark, "t-streaming", transactions={"load_mode": "streaming", "trigger_interval": "1 second"})
    a.land(spark, sf_small, "transactions", 0)
    res = ingest_source(spark, a.specs["transactions"], a.layout)
    assert res.status == "RUNNING" and res.query.isActive
    res.query.processAllAvailable()
    res.query.stop()
    assert a.table(spark, "transactions").count() == 1500


# --- batches, order, replays -------------------------------------------------------------------------------


def csv_source(path, name="t", **kw):
    from strata.sources.spec import SourceSpec
    return SourceSpec(name, str(path), "csv", (("k", "string"), ("v", "string")), primary_key=("k",), **kw)


def put(path, name, text, mtime=None):
    path.mkdir(exist_ok=True)
    (path / name).write_text(text)
    if mtime:
        os.utime(path / name, (mtime, mtime))


def stored(spark, tmp_path, spec, **kw):
    layout = Layout(f"file://{tmp_path}/lake")
    res = ingest_source(spark, spec, layout, **kw)
    assert res.status == "SUCCESS", res.error
    return res, read_table(spark, layout.spec_paths(spec)[0])


def test_overwrite_keeps_every_batch_of_its_run(spark, tmp_path):
    land = tmp_path / "in"
    spec = csv_source(land, write_mode="overwrite")
    for i in range(3):
        put(land, f"a{i}.csv", f"k,v\n{i},x\n")
    res, t = stored(spark, tmp_path, spec, max_files_per_trigger=1)
    assert res.records == 3 == t.count() and len(res.batches) == 3
    for i in range(2):
        put(land, f"b{i}.csv", f"k,v\n1{i},y\n")
    _, t = stored(spark, tmp_path, spec, max_files_per_trigger=1)
    assert sorted(r.k for r in t.collect()) == ["10", "11"]
    _, t = stored(spark, tmp_path, spec)  # nothing new: the table stays
    assert t.count() == 2


def test_overwrite_run_that_died_keeps_its_committed_batches(spark, tmp_path):
    target = f"file://{tmp_path}/t"
    for i in range(4):
        spark.range(1).write.parquet(f"{target}/_batch_id={i}")
    finish_overwrite(spark, target, [0])       # run 1 ended with batch 0
    finish_overwrite(spark, target, [3])       # run 2 died after 1 and 2 and went on with 3
    assert sorted(p.name for p in (tmp_path / "t").glob("_batch_id=*")) == ["_batch_id=1", "_batch_id=2", "_batch_id=3"]


def test_malformed_rows_leave_before_dedup(spark, tmp_path):
    land = tmp_path / "in"
    put(land, "a.csv", "k,v\n1,a\n1,b,surplus\n2,c,surplus\n2,d\n,n1\n,n2\n")
    res, t = stored(spark, tmp_path, csv_source(land, deduplication_mode="drop_duplicates"))
    assert (res.records, res.records_failed) == (4, 2)
    assert sorted((r.k or "", r.v) for r in t.collect()) == [("", "n1"), ("", "n2"), ("1", "a"), ("2", "d")]


@pytest.mark.parametrize("mode", [{"write_mode": "merge"}, {"deduplication_mode": "latest_record"}])
def test_file_time_decides_not_the_name(spark, tmp_path, mode):
    land = tmp_path / "in"
    put(land, "t_9.csv", "k,v\n1,old\n", 1_700_000_000)
    put(land, "t_10.csv", "k,v\n1,new\n", 1_700_000_100)
    _, t = stored(spark, tmp_path, csv_source(land, **mode), max_files_per_trigger=1)
    assert [r.v for r in t.collect()] == ["new"]


def test_declared_timestamp_decides_over_file_time(spark, tmp_path):
    from strata.sources.spec import SourceSpec
    land = tmp_path / "in"
    put(land, "a.csv", "k,v,at\n1,new,2024-02-02 00:00:00\n", 1_700_000_000)
    put(land, "b.csv", "k,v,at\n1,old,2024-01-01 00:00:00\n", 1_700_000_100)
    spec = SourceSpec("t", str(land), "csv", (("k", "string"), ("v", "string"), ("at", "timestamp")), primary_key=("k",),
                      deduplication_mode="latest_record")
    _, t = stored(spark, tmp_path, spec)
    assert [r.v for r in t.collect()] == ["new"]


def test_scd2_bronze_replay(spark, tmp_path):
    land = tmp_path / "in"
    put(land, "a.csv", "k,v\n1,a\n2,b\n")
    spec = csv_source(land, write_mode="scd2", load_mode="batch")
    for _ in range(2):
        _, t = stored(spark, tmp_path, spec, batch_id=1)
    assert t.count() == 2


def test_csv_headers_bind_by_name(spark, tmp_path):
    land = tmp_path / "in"
    put(land, "a.csv", "k,v\n1,a\n")
    put(land, "b.csv", "V,k,extra\nb,2,e\n")
    put(land, "c.csv", "k,v,K\n3,c,clash\n")
    _, t = stored(spark, tmp_path, csv_source(land))
    assert sorted((r.k, r.v, r.extra) for r in t.collect()) == [("1", "a", None), ("2", "b", "e"), ("3", "c", None)]
    assert [json.loads(r._rescued_data) for r in t.where("k = '3'").collect()] == [{"K": "clash"}]
    res, t = stored(spark, tmp_path, csv_source(land, name="rescue", schema_evolution_mode="rescue"))
    assert res.records == 3 and t.where("_rescued_data is not null").count() == 2
    bad = ingest_source(spark, csv_source(land, name="fail", schema_evolution_mode="fail"), Layout(f"file://{tmp_path}/lake"))
    assert bad.status == "FAILED" and "extra" in bad.error


def test_data_used_as_keys_is_refused(spark, tmp_path):
    from strata.sources.spec import SourceSpec
    land = tmp_path / "in"
    put(land, "a.json", json.dumps([{"id": "1", **{f"user{i}": "x" for i in range(20)}}]))
    spec = SourceSpec("j", str(land), "json", (("id", "string"),), max_new_columns=10)
    res = ingest_source(spark, spec, Layout(f"file://{tmp_path}/lake"))
    assert res.status == "FAILED" and "max_new_columns" in res.error


# --- control plane ------------------------------------------------------------------------------------------


def test_selected_source_runs_alone_from_the_setting(spark, sf_small):
    from strata.plans.jobs import SOURCE_CONF, run_bronze
    a = Area(spark, "t-select")
    a.land(spark, sf_small, "users", 0)
    spark.conf.set(SOURCE_CONF, "USERS")
    try:
        results = run_bronze(spark, list(a.specs.values()), a.layout)
    finally:
        spark.conf.unset(SOURCE_CONF)
    assert [(r.source_name, r.status) for r in results] == [("users", "SUCCESS")]


def test_running_stream_is_no_failure_and_is_logged(spark, sf_small):
    from strata.plans.jobs import event_log_path, run_bronze
    a = Area(spark, "t-running", transactions={"load_mode": "streaming", "trigger_interval": "1 second"})
    a.land(spark, sf_small, "transactions", 0)
    results = run_bronze(spark, [a.specs["transactions"]], a.layout, raise_on_failure=True)
    results[0].query.stop()
    assert results[0].as_dict()["status"] == "RUNNING"
    assert [r.status for r in spark.read.parquet(event_log_path(a.layout)).collect()] == ["RUNNING"]


def test_register_refuses_what_is_not_its_own(spark, tmp_path):
    from strata.plans.tables import TableConflict, register_table
    spark.sql("CREATE DATABASE IF NOT EXISTS t_conflict")
    spark.sql("DROP TABLE IF EXISTS t_conflict.people")
    spark.range(5).write.saveAsTable("t_conflict.people")
    spark.range(2).write.parquet(f"{tmp_path}/a")
    spark.range(2).write.parquet(f"{tmp_path}/b")
    with pytest.raises(TableConflict):
        register_table(spark, "t_conflict", "people", f"{tmp_path}/a")
    assert spark.table("t_conflict.people").count() == 5
    spark.sql("DROP TABLE t_conflict.people")
    for _ in range(2):
        register_table(spark, "t_conflict", "people", f"{tmp_path}/a")
    with pytest.raises(TableConflict):
        register_table(spark, "t_conflict", "people", f"{tmp_path}/b")
    spark.sql("DROP TABLE t_conflict.people")


def test_registered_table_has_evolved_columns_and_survives_a_reset(spark, tmp_path):
    from strata.plans.bronze import reset_sources
    from strata.plans.tables import register_table
    land = tmp_path / "in"
    spec = csv_source(land, name="evolving", target_schema="t_reset")
    spark.sql("DROP TABLE IF EXISTS t_reset.evolving")
    put(land, "a.csv", "k,v\n1,a\n")
    layout = Layout(f"file://{tmp_path}/lake")
    ingest_source(spark, spec, layout)
    put(land, "b.csv", "k,v,extra\n2,b,e\n")
    ingest_source(spark, spec, layout)
    register_table(spark, "t_reset", "evolving", layout.spec_paths(spec)[0])
    assert sorted((r.k, r.extra) for r in spark.sql("SELECT k, extra FROM t_reset.evolving").collect()) == [("1", None), ("2", "e")]
    assert reset_sources(spark, [spec], layout) == [("evolving", "OK", 0, 0)]
    assert spark.sql("SELECT * FROM t_reset.evolving").count() == 0
    spark.sql("DROP TABLE t_reset.evolving")


def test_required_columns_are_checked_on_write(spark):
    from strata.plans.tables import SILVER, not_null
    df = spark.createDataFrame([("MCH-00001",), (None,)], "merchant_id string")
    with pytest.raises(Exception, match="must not be NULL"):
        not_null(df, SILVER["merchants"]).collect()


def test_quarantine_ids_are_unique_and_stable(spark, sf_small):
    from strata.plans.jobs import quarantine_path, run_bronze, run_silver
    from strata.sources.stored import read_stored
    a = Area(spark, "t-quarantine")
    land = f"{a.landing}/users"
    line = "usr1|n|d|e|p|PE|vip|2019-03-04"
    text = spark.createDataFrame([("|".join(L.USR_COLUMNS),), (line,), (line,)], "value string").coalesce(1)
    L.write_text(spark, land, "users", 0, "txt", text)
    run_bronze(spark, [a.specs["users"]], a.layout)
    run_silver(spark, a.layout, sources=("users",), buckets=2)
    ids = [r[0] for r in read_stored(spark, quarantine_path(a.layout)).select("quarantine_id").collect()]
    assert len(ids) == len(set(ids)) == 2


def test_one_namespace_setting(spark):
    from strata.plans.tables import use_namespace
    use_namespace(spark, "t_namespace")
    try:
        assert spark.catalog.currentDatabase() == "t_namespace"
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_private_checkpoint_folder_only_in_one_process():
    import re
    source = open("strata/session.py").read()
    pattern = re.search(r're\.match\(r"(.*?)", sc\.master\)', source).group(1)
    assert all(re.match(pattern, m) for m in ("local", "local[8]", "local[*]", "local[4, 3]"))
    assert not any(re.match(pattern, m) for m in ("local-cluster[3,2,1024]", "yarn", "spark://h:7077", "k8s://x"))


def test_newest_rows_of_small_batches_are_merged_once_a_run(spark, tmp_path, monkeypatch):
    """One file a micro-batch: the table is written by the first batch and by the end of each run, also of a run that dies."""
    writes, write = [], U._write_parts
    monkeypatch.setattr(U, "_write_parts", lambda s, df, path, *rest: (writes.append(path), write(s, df, path, *rest)))
    text = """[{"source_name": "newest", "source_path": "%s", "file_pattern": "tx_*.csv", "file_format": "csv", "header": true, "active": true,
      "primary_key": ["k"], "deduplication_mode": "latest_record",
      "schema": [{"column_name": "k", "data_type": "string"}, {"column_name": "n", "data_type": "string"}]}]"""
    spec, layout = parse_specs(text % (tmp_path / "landing"))[0], Layout(str(tmp_path))

    def land(n, lines):
        path = tmp_path / "landing" / f"tx_{n}.csv"
        path.parent.mkdir(exist_ok=True)
        path.write_text("\n".join(["k,n", *lines]) + "\n")
        os.utime(path, (1_700_000_000 + n, 1_700_000_000 + n))

    def ingest():
        return ingest_source(spark, spec, layout, max_files_per_trigger=1)

    def rows():
        got = read_table(spark, layout.spec_paths(spec)[0]).collect()
        assert len(got) == len({r.k for r in got})
        return {r.k: r.n for r in got}
    for n in range(5):
        land(n, [f"k{k},{n}" for k in range(n, n + 3)])
    assert ingest().status == "SUCCESS" and len(writes) == 2
    assert rows() == {"k0": "0", "k1": "1", "k2": "2", "k3": "3", "k4": "4", "k5": "4", "k6": "4"}
    land(5, ["k0,5"])
    land(6, ["k1,6"])
    real = U._defer

    def dies(s, target, rows, batch_id):
        if batch_id == 6:
            raise RuntimeError("died")
        real(s, target, rows, batch_id)
    monkeypatch.setattr(U, "_defer", dies)
    assert ingest().status == "FAILED" and rows()["k0"] == "5" and rows()["k1"] == "1"
    monkeypatch.setattr(U, "_defer", real)
    assert ingest().status == "SUCCESS" and rows()["k1"] == "6" and len(writes) == 4


def test_no_layer_keeps_its_batch_in_the_executors_memory(spark, sf_small, monkeypatch):
    """Bronze, silver and gold stage a batch as files; no rows are persisted, and no staged files stay."""
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    from strata.catalog_ingest import Area
    from strata.plans.incremental import run_gold_incremental
    from strata.plans.jobs import read_wide, run_bronze, run_gold, run_silver
    from strata.session import work_root
    kept, real, before = [], Frame.persist, set(children(spark, work_root(spark)))
    monkeypatch.setattr(Frame, "persist", lambda df, *level: (kept.append(df.columns), real(df, *level))[1])
    a = Area(spark, "no-persist")
    for source in ("transactions", "merchants", "users"):
        a.land(spark, sf_small, source, 0)
    run_bronze(spark, list(a.specs.values()), a.layout, raise_on_failure=True)
    run_silver(spark, a.layout, buckets=1, raise_on_failure=True)
    run_gold(spark, a.layout, buckets=1)
    assert kept == [] and read_wide(spark, a.layout).count() > 0
    assert {n.rsplit("-", 1)[0] for n in set(children(spark, work_root(spark))) - before} == {"no-persist"}


def test_sources_run_side_by_side(spark, tmp_path):
    """Two sources wait for each other: in turn they would not end."""
    import threading

    from strata.session import side_by_side
    gate = threading.Barrier(2, timeout=60)
    assert side_by_side([lambda n=n: (gate.wait(), n)[1] for n in range(2)]) == [0, 1]
    with pytest.raises(ZeroDivisionError):
        side_by_side([lambda: 1 / 0, lambda: 1])
