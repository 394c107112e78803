"""Session construction and the shared work area.

On a cluster the work area (landing copies, stream checkpoints, stored
tables of the query catalog) lives under the shared folder named by
``spark.checkpoint.dir``.  Only when that setting is absent (local tests)
do we create a private folder and register it as the checkpoint dir.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import SparkSession

ROOT_CONF = "strata.root"
STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
CODEC_CONF = "spark.sql.parquet.compression.codec"
ROCKSDB_STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "strata") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or os.environ.get("STRATA_MASTER", f"local[{cpus}]")
    parts = shuffle_partitions or int(os.environ.get("STRATA_SHUFFLE_PARTITIONS", cpus))
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g"))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Python call-site capture for error messages costs several JVM round trips per
        # Column call; plans here are built from thousands of them.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``strata`` importable in Python workers (``SparkContext.addPyFile``), once per application.

    The package is zipped on the driver, copied to the shared work root (under
    ``spark.checkpoint.dir``) and shipped from there like any ``--py-files``
    archive; nothing is assumed about the workers' paths.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = Path(__file__).resolve().parent
    staging = Path(tempfile.mkdtemp(prefix="strata-pyfiles-")) / "strata.zip"
    with zipfile.ZipFile(staging, "w", zipfile.ZIP_DEFLATED) as zf:
        for f in sorted(pkg.rglob("*.py")):
            zf.write(f, f.relative_to(pkg.parent))
    shared = f"{work_root(spark)}/_pyfiles/{app}/strata.zip"
    jvm = spark._jvm
    dst = jvm.org.apache.hadoop.fs.Path(shared)
    dst.getFileSystem(sc._jsc.hadoopConfiguration()).copyFromLocalFile(
        False, True, jvm.org.apache.hadoop.fs.Path(str(staging)), dst)
    sc.addPyFile(shared)
    _SHIPPED.add(app)


def tune(spark: SparkSession) -> None:
    """Session settings every plan in this library relies on.

    * UTC session time zone: calendar keys must not move with the driver's zone.
    * AQE with a runtime broadcast threshold: a dimension is broadcast only
      after its shuffle output has been measured below the threshold;
      above it the join stays sort-merge (with skew splitting).
    * zstd for stored tables, unless the launcher chose a codec: hashes and raw records take about half the bytes.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    if spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) in (None, ""):
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
    if not spark.sparkContext.getConf().contains(CODEC_CONF):
        spark.conf.set(CODEC_CONF, "zstd")
    # Streaming dedup keeps every key seen: keep that state in RocksDB (off-heap,
    # spills to local disk, checkpointed incrementally) unless the launcher chose a store.
    if not spark.sparkContext.getConf().contains(STATE_STORE_CONF):
        spark.conf.set(STATE_STORE_CONF, ROCKSDB_STATE_STORE)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and stored tables.

    Reads ``spark.checkpoint.dir`` (or an already registered checkpoint dir)
    from the session; sets a private one only when none is configured.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - conf lookup may reject unknown keys
            configured = None
    if not configured:
        current = sc.getCheckpointDir()
        if current:
            # getCheckpointDir returns <dir>/<app-uuid>; keep our tables beside it
            configured = current.rsplit("/", 1)[0]
    if not configured:
        # a private folder is only shared where driver and executors are one process
        if not re.match(r"local(\[[^,\]]*(,\s*\d+)?\])?$", sc.master):
            raise RuntimeError(f"spark.checkpoint.dir is not set (master {sc.master}): stored tables, stream checkpoints and "
                               "lineage cuts need a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
        sc.setCheckpointDir(configured)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def work_root(spark: SparkSession) -> str:
    """Root of this library's stored tables (``strata.root`` or under the checkpoint dir)."""
    root = spark.conf.get(ROOT_CONF, None)
    if not root:
        root = f"{checkpoint_root(spark)}/strata"
        spark.conf.set(ROOT_CONF, root)
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unique directory path under the work root (created lazily by writers)."""
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def side_by_side(tasks: Sequence[Callable], at_once: int = 4) -> list:
    """Run tasks that do not depend on each other in driver threads; their results in order, or the first one's error.

    Small jobs mostly wait (for planning, listings, commits and single tasks); the executors run as many tasks as they have cores for.
    """
    with ThreadPoolExecutor(max(1, min(at_once, len(tasks)))) as pool:
        return [f.result() for f in [pool.submit(t) for t in tasks]]
