"""SparkSession settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings that matter at scale: AQE re-plans joins from runtime sizes,
# splits skewed join partitions and coalesces small shuffle partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # keyed stream state on disk, not in executor memory
    STATE_STORE: ROCKSDB,
    "spark.ui.enabled": "false",
    # plans of finished queries are not kept for a page nobody reads
    "spark.sql.ui.retainedExecutions": "10",
    "spark.ui.retainedJobs": "100",
    "spark.ui.retainedStages": "100",
    "spark.ui.retainedTasks": "1000",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "fraudmart",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the warehouse defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    (local tests) a folder under /tmp is chosen. On a cluster an unset folder
    is an error: executors would not see a machine-local one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = os.path.join("/tmp", "fraudmart-checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streaming queries started inside keep their state in RocksDB, whatever the
    session was built with (``transformWithState`` runs on no other store)."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder (never machine-local
    on a cluster), for written intermediate tables and feed fixtures."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/fraudmart-{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``fraudmart`` importable on the executors (as ``--py-files``
    would): zip the package in memory once per application, write it below
    the shared checkpoint folder and add it to the session. Needed by the few
    operators that run Python on executors (workbook parsing, keyed streaming
    state)."""
    import io
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, names in os.walk(pkg):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(root, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/fraudmart-{uuid.uuid4().hex[:12]}.zip"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(target, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
