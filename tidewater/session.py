"""Session factory and the shared scratch folder.

Defaults are chosen for a large cluster; local runs override the partition
count.  Nothing here overrides a setting the cluster already made.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every job relies on; applied only where the session has no value.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # checkpoint RocksDB state as changelogs instead of full snapshots each batch
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, app_name: str = "tidewater",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build or fetch a session with the library's defaults.

    ``master``/``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset so the cluster's values stand.
    """
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidewater`` importable by the Python workers.

    Stateful processors and the named-part writer are pickled by reference,
    so workers import this package.  When it is not installed on the nodes
    (a source checkout), it is zipped once per application and shipped with
    ``addPyFile``, Spark's ``--py-files`` mechanism.
    """
    import os
    import zipfile
    try:
        sc = spark.sparkContext
    except Exception:  # a remote session: the package must be installed there
        return
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    if os.path.basename(os.path.dirname(pkg)) in ("site-packages", "dist-packages"):
        _SHIPPED.add(sc.applicationId)
        return
    target = os.path.join(tempfile.mkdtemp(prefix="tidewater-pyfiles-"), "tidewater.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def apply_defaults(spark: SparkSession) -> None:
    """Set the library defaults on an existing session for every key the
    cluster's configuration does not set itself, and ship the package to the
    Python workers."""
    ship_package(spark)
    try:
        cluster = spark.sparkContext.getConf()
    except Exception:  # a remote session: only runtime settings are visible
        cluster = None
    for k, v in DEFAULTS.items():
        if cluster is not None and cluster.contains(k):
            continue
        if k == "spark.sql.streaming.stateStore.providerClass":
            # list/map state needs RocksDB; replace only Spark's built-in default
            cur = spark.conf.get(k, None)
            if cur and not cur.endswith("HDFSBackedStateStoreProvider"):
                continue
        try:
            spark.conf.set(k, v)
        except Exception:  # pragma: no cover - a static setting, fixed at startup
            pass


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder named by ``spark.checkpoint.dir``.

    Lineage cuts, drained stream results and streaming checkpoints go here.
    Only a local master, whose executors share the driver's disk, gets a local
    folder where the session names none; on a cluster that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote session has no SparkContext: the conf must name the folder
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return base.rstrip("/")
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidewater-shared-")
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/tidewater/{name}-{uuid.uuid4().hex}"
