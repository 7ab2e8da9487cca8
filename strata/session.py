"""Session settings the library relies on, and the shared scratch folder.

Everything time-related is computed in UTC: ``spark.sql.session.timeZone`` is pinned
so that casts between ``timestamp`` and ``timestamp_ntz`` are wall-clock identities.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every strata job expects (fixed values).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # Remove reliable checkpoint files once their DataFrames are garbage (tree walks
    # and staged reads would otherwise leave one folder per level and run).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Settings for a large cluster (fixed values; pass as ``build_session(conf=CLUSTER_CONF)``
# or in spark-defaults).  Shuffles start wide and AQE coalesces them to ~256 MB
# partitions; hot partitions of joins and rebalances are split; input splits are
# 256 MB; streaming state lives in RocksDB instead of executor heaps.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "strata", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULT_CONF, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone to UTC (idempotent)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach; it is only
    read here, and a cluster session without it is an error (a machine-local
    folder would scatter staged data over the executors' own disks).  When it is
    unset in local mode (a laptop or a test) a local folder is made and registered
    as the checkpoint directory, so ``DataFrame.checkpoint`` works too.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if root is None:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root and sc is not None:
            sc.setCheckpointDir(root)
    if root is None:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "local")
        if not str(master).startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="strata-")
        if sc is not None:
            sc.setCheckpointDir(root)
    return root.rstrip("/")


def default_parallelism(spark: SparkSession) -> int:
    """Task slots of the session (``defaultParallelism``; 8 if it cannot be read)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        return int(spark.conf.get("spark.default.parallelism", "8"))


_MADE: list[str] = []


def new_scratch(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the scratch root for one run of one job."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _MADE.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders this process has made; the number of folders removed.

    Results that still read from them become unreadable, so call it at the end of a run,
    when everything wanted has been written.  Folders go through the Hadoop file system
    Spark wrote them with; a session without a JVM gateway leaves them.
    """
    if getattr(spark, "_jsc", None) is None:
        return 0
    removed, conf = 0, spark._jsc.hadoopConfiguration()
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        removed += bool(path.getFileSystem(conf).delete(path, True))
    return removed


def object_store_conf(endpoint: str, region: str | None = None, path_style: bool = True) -> dict[str, str]:
    """``spark.hadoop.fs.s3a.*`` settings for an S3-compatible store.

    Only the endpoint and addressing are set; credentials come from Hadoop's default
    provider chain (environment variables, instance profile), never from code.
    """
    conf = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(endpoint.startswith("https")).lower(),
    }
    if region:
        conf["spark.hadoop.fs.s3a.endpoint.region"] = region
    return conf


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries built and run within leave no shuffle files: they go when the query ends, not when
    the driver happens to collect its garbage.  (Should a frame run twice, its shuffles are computed again.)"""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``strata`` importable in the Python workers (as ``--py-files`` would).

    Python code that runs on executors (the paged source and its page getters) is
    looked up by module name there.  The package is zipped once per process and
    added to the SparkContext, which distributes it to every executor.  Sessions
    without a SparkContext (Spark Connect) rely on the package being installed.
    """
    try:
        sc = spark.sparkContext
    except Exception:
        return
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="strata-pyfiles-")
    archive = shutil.make_archive(os.path.join(folder, "strata"), "zip",
                                  root_dir=os.path.dirname(package), base_dir=os.path.basename(package))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
