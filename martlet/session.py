"""SparkSession construction and shared-storage helpers.

Every job in the package takes a ``SparkSession``; this module only builds
one for tests, the bench and the command line, and answers "where may I put
intermediate data" from the session itself.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that make the plans in this package behave as designed at scale:
# AQE re-plans joins from runtime sizes (a broadcast only happens when the
# measured side is under the threshold), splits skewed shuffle partitions of
# joins, and coalesces tiny partitions; the session clock is UTC so date
# arithmetic is reproducible.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    # Selective joins (recent orders, high-value customers, changed keys) build
    # a runtime Bloom filter that prunes the big side before its shuffle; the
    # filter itself is capped by maxNumBits, so a large creation side is safe.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# The subset of DEFAULT_CONF that can be set on a running session.
RUNTIME_SQL_CONF = {k: v for k, v in DEFAULT_CONF.items()
                    if k.startswith("spark.sql.") and k != "spark.sql.files.maxPartitionBytes"}

def apply_sql_defaults(spark: SparkSession) -> None:
    """Set the package's SQL settings on a session where they are not set.

    Settings the session (or cluster) already carries are left alone; the
    session time zone is the exception only when unset - results are defined
    in UTC.
    """
    for k, v in RUNTIME_SQL_CONF.items():
        if spark.conf.get(k, None) is None:   # None: not set by anyone
            spark.conf.set(k, v)


def build_session(master: str | None = None, app_name: str = "martlet",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` is only given for local runs; on a cluster the launcher sets it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        # Local runs: bind the driver to loopback so large results are not lost.
        builder = builder.config("spark.driver.host", "127.0.0.1") \
                         .config("spark.driver.bindAddress", "127.0.0.1")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; it is only read here. When it is unset (local tests) a private
    folder is created and registered once.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="martlet-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return spark.sparkContext.getCheckpointDir() or current


_scratch: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/martlet-{name}-{uuid.uuid4().hex[:12]}"
    app = spark.sparkContext.applicationId
    if app not in _scratch:
        _scratch[app] = []
        atexit.register(release_scratch, spark)
    _scratch[app].append(path)
    return path


def release_scratch(spark: SparkSession) -> None:
    """Delete the session's scratch folders; frames that read them are then void. Runs when the driver ends."""
    sc = spark.sparkContext
    if sc._jsc is None:      # already stopped
        return
    for path in _scratch.pop(sc.applicationId, []):
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def local_cpus() -> int:
    return int(os.environ.get("BENCH_CPUS", "8"))
