"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the marts rely on. AQE re-plans joins and partition counts from
# runtime sizes; the skew-join split protects the fan-out joins.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Static: skips capturing a Python call site per Column call, which costs
    # several JVM round trips each while plans are built on the driver.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "kpimart") -> SparkSession:
    """Return a session with the engine's defaults (used by tests and bench)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir``; only when the cluster names none
    on a local master is a scratch folder created, as driver and executors
    are one process there. Elsewhere a folder of the driver's own would be
    lost to the executors, so this raises.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not d and not (sc.master.startswith("local") and not sc.master.startswith("local-cluster")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        d = _LOCAL_DIRS.get(id(sc)) or tempfile.mkdtemp(prefix="kpimart-ckpt-")
        _LOCAL_DIRS[id(sc)] = d
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


_LOCAL_DIRS: dict[int, str] = {}


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)
