"""Spark session builder and shared-storage helpers.

On a cluster the session already exists and its configuration wins: we only
fill in settings that are unset. Scratch output (snapshots, stream
checkpoints, landing folders) goes under ``spark.checkpoint.dir`` so every
executor sees it and it survives executor loss; a local folder is chosen
only when nothing is configured, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings we rely on; applied only where the session leaves them unset.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lakeforge") -> SparkSession:
    """Return the active session, or build a local one for tests and benches."""
    active = SparkSession.getActiveSession()
    if active is not None:
        configure(active)
        return active
    builder = (
        SparkSession.builder.appName(app_name)
        .master(master or os.environ.get("LAKEFORGE_MASTER", "local[8]"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LAKEFORGE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Apply DEFAULTS where unset and make sure a checkpoint dir is known.

    The session time zone is always UTC: epoch conversions, text formatting
    of timestamps and event-time windows are defined in UTC here."""
    for k, v in DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset everywhere (a bare local
    test session) do we pick a folder and register it with the context.
    """
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="lakeforge-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def listing(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that Spark reads; none if it is missing."""
    fs, p = _hadoop(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def sizes_in(spark: SparkSession, path: str) -> dict[str, int]:
    """Names and sizes of the files in a folder, by one listing."""
    fs, p = _hadoop(spark, path)
    return {s.getPath().getName(): s.getLen() for s in fs.listStatus(p) if s.isFile()}


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def scratch_root(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint dir."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
