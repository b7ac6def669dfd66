"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

PACKAGE_PARENT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# Settings every job relies on: AQE for runtime re-planning and skew splits,
# UTC so NTZ <-> LTZ round trips (date_trunc) are exact, no web UI.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # small shuffles (a day's region write) keep several tasks instead of being
    # coalesced into one; no effect once partitions are large
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "gridloom", extra: dict | None = None) -> SparkSession:
    """Local / test session.  On a cluster the launcher supplies master and sizing."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.appName(app_name)
    if master or "PYSPARK_GATEWAY_PORT" not in os.environ:      # set where spark-submit started us
        builder = builder.master(master or f"local[{cpus}]")
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session_defaults(spark)
    return spark


def ensure_session_defaults(spark: SparkSession) -> None:
    """Settings a query needs for exact results, applied to a given session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    # Python workers must find this package too; a cluster without a shared source
    # folder ships it with --py-files
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_PARENT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_PARENT, *paths])


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster (``spark.checkpoint.dir``).

    Only a local master (unit tests, a laptop) without one gets a local folder; elsewhere
    executors would each write to their own disk, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="gridloom-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/gridloom/{name}-{uuid.uuid4().hex[:12]}"
