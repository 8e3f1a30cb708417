"""Session helpers.

``build_session`` returns a SparkSession tuned for large scans: adaptive query
execution (runtime re-planning, partition coalescing, skew-join splitting),
size-checked broadcast joins and UTC as the session zone.  Nothing here fixes
the number of executors or the shuffle width for a cluster: those come from
the cluster's own configuration, and AQE sizes shuffle partitions at runtime
from the advisory partition size.

``shared_dir`` names the folder used to cut lineage (``DataFrame.checkpoint``)
and to land tables.  On a cluster it is the folder in ``spark.checkpoint.dir``;
a private folder is only made when the master is local and nothing is set
(tests, the local bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings that are safe to apply to any session (they only steer
# planning).  Static settings such as the UI switch go to the builder.
SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # No broadcast from static estimates: they come from compressed file sizes
    # (a table can be ten times larger in memory) and, without CBO, from
    # inflated join/union estimates, which can make a fact side look smaller
    # than its dimension.  AQE converts a join to a broadcast only when the
    # measured shuffle output of one side is below the bound.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


# Sizing for inputs of tens of terabytes on about a thousand executors: many
# initial shuffle partitions that AQE merges down to ~256 MB each, scan splits
# of 256 MB, and a skew threshold that only fires on really large partitions.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def build_session(
    master: str | None = None,
    app: str = "salesmart",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
    profile: str = "local",
) -> SparkSession:
    """Create (or reuse) a session with the settings above (``profile="cluster"``
    adds the large-input sizing of ``CLUSTER_CONF``)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    conf = dict(SQL_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    elif profile != "local":
        raise ValueError("profile must be 'local' or 'cluster'")
    for key, value in conf.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and landed tables.

    It is the folder that ``spark.checkpoint.dir`` names, itself and not the
    per-application folder below it, so what is landed there outlives the
    session.  Where the setting is absent, a checkpoint folder that the session
    already has is used, and only on a local master (every task sees the same
    disk) is a private folder made under the system temp folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.master.startswith("local") and configured.startswith("file:"):
            raise RuntimeError("spark.checkpoint.dir must name shared storage, not a machine's own folder")
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a folder on shared storage "
            "(HDFS, object store) that every executor can read"
        )
    folder = tempfile.mkdtemp(prefix="salesmart-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def table_path(spark: SparkSession, name: str) -> str:
    """Location of a named table inside the shared folder; the same in each session."""
    return os.path.join(shared_dir(spark), "tables", name)


def own_path(spark: SparkSession, name: str) -> str:
    """A new location inside the shared folder, so that no call overwrites what another still reads."""
    return os.path.join(shared_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
