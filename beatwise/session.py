"""Session construction and shared-storage locations."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the analyses assume; everything else is left to the cluster.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


# Additional settings for large clusters (``get_session(cluster=True)``):
# many initial shuffle partitions that AQE coalesces to ~256 MB each, scan
# splits of 256 MB, and joins broadcast only from sizes measured at run time
# (the static, estimate-based broadcast is off).
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8192",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
}


# Temporary folders of local sessions, by application.
_local_folders: dict[str, str] = {}


def get_session(master: str | None = None, app_name: str = "beatwise",
                shuffle_partitions: int | None = None, cluster: bool = False,
                **conf: str) -> SparkSession:
    """Build (or reuse) a session with AQE and skew-join handling switched on.

    ``cluster=True`` adds ``CLUSTER_CONF``; keyword settings override both.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    base = {**DEFAULT_CONF, **(CLUSTER_CONF if cluster else {})}
    for key, value in {**base, **conf}.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` must name shared storage; it is used
    as is.  Only a session whose executors live in this process (master
    ``local`` or ``local[n]``) gets a private temporary folder when it is
    unset; any other raises, since a folder of one machine is not seen by the
    others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local_folders:
        _local_folders[sc.applicationId] = tempfile.mkdtemp(prefix="beatwise-ckpt-")
    return _local_folders[sc.applicationId]


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/staging/{name}-{uuid.uuid4().hex}"


def write_staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table under the shared checkpoint location and read it back.

    Cuts the lineage: a lost executor costs only the tasks that ran on it.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
