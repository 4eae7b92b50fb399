"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators rely on; a cluster session should carry the same.
DEFAULT_CONF = {
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

# Settings for a large cluster (1000 executors, ~100 TB input). Shuffle
# partitions are an upper bound that AQE coalesces to ~256 MB each; hot join
# partitions are split by AQE; broadcasts happen only below the measured
# threshold. ``spark.checkpoint.dir`` must name shared storage (HDFS/S3).
CLUSTER_CONF = {
    **{k: v for k, v in DEFAULT_CONF.items() if k != "spark.ui.enabled"},
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
}


def object_store_conf(endpoint: str, path_style: bool = True, ssl: bool = False) -> dict[str, str]:
    """Session settings for an S3-compatible object store at ``endpoint``
    (host[:port]); paths are then plain ``s3a://bucket/key`` URIs.

    Credentials are deliberately not part of this: the cluster's credential
    provider chain (instance roles, environment, credential files) supplies
    them, so none appear in code or job arguments.
    """
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "chainscope") -> SparkSession:
    """Local session for tests and the bench; clusters build their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("CHAINSCOPE_DRIVER_MEMORY", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we only
    pick a folder of our own when none is configured and the session runs in
    local mode (tests, bench). A cluster without one is an error: a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3) for iterative operators")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="chainscope-ckpt-"))
    return sc.getCheckpointDir()
