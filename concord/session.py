"""SparkSession helpers.

The library never hard-codes cluster settings: production jobs bring their own
session. ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "concord") -> SparkSession:
    """A local session: no UI, loopback bind, AQE on, UTC, a private checkpoint dir."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CONCORD_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="concord-warehouse-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is;
    if it is unset there, this raises. Only a local session (tests, bench) gets a
    private folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        # On a cluster a machine-local folder is wrong: executors could not read it back.
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="concord-ckpt-", dir="/tmp"))
    return sc.getCheckpointDir()
