"""Session helpers.

``get_session`` is what tests and the bench use.  Library code never creates a
session; it only reads ``spark.checkpoint.dir`` through ``checkpoint_dir``.
"""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "tripsmith") -> SparkSession:
    master = master or os.environ.get("TRIPSMITH_MASTER", "local[8]")
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("TRIPSMITH_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    use_local_checkpoints(spark)
    checkpoint_dir(spark)
    ship_code(spark)
    return spark


def ship_code(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package from any working folder.

    On a cluster the package is installed or given with ``--py-files``, as usual.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().isLocal():
        sc.addFile(str(Path(__file__).resolve().parent), recursive=True)


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder: what is set already, else ``spark.checkpoint.dir``."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS)")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def use_local_checkpoints(spark: SparkSession) -> None:
    """For tests, the bench and local runs: a scratch folder where none is set.

    Only in a session whose executor is the driver itself; a cluster must name a shared folder.
    """
    sc = spark.sparkContext
    unset = not sc.getCheckpointDir() and not sc.getConf().get("spark.checkpoint.dir", None)
    if unset and sc._jsc.sc().isLocal():
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tripsmith-ckpt-"))
