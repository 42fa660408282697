"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings a job wants on any cluster: adaptive execution re-plans joins,
# coalesces small shuffle partitions and splits skewed ones at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.ui.enabled": "false",
}


def get_session(
    master: str | None = None,
    app: str = "emporia",
    shuffle_partitions: int | None = None,
    time_zone: str = "UTC",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    ``master`` is left to spark-submit when None.  The session time zone is
    pinned so that date boundaries do not depend on the host.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    settings["spark.sql.session.timeZone"] = time_zone
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3) folder and
    is used as is.  A fresh temporary folder is made only for a local master
    (tests, a laptop); elsewhere an unset folder is an error, since executors
    would write to disks that nobody else can read.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if sc_dir:
        return sc_dir
    if not conf_dir:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="emporia-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return spark.sparkContext.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else f"{base.rstrip('/')}/{name}"
