"""Tables written to the shared folder, to cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master (tests, a laptop); on
    a cluster an unset folder is an error, since executors would write to
    disks that nobody else can read.
    """
    base = spark.conf.get(CONF, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError(f"set {CONF} to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="emporia-llm-")
        spark.conf.set(CONF, base)
    return base.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; every call gives another one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
