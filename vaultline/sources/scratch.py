"""Intermediate tables in the folder that all executors share.

Writing an intermediate result cuts its lineage: losing an executor costs nothing that was
already written.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local session without one gets a temporary folder."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="vaultline-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/vaultline/{name}-{uuid.uuid4().hex}"


# Files of several partitions are written side by side, so rows need not be sorted first.
CONCURRENT_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_partitioned(frame: DataFrame, path: str, *columns: str) -> None:
    """Write by a few partition values without sorting the rows by them.

    A session that leaves the setting at none gets eight writers a task and keeps them: tables are
    written side by side, and changing it back would reach the others.
    """
    conf = frame.sparkSession.conf
    if int(conf.get(CONCURRENT_WRITERS)) < 1:
        conf.set(CONCURRENT_WRITERS, "8")
    frame.write.partitionBy(*columns).mode("overwrite").parquet(path)


def keep(frame: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write the frame to the shared folder and return it as a scan of what was written."""
    spark = frame.sparkSession
    path = new_folder(spark, name)
    if partition_by:
        write_partitioned(frame, path, *partition_by)
    else:
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
