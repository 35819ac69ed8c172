"""A session with the settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Windows and replay ids of streams are kept on disk, not in the executors' heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # HotSpot never compiles a method over 8000 bytes; wide rule projections can exceed that.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(name: str = "vaultline", master: str | None = None, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``, then the given ones (dots in names written as ``__``)."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
