"""Operators on transaction events. All but the sinks work on batch and streaming frames alike.

An event is ``transaction_id, account_id, amount, channel, type`` and, where time matters, ``ts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.sources import commits
from vaultline.sources.commits import CommitLog

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("account_id", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("channel", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

# The amount from which an event is flagged, and the names of the verdicts.
HIGH_VALUE = 10000.0
HIGH, INVALID, NORMAL = "HIGH_VALUE_TRANSACTION_ALERT", "INVALID_ZERO_OR_NEGATIVE_AMOUNT", "NORMAL"


def read_stream(spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet",
                files_per_trigger: int | None = None) -> DataFrame:
    """Events from files as they arrive. A bound on files per trigger bounds a micro-batch."""
    reader = spark.readStream.schema(schema).format(format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def _verdict(high_value: float) -> Column:
    amount = F.coalesce(F.col("amount"), F.lit(0.0))
    return F.when(amount >= high_value, HIGH).when(amount <= 0, INVALID).otherwise(NORMAL)


def flag_events(events: DataFrame, high_value: float = HIGH_VALUE) -> DataFrame:
    """Judge each event by its amount alone; a missing amount counts as zero."""
    return (
        events.withColumn("risk_reason", _verdict(high_value))
        .withColumn("is_flagged", F.col("risk_reason") != NORMAL)
        .withColumn("stream_processed_at", F.current_timestamp())
    )


def stream_summary(flagged: DataFrame) -> DataFrame:
    """``(processed, clean, flagged)`` in one row."""
    return flagged.agg(
        F.count("*").alias("processed"),
        F.count_if(~F.col("is_flagged")).alias("clean"),
        F.count_if("is_flagged").alias("flagged"),
    )


def route_events(flagged: DataFrame, path: str, checkpoint: str):
    """Write clean and flagged events to two folders of one sink, each event exactly once."""
    return (
        flagged.writeStream.format("parquet")
        .partitionBy("is_flagged")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def read_routes(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Both routes; a filter on ``is_flagged`` reads the files of one route only."""
    return spark.read.schema(schema).parquet(path)


def _windowed(events: DataFrame, keys: tuple[str, ...], length: str, slide: str | None, late: str) -> DataFrame:
    events = events.withWatermark("ts", late) if events.isStreaming else events
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    money = F.col("amount").cast("decimal(15,2)")
    return (
        events.groupBy(window.alias("w"), *keys)
        .agg(F.count("*").alias("events"), F.sum(money).alias("amount"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            *keys,
            "events",
            "amount",
        )
    )


def tumbling(events: DataFrame, keys: tuple[str, ...] = ("channel",), length: str = "5 minutes",
             late: str = "10 minutes") -> DataFrame:
    """Events and amount per window and key. State is dropped once the watermark passes a window."""
    return _windowed(events, keys, length, None, late)


def sliding(events: DataFrame, keys: tuple[str, ...] = ("channel",), length: str = "5 minutes",
            slide: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    return _windowed(events, keys, length, slide, late)


def velocity_alerts(events: DataFrame, min_events: int, min_amount: float | None = None,
                    length: str = "5 minutes", slide: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Windows in which one account acts too often, or moves too much."""
    windows = sliding(events, ("account_id",), length, slide, late)
    alert = F.col("events") >= min_events
    if min_amount is not None:
        alert = alert | (F.col("amount") >= F.lit(min_amount).cast("decimal(25,2)"))
    return windows.where(alert)


def drop_replays(events: DataFrame, key: str = "transaction_id", late: str = "10 minutes") -> DataFrame:
    """Keep one event per id. A replay is recognised while the watermark holds the first."""
    if not events.isStreaming:
        return events.dropDuplicates([key])
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark([key])


def append_sink(frame: DataFrame, path: str, checkpoint: str):
    """Results that never change once emitted, to Parquet files, exactly once."""
    return (
        frame.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def bursts(events: DataFrame, min_events: int, gap: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """One row per burst: events of one account of which each follows the one before within ``gap``.

    ``burst_start`` and ``burst_end`` are those of the first and the last event. A stream gives a burst once, when the watermark has passed its
    end by ``gap``; then its state is dropped. Late events of a burst that was given are not counted.
    """
    events = events.withWatermark("ts", late) if events.isStreaming else events
    found = events.groupBy(F.session_window("ts", gap).alias("w"), "account_id").agg(
        F.count("*").alias("events"),
        F.sum(F.col("amount").cast("decimal(15,2)")).alias("amount"),
        F.min("ts").alias("first"),
        F.max("ts").alias("last"),
    )
    return found.where(F.col("events") >= min_events).select(
        "account_id",
        F.col("first").cast("timestamp_ntz").alias("burst_start"),
        F.col("last").cast("timestamp_ntz").alias("burst_end"),
        "events",
        "amount",
    )


#: After so many micro-batches an update sink writes the current value of all keys anew.
FOLD_EVERY = 100
#: States of so many micro-batches before the last stay readable.
KEPT_STATES = 10


def _latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row of each key with the greatest ``batch``."""
    values = [c for c in rows.columns if c not in (*keys, "batch")]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return latest.select(*[F.col(f"v.{c}").alias(c) if c in values else F.col(c) for c in rows.columns if c != "batch"])


def _written(spark: SparkSession, path: str, schema: T.StructType, batches: list[int]) -> DataFrame:
    """The rows of micro-batches, with the ``batch`` that wrote them."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    if not batches:
        return spark.createDataFrame([], full)
    folders = [f"{path}/data/batch={number}" for number in batches]
    return spark.read.schema(full).option("basePath", f"{path}/data").parquet(*folders)


def update_sink(
    frame: DataFrame, path: str, checkpoint: str, keys: list[str], fold_every: int = FOLD_EVERY, kept: int = KEPT_STATES
):
    """Changed result rows of each micro-batch to a folder of its own, and a record of which folders count.

    A record is written when its micro-batch is, so a reader never meets half of one; a micro-batch that runs again
    after its record is skipped, one without a record replaces its folder. A path belongs to one checkpoint: from another one, whose
    micro-batches would be numbered anew, the query fails. Every ``fold_every``-th writes the current value of all keys, and its
    record names that folder alone. Folders that none of the last ``kept`` records names are removed.
    """
    schema, path = frame.schema, path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = CommitLog(spark, f"{path}/log")
        last = log.last()
        record = log.read(last) if last else {"batches": [], "checkpoint": checkpoint}
        if record["checkpoint"] != checkpoint:
            raise ValueError(f"{path} holds results of the checkpoint {record['checkpoint']}")
        if last > batch_id:
            return
        batches = record["batches"]
        if batches and batch_id % fold_every == 0:
            before = _written(spark, path, schema, batches)
            batch, batches = _latest(before.unionByName(batch.withColumn("batch", F.lit(batch_id))), keys), []
        batch.write.mode("overwrite").parquet(f"{path}/data/batch={batch_id}")
        log.commit(batch_id, {"batches": [*batches, batch_id], "checkpoint": checkpoint})
        _retire(spark, path, log, batch_id, kept)

    return (
        frame.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def _retire(spark: SparkSession, path: str, log: CommitLog, batch_id: int, kept: int) -> None:
    """Remove the records before the last ``kept``, and the folders that only they name."""
    numbers = log.numbers()
    old, rest = numbers[:-kept], numbers[-kept:]
    if not old:
        return
    named = set(log.read(rest[0])["batches"]) | {number - 1 for number in rest}
    for number in old:
        log.forget(number)
    for name in commits.names(spark, f"{path}/data"):
        written = name.partition("=")[2]
        if written.isdigit() and int(written) < batch_id and int(written) not in named:
            commits.remove(spark, f"{path}/data/{name}")


def read_updates(spark: SparkSession, path: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The current value of every key: the row its latest micro-batch wrote, of those that were recorded."""
    path = path.rstrip("/")
    log = CommitLog(spark, f"{path}/log")
    last = log.last()
    return _latest(_written(spark, path, schema, log.read(last)["batches"] if last else []), keys)
