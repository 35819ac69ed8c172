"""What a run did, as one record, and the log that such records are appended to."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.StringType()),
        T.StructField("ended_at", T.StringType()),
        T.StructField("duration_seconds", T.DoubleType()),
        T.StructField("total_records", T.LongType()),
        T.StructField("curated_records", T.LongType()),
        T.StructField("bad_records", T.LongType()),
        T.StructField("success_rate_pct", T.DoubleType()),
        T.StructField("failure_rate_pct", T.DoubleType()),
        T.StructField("rejection_reasons", T.MapType(T.StringType(), T.MapType(T.StringType(), T.LongType()))),
    ]
)


def rate(part: int, whole: int) -> float:
    return round(part / whole * 100, 2) if whole else 0.0


@dataclass(frozen=True)
class RunSummary:
    pipeline_name: str
    started: datetime
    ended: datetime
    total_records: int
    curated_records: int
    bad_records: int
    status: str = "SUCCESS"
    rejection_reasons: dict = field(default_factory=dict)

    @classmethod
    def total(cls, name, started, ended, parts: Iterable[RunSummary], status="SUCCESS", reasons=None) -> RunSummary:
        parts = list(parts)
        return cls(
            name,
            started,
            ended,
            sum(p.total_records for p in parts),
            sum(p.curated_records for p in parts),
            sum(p.bad_records for p in parts),
            status,
            reasons or {},
        )

    def record(self) -> dict:
        values = asdict(self)
        started, ended = values.pop("started"), values.pop("ended")
        return {
            **values,
            "started_at": started.strftime("%Y-%m-%d %H:%M:%S"),
            "ended_at": ended.strftime("%Y-%m-%d %H:%M:%S"),
            "duration_seconds": round((ended - started).total_seconds(), 2),
            "success_rate_pct": rate(self.curated_records, self.total_records),
            "failure_rate_pct": rate(self.bad_records, self.total_records),
        }


def summaries_frame(spark: SparkSession, summaries: Iterable[RunSummary]) -> DataFrame:
    records = [s.record() for s in summaries]
    return spark.createDataFrame([tuple(r[f.name] for f in LOG_SCHEMA.fields) for r in records], LOG_SCHEMA)


def append_to_log(spark: SparkSession, path: str, summary: RunSummary) -> None:
    """Append one summary to the run log."""
    summaries_frame(spark, [summary]).coalesce(1).write.mode("append").json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).json(path)
