"""Change-log writers: envelope records to a broker or to files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidelog.functions.timeparts import now_or
from tidelog.operators.changelog import encode


def broker_rows(changes: DataFrame, payload: T.StructType, now: Column | None = None) -> DataFrame:
    """Rows for the broker sink. Spark cannot set a record's timestamp, so the capture time
    travels as a header; the broker stamps the record itself."""
    captured = F.unix_millis(now_or(now)).cast("string").cast("binary")
    header = F.struct(F.lit("event_timestamp").alias("key"), captured.alias("value"))
    return encode(changes, payload).select("key", "value", F.array(header).alias("headers"))


def file_rows(changes: DataFrame, payload: T.StructType, now: Column | None = None) -> DataFrame:
    """Rows for a log directory: the record, its place in the log and its capture time."""
    return encode(changes, payload).select(
        "value",
        F.col("seq.part").alias("part"),
        # One change gives up to two records: both keep their order.
        (F.col("seq.pos") * 2 + F.col("seq.ord")).alias("pos"),
        F.col("seq.ms").alias("record_ms"),
        F.unix_millis(now_or(now)).alias("captured_ms"),
    )


def log_stream(changes: DataFrame, payload: T.StructType, fmt: str = "json",
               now: Column | None = None, **options: str) -> DataStreamWriter:
    """Write a change stream: ``kafka`` with broker options, or a directory with ``path``."""
    rows = broker_rows(changes, payload, now) if fmt == "kafka" else file_rows(changes, payload, now)
    return rows.writeStream.format(fmt).outputMode("append").options(**options)


def log_batch(changes: DataFrame, payload: T.StructType, fmt: str = "json",
              now: Column | None = None, **options: str) -> None:
    """Write a bounded changelog the same way, in one go."""
    rows = broker_rows(changes, payload, now) if fmt == "kafka" else file_rows(changes, payload, now)
    rows.write.format(fmt).mode("append").options(**options).save()
