"""Rows in the shape of each output table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.functions.timeparts import cdc_ts, now_or, partition_date, zoneless
from tidelog.operators.changelog import CHANGE_COLUMNS, leaving


def _with_capture_columns(rows: DataFrame) -> DataFrame:
    at = zoneless(F.col("event_timestamp"))
    return rows.withColumns({
        "event_timestamp": at, "cdc_ts": cdc_ts(at), "partition_date": partition_date(at),
    })


def devices_raw(devices: DataFrame) -> DataFrame:
    return _with_capture_columns(devices).select(*schemas.DEVICES_RAW)


def readings_raw(readings: DataFrame) -> DataFrame:
    rows = readings.withColumnRenamed("timestamp", "reading_timestamp")
    return _with_capture_columns(rows).select(*schemas.READINGS_RAW)


def enriched_raw(enriched: DataFrame) -> DataFrame:
    return _with_capture_columns(enriched).select(*schemas.ENRICHED_RAW)


def devices_by_day(changes: DataFrame, now: Column | None = None, keep_old_days: bool = False) -> DataFrame:
    """Device changes with the day they belong to; key (device_id, partition_date).

    An update counts as delete + create, as in the written log: the row of the image before it goes,
    also on another day. With ``keep_old_days`` that row stays.
    """
    day = partition_date(F.col("updated_at"), F.col("created_at"), zoneless(now_or(now)))
    changes = changes if keep_old_days else leaving(changes)
    rows = changes.withColumn("partition_date", day).withColumnRenamed("_id", "mongo_id")
    return rows.select(*CHANGE_COLUMNS, *schemas.DEVICES_BY_DAY)


def with_reading_day(changes: DataFrame, now: Column | None = None, keep_old_days: bool = False) -> DataFrame:
    """Reading changes that have an id, with the day they belong to.

    Updates as in :func:`devices_by_day`. An image without id has no key and is left out; the image before
    it names the row that goes.
    """
    day = partition_date(F.col("timestamp"), F.col("updated_at"), F.col("created_at"), zoneless(now_or(now)))
    changes = changes if keep_old_days else leaving(changes)
    return changes.where(F.col("reading_id").isNotNull()).withColumn("partition_date", day)


def readings_by_day(changes: DataFrame, now: Column | None = None, keep_old_days: bool = False) -> DataFrame:
    """Reading changes in table shape; key (reading_id, partition_date)."""
    rows = with_reading_day(changes, now, keep_old_days)
    rows = rows.withColumnsRenamed({"_id": "mongo_id", "timestamp": "reading_timestamp"})
    return rows.select(*CHANGE_COLUMNS, *schemas.READINGS_BY_DAY)
