"""Readings joined with their devices.

``device_id`` is not unique among device documents, so a join on it fans out. Append
outputs keep every pair; keyed outputs keep one device per ``device_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.classify import severity
from tidelog.functions.timeparts import now_or, zoneless
from tidelog.operators.changelog import AFTER_UPDATE, DELETE, current_state

# Column of the joined row -> column of the device row / of the reading row.
_DEVICE_SIDE = {
    "device_mongo_id": "mongo_id", "device_id": "device_id", "device_name": "device_name",
    "device_type": "device_type", "location": "location", "building": "building",
    "floor_level": "floor_level", "area_type": "area_type",
    "temperature_threshold": "temperature_threshold", "installed_date": "installed_date",
    "device_status": "status", "device_battery": "battery_level",
}
_READING_SIDE = {
    "reading_mongo_id": "mongo_id", "reading_id": "reading_id", "sensor_value": "sensor_value",
    "unit": "unit", "quality": "quality", "reading_timestamp": "timestamp",
    "reading_battery": "battery_level",
}
JOINED_COLUMNS = [
    "device_mongo_id", "reading_mongo_id", "device_id", "device_name", "device_type", "location",
    "building", "floor_level", "area_type", "temperature_threshold", "installed_date",
    "device_status", "device_battery", "reading_id", "sensor_value", "unit", "quality", "severity",
    "reading_timestamp", "reading_battery", "event_timestamp",
]


def device_columns(devices: DataFrame) -> DataFrame:
    return devices.select(
        *[F.col(source).alias(name) for name, source in _DEVICE_SIDE.items()],
        F.col("event_timestamp").alias("device_event_timestamp"),
    )


def reading_columns(readings: DataFrame) -> DataFrame:
    return readings.select(
        F.col("device_id"),
        *[F.col(source).alias(name) for name, source in _READING_SIDE.items()],
        F.col("event_timestamp").alias("reading_event_timestamp"),
    )


def classified(joined: DataFrame, event_timestamp: Column) -> DataFrame:
    return joined.withColumns({
        "severity": severity(F.col("sensor_value"), F.col("temperature_threshold")),
        "event_timestamp": event_timestamp,
    })


def capture_time() -> Column:
    return F.coalesce("reading_event_timestamp", "device_event_timestamp")


def enrich_append(devices: DataFrame, readings: DataFrame) -> DataFrame:
    """Every (device, reading) pair with the same ``device_id``.

    The output takes readings only, so this is an inner join; both join inputs keep
    just the rows that can match. A device that owns a third of the readings makes one
    big shuffle partition, which adaptive execution splits: nothing follows the join
    that would need its partitioning.
    """
    known = reading_columns(readings.where(F.col("reading_id").isNotNull()))
    joined = known.join(device_columns(devices), "device_id", "inner")
    return classified(joined, capture_time()).select(*JOINED_COLUMNS)


def devices_with_readings(devices: DataFrame, readings: DataFrame) -> DataFrame:
    """The pairs, and the devices that have no reading (batch only).

    Written as inner join plus anti join: an outer join cannot split the readings of
    a hot device over tasks, an inner join can. The anti join needs only the distinct
    ids of the readings, which the partial aggregate reduces before the exchange.
    """
    device_side, reading_side = device_columns(devices), reading_columns(readings)
    pairs = reading_side.join(device_side, "device_id", "inner")
    silent = device_side.join(readings.select("device_id").distinct(), "device_id", "left_anti")
    rows = pairs.unionByName(silent, allowMissingColumns=True)
    return classified(rows, capture_time()).select(*JOINED_COLUMNS)


def enrich_within(devices: DataFrame, readings: DataFrame, ttl_seconds: int = 7200) -> DataFrame:
    """Pairs whose event times lie at most ``ttl_seconds`` apart: bounded join state, in event time.

    Time is cut into slots of that length. A device row is sent to its own slot and both
    neighbours, a reading to its own, and the join runs on (device, slot). So the rows
    compared are those close in time, not all rows of a device, and one device's history
    spreads over many tasks.
    """
    width = ttl_seconds * 1_000_000

    def slot(c: str) -> Column:
        return F.floor(F.unix_micros(F.col(c)) / F.lit(width))

    device_side = device_columns(devices).withColumn(
        "slot", F.explode(F.transform(
            F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda step: slot("device_event_timestamp") + step)),
    )
    reading_side = reading_columns(readings.where(F.col("reading_id").isNotNull())).withColumn(
        "slot", slot("reading_event_timestamp"),
    )
    gap = F.abs(F.unix_micros("reading_event_timestamp") - F.unix_micros("device_event_timestamp"))
    joined = reading_side.join(device_side, ["device_id", "slot"], "inner").where(gap <= width)
    return classified(joined, capture_time()).select(*JOINED_COLUMNS)


def payload_event_time(columns: list[str], now: Column | None) -> Column:
    """First known of the reading's own times, else now."""
    return F.coalesce(*[F.col(c) for c in columns], zoneless(now_or(now)))


# Which times of a reading make its event time: through the log, and directly.
LOG_TIMES = ["timestamp", "updated_at", "created_at"]
DIRECT_TIMES = ["timestamp", "created_at"]


def device_winners(devices: DataFrame) -> DataFrame:
    """One device per ``device_id`` among the current documents: greatest (seq, _id)."""
    rest = [c for c in devices.columns if c not in ("device_id", "seq", "_id")]
    best = F.max(F.struct("seq", "_id", *rest)).alias("best")
    rows = devices.groupBy("device_id").agg(best)
    return rows.select("device_id", "best.*")


def join_winners(readings: DataFrame, winners: DataFrame, times: list[str],
                 now: Column | None = None, how: str = "inner") -> DataFrame:
    """Keyed readings with their winning device: one output row per reading.

    Other columns of ``readings`` (its key, ``row_kind``, ``seq``) are kept. With
    ``how="left"`` a reading without a device stays, with ``device_mongo_id`` NULL.
    """
    device_side = winners.withColumn("mongo_id", F.col("_id")).select(
        *[F.col(source).alias(name) for name, source in _DEVICE_SIDE.items()])
    extra = [c for c in readings.columns if c in ("row_kind", "seq", "partition_date")]
    reading_side = readings.withColumn("mongo_id", F.col("_id")).select(
        "device_id",
        *[F.col(source).alias(name) for name, source in _READING_SIDE.items()],
        payload_event_time(times, now).alias("event_timestamp"),
        *extra,
    )
    joined = reading_side.join(device_side, "device_id", how)
    return joined.withColumn(
        "severity", severity(F.col("sensor_value"), F.col("temperature_threshold")),
    ).select(*JOINED_COLUMNS, *extra)


def mark_unmatched(joined: DataFrame) -> DataFrame:
    """Turn rows that must not be in the output into deletes: the reading is deleted, has
    no id, or has no device."""
    present = (F.col("row_kind") != DELETE) & F.col("device_mongo_id").isNotNull() & F.col("reading_id").isNotNull()
    return joined.withColumn("row_kind", F.when(present, AFTER_UPDATE).otherwise(DELETE))


def current_enriched(device_changes: DataFrame, reading_changes: DataFrame, reading_keys: list[str],
                     times: list[str] = LOG_TIMES, now: Column | None = None) -> DataFrame:
    """The joined table as it stands after all changes on either side.

    Both logs are reduced to their current rows before the join, and devices further to
    one row per ``device_id``; the join then moves each reading once. Readings without id go
    after that: a change that takes the id away must replace the older image first.
    """
    winners = device_winners(current_state(device_changes, ["_id"]))
    readings = current_state(reading_changes, reading_keys).where(F.col("reading_id").isNotNull())
    return join_winners(readings, winners, times, now)
