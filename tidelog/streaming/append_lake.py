"""Change logs to append-only tables."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidelog.functions.timeparts import cdc_ts, partition_date, zoneless
from tidelog.operators import decode_rows, enrich, tables, windows
from tidelog.schemas import DEVICES_RAW, TEMPERATURE_MINUTE, table_schema
from tidelog.sinks.append import append_stream, numbered_batch_writer
from tidelog.sources.lake import open_or_empty
from tidelog.streaming.counts import DEVICE_COUNTS, READING_COUNTS
from tidelog.streaming.idle import beats, with_beats
from tidelog.streaming.queries import WATERMARK_DELAY, Trigger, chosen, start


def _slot(time: str, ttl_seconds: int, shift_seconds: int = 0) -> Column:
    """The time slot, four limits wide, of a time moved by some seconds; in double, where no far-off time overflows."""
    return F.floor((F.unix_micros(F.col(time)).cast("double") + F.lit(shift_seconds * 1e6)) / F.lit(4e6 * max(ttl_seconds, 1)))


def enriched_stream(devices: DataFrame, readings: DataFrame, ttl_seconds: int = 7200, salts: int = 1,
                    device_beats: DataFrame | None = None, reading_beats: DataFrame | None = None,
                    how: str = "inner") -> DataFrame:
    """Stream-stream join of device and reading rows whose times are ``ttl_seconds`` apart at most.

    The range bounds the state: a row leaves it once no partner can arrive any more. ``device_beats`` (the times of the other side,
    see :mod:`tidelog.streaming.idle`) let that happen while devices are quiet, ``reading_beats`` the other way round.
    The join runs on (device, time slot): a reading goes to its own slot, a device row to those within the limit, one or two. So a reading
    meets the device rows close in time only, and a hot device's history spreads over many tasks. Streaming joins are not re-planned at
    run time; for a device that is hot within a slot ``salts`` copies of its rows share its readings, and each is held as state.

    With ``how="left_outer"`` a reading that has had no device comes out too, without device columns, when none can come any more.
    """
    # A second more on either side covers what double precision takes from far-off times.
    first, last = (_slot("device_event_timestamp", ttl_seconds, shift) for shift in (-ttl_seconds - 1, ttl_seconds + 1))
    device_side = enrich.device_columns(with_beats(devices, device_beats, WATERMARK_DELAY)).withColumn("slot", F.explode(F.sequence(first, last)))
    if salts > 1:
        device_side = device_side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    else:
        device_side = device_side.withColumn("salt", F.lit(0))
    reading_side = enrich.reading_columns(
        with_beats(readings, reading_beats, WATERMARK_DELAY).where(F.col("reading_id").isNotNull()),
    ).withColumns({
        "slot": _slot("reading_event_timestamp", ttl_seconds),
        "salt": F.pmod(F.xxhash64("reading_mongo_id", "reading_id"), F.lit(salts)).cast("int")})
    d, s = device_side.alias("d"), reading_side.alias("s")
    gap = F.expr(f"interval {ttl_seconds} seconds")
    joined = s.join(d, (
        (F.col("s.device_id") == F.col("d.device_id")) & (F.col("s.slot") == F.col("d.slot")) & (F.col("s.salt") == F.col("d.salt"))
        & (F.col("s.reading_event_timestamp") >= F.col("d.device_event_timestamp") - gap)
        & (F.col("s.reading_event_timestamp") <= F.col("d.device_event_timestamp") + gap)
    ), how).select(
        "s.device_id", *[F.col(f"d.{c}").alias(c) for c in device_side.columns if c not in ("device_id", "slot", "salt")],
        *[F.col(f"s.{c}").alias(c) for c in reading_side.columns if c not in ("device_id", "slot", "salt")])
    return enrich.classified(joined, enrich.capture_time()).select(*enrich.JOINED_COLUMNS)


def unmatched_readings(joined: DataFrame) -> DataFrame:
    """Of an outer join's rows the readings that had no device."""
    return joined.where(F.col("device_mongo_id").isNull()).select(
        F.col("reading_mongo_id").alias("mongo_id"), "reading_id", "device_id", "sensor_value", "unit", "quality",
        "reading_timestamp", F.col("reading_battery").alias("battery_level"), zoneless(F.col("event_timestamp")).alias("event_timestamp"),
        cdc_ts(F.col("event_timestamp")).alias("cdc_ts"), partition_date(F.col("event_timestamp")).alias("partition_date"))


def temperature_writer(readings: DataFrame, devices: Callable[[], DataFrame], path: str,
                       size: str = "1 minute") -> DataStreamWriter:
    """Temperature per device and window, each window written once it is closed.

    The only state is the window totals of the readings. Devices are opened *inside* each
    batch that closes windows: a device that arrives before a window closes is part of it, and a quiet device
    stream holds nothing back. Of the devices those are grouped that have a closed window.
    """
    totals = windows.window_totals(readings.withWatermark("event_timestamp", WATERMARK_DELAY), size)

    def labelled(batch: DataFrame) -> DataFrame:
        # Written first, so that state is asked once however often the rows are looked at; the folder holds one batch.
        spark, closed = batch.sparkSession, f"{path}/_closed"
        batch.write.mode("overwrite").parquet(closed)
        rows = spark.read.schema(batch.schema).parquet(closed)
        if rows.isEmpty():
            return spark.createDataFrame([], table_schema(TEMPERATURE_MINUTE))
        asked = devices().join(rows.select("device_id").distinct(), "device_id", "left_semi")
        return windows.label_windows(rows, asked)

    write = numbered_batch_writer(path, labelled)
    return totals.writeStream.outputMode("append").foreachBatch(write)


def start_append_lake(device_records: DataFrame, reading_records: DataFrame, root: str,
                      devices: Callable[[], DataFrame] | None = None, trigger: Trigger = Trigger(),
                      now: Column | None = None, ttl_seconds: int = 7200, salts: int = 1,
                      fmt: str = "parquet", only: Collection[str] | None = None,
                      idle_seconds: int | None = None) -> list[StreamingQuery]:
    """Four queries: raw devices, raw readings, their join, and temperature per minute; a fifth, readings without a device, where
    ``only`` names it (``unmatched_readings``).

    While one side of the join is silent its watermark follows the other ``idle_seconds`` behind, by default ``ttl_seconds``: then
    no pair within the limit is lost to a side that lags by less, and state spans twice the limit at most.

    ``devices`` opens the device rows for the aggregate, each time anew. By default they are the
    ``devices_raw`` table of this job (every created row, older images included), empty until a device arrives.
    """
    root = root.rstrip("/")
    spark = reading_records.sparkSession
    devices = devices or (lambda: open_or_empty(spark, f"{root}/devices_raw", table_schema(DEVICES_RAW)))
    device_rows = decode_rows.device_rows(device_records, now, DEVICE_COUNTS)
    reading_rows = decode_rows.reading_rows(reading_records, now, READING_COUNTS)

    def joined(how: str) -> DataFrame:
        lag = ttl_seconds if idle_seconds is None else idle_seconds
        return enriched_stream(device_rows, reading_rows, ttl_seconds, salts, beats(reading_records, lag), beats(device_records, lag), how)

    outputs = {
        "devices_raw": append_stream(tables.devices_raw(device_rows), f"{root}/devices_raw", fmt),
        "sensor_readings_raw": append_stream(tables.readings_raw(reading_rows), f"{root}/sensor_readings_raw", fmt),
        "devices_readings": append_stream(
            tables.enriched_raw(joined("inner")), f"{root}/devices_readings", fmt),
        "temperature_readings_minute": temperature_writer(
            reading_rows, devices, f"{root}/temperature_readings_minute"),
    }
    if only and "unmatched_readings" in only:
        outputs["unmatched_readings"] = append_stream(
            unmatched_readings(joined("left_outer")), f"{root}/unmatched_readings", fmt)
    return [start(writer, name, f"{root}/_checkpoints", trigger)
            for name, writer in chosen(outputs, only).items()]
