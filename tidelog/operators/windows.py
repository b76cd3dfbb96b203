"""Temperature per device and tumbling window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.timeparts import cdc_ts, partition_date, zoneless
from tidelog.schemas import TEMPERATURE_MINUTE

# Fixed values of the filter.
DEVICE_TYPE = "temperature"
UNIT = "°C"


def window_totals(readings: DataFrame, size: str = "1 minute") -> DataFrame:
    """Mergeable totals per device and window.

    This is the only stateful step of the stream. It runs before the join, so that what
    is shuffled and kept is one row per device and window, not one per reading; a hot
    device costs no more than the number of its windows.
    """
    counted = readings.where(F.col("reading_id").isNotNull() & (F.col("unit") == UNIT))
    value = F.col("sensor_value")
    return counted.groupBy(F.window("event_timestamp", size).alias("span"), "device_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(value).alias("n_value"),
        F.sum(value).alias("total"),
        F.max(value).alias("highest"),
        F.min(value).alias("lowest"),
        F.count(F.when(F.col("quality") == "warning", 1)).alias("warnings"),
        F.count(F.when(F.col("quality") == "critical", 1)).alias("criticals"),
    )


def device_labels(devices: DataFrame) -> DataFrame:
    """Names and places of temperature devices, with how often each occurs."""
    labels = devices.where((F.col("device_type") == DEVICE_TYPE) & F.col("device_id").isNotNull())
    return labels.groupBy("device_id", "device_name", "location", "building").agg(
        F.count(F.lit(1)).alias("copies"))


def label_windows(totals: DataFrame, devices: DataFrame) -> DataFrame:
    """Join closed windows with their devices.

    Equals joining first and aggregating after. A reading counts once per device row
    with the same labels: the counts are multiplied by ``copies``, the mean and the
    extremes do not depend on it.
    """
    rows = totals.join(device_labels(devices), "device_id", "inner")
    start, end = zoneless(F.col("span.start")), zoneless(F.col("span.end"))
    return rows.select(
        start.alias("window_start"),
        end.alias("window_end"),
        "device_id", "device_name", "location", "building",
        (F.col("n") * F.col("copies")).alias("reading_count"),
        (F.col("total") / F.nullif(F.col("n_value"), F.lit(0))).alias("avg_temperature"),
        F.col("highest").alias("max_temperature"),
        F.col("lowest").alias("min_temperature"),
        (F.col("warnings") * F.col("copies")).alias("warning_count"),
        (F.col("criticals") * F.col("copies")).alias("critical_count"),
        cdc_ts(start).alias("cdc_ts"),
        partition_date(start).alias("partition_date"),
    ).select(*TEMPERATURE_MINUTE)


def temperature_per_window(readings: DataFrame, devices: DataFrame, size: str = "1 minute") -> DataFrame:
    """Count, mean, extremes and quality counts per temperature device and window."""
    return label_windows(window_totals(readings, size), devices)
