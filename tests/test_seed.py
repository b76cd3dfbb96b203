"""The seed documents: expected severities and per-minute rows."""

from datetime import datetime

from fixtures import SEED_READINGS, fixed_now, frame, seed_device_records, seed_reading_records
from pyspark.sql import functions as F

from tidelog.operators import decode_rows, enrich, tables, windows

# window minute, device, value, warnings, criticals
MINUTES = [
    (0, "LH-VVK-HV_CAM-04", 24.7, 0, 0), (0, "MP1-N5-D1_CAM-01", 25.5, 0, 0), (0, "MP3-NE8-DE6_CAM-01", 20.3, 0, 0),
    (5, "MP1-N5-D1_CAM-01", 32.5, 1, 0), (10, "MP1-N5-D1_CAM-01", 37.8, 0, 1), (15, "MP3-NE8-DE6_CAM-01", 38.1, 1, 0),
    (20, "LH-VVK-HV_CAM-04", 30.2, 1, 0),
]


def seed_rows(spark):
    return (decode_rows.device_rows(frame(spark, seed_device_records()), fixed_now()),
            decode_rows.reading_rows(frame(spark, seed_reading_records()), fixed_now()))


def test_severity(spark):
    rows = tables.enriched_raw(enrich.enrich_append(*seed_rows(spark))).collect()
    assert {r.reading_id: r.severity for r in rows} == {s[0]: s[6] for s in SEED_READINGS}
    warning = next(r for r in rows if r.reading_id == "TEMP_001_WARNING")
    assert (warning.cdc_ts, warning.partition_date) == (1735725900000, "2025-01-01")


def test_minutes(spark):
    devices, readings = seed_rows(spark)
    rows = windows.temperature_per_window(readings, devices).collect()
    got = sorted((r.window_start.minute, r.device_id, r.avg_temperature, r.warning_count, r.critical_count) for r in rows)
    assert got == sorted(MINUTES)
    assert all(r.reading_count == 1 and r.max_temperature == r.min_temperature for r in rows)
    assert rows[0].window_end - rows[0].window_start == datetime(2025, 1, 1, 0, 1) - datetime(2025, 1, 1)


def test_aggregating_first_equals_joining_first(spark):
    """Duplicate device rows (two with the same labels, one with others) and unknown values."""
    devices, readings = seed_rows(spark)
    extra = devices.where("device_id = 'MP1-N5-D1_CAM-01'")
    devices = devices.unionByName(extra).unionByName(extra.withColumn("device_name", F.lit("other")))
    readings = readings.unionByName(
        readings.withColumn("sensor_value", F.when(F.col("quality") == "good", F.lit(None)).otherwise(1.0)))
    got = windows.temperature_per_window(readings, devices, "10 minutes")
    joined = readings.where("reading_id is not null and unit = '°C'").join(
        devices.where("device_type = 'temperature'").select("device_id", "device_name", "location", "building"), "device_id")
    expected = joined.groupBy(F.window("event_timestamp", "10 minutes").alias("w"),
                              "device_id", "device_name", "location", "building").agg(
        F.count(F.lit(1)), F.avg("sensor_value"), F.max("sensor_value"), F.min("sensor_value"),
        F.count(F.when(F.col("quality") == "warning", 1)), F.count(F.when(F.col("quality") == "critical", 1)))
    expected = expected.select(F.col("w.start").cast("timestamp_ntz"), F.col("w.end").cast("timestamp_ntz"),
                               *expected.columns[1:])

    def rounded(df):
        return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in df.collect())

    assert rounded(got.drop("cdc_ts", "partition_date")) == rounded(expected)
