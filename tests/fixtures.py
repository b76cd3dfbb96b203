"""Rows and records the tests are written with."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
NOW = "2025-06-01 00:00:00.500"


def fixed_now():
    return F.lit(NOW).cast("timestamp")


def device(doc="d1", device_id="dev1", threshold=30.0, updated="2025-01-01 10:00:00.000", **more):
    row = {
        "_id": doc, "device_id": device_id, "device_name": f"Device {device_id}", "device_type": "temperature",
        "location": "Room", "building": "Building A", "floor_level": 1, "area_type": "technical",
        "temperature_threshold": threshold, "installed_date": "2024-12-02 10:00:00.000", "status": "active",
        "battery_level": 85, "created_at": "2024-12-02 10:00:00.000", "updated_at": updated,
    }
    return {**row, **more}


def reading(doc="r1", reading_id="R1", device_id="dev1", value=32.5, at="2025-01-01 10:05:00.000", **more):
    row = {
        "_id": doc, "reading_id": reading_id, "device_id": device_id, "sensor_value": value, "unit": "°C",
        "quality": "good", "timestamp": at, "battery_level": 85, "created_at": at, "updated_at": at,
    }
    return {**row, **more}


def change(op, before=None, after=None, ts_ms=None):
    return json.dumps({"before": before, "after": after, "op": op, "ts_ms": ts_ms}, ensure_ascii=False)


def cluster_time(n):
    """The n-th change of one second of a database's time."""
    return {"$timestamp": {"t": 1, "i": n}}


def record(value, pos, part=0, record_ms=None):
    return {"value": value, "part": part, "pos": pos, "record_ms": pos if record_ms is None else record_ms}


_WRITTEN = [0]


def write_records(folder, records, name):
    """One JSON-lines file of records; appears at once, and later files sort after it: a stream takes files by their time."""
    os.makedirs(folder, exist_ok=True)
    part = os.path.join(folder, f".{name}")
    with open(part, "w", encoding="utf-8") as out:
        for item in records:
            out.write(json.dumps(item, ensure_ascii=False) + "\n")
    _WRITTEN[0] = max(_WRITTEN[0] + 1, time.time_ns() // 1_000_000)
    os.utime(part, ns=(_WRITTEN[0] * 1_000_000,) * 2)
    os.rename(part, os.path.join(folder, f"{name}.json"))


# The seed documents: id, name, type, location, building, floor, area, threshold, battery, installed.
SEED_DEVICES = [
    ("MP1-N5-D1_CAM-01", "Temperature Sensor Room 1", "temperature", "Server Room 1", "Building A", 1, "technical",
     30.0, 85, "2024-12-02 10:00:00.000"),
    ("TH-VD4-DA2_CAM-02", "Humidity Sensor Room 1", "humidity", "Server Room 1", "Building A", 1, "technical",
     30.0, 78, "2024-12-02 10:00:00.000"),
    ("MP3-NE8-DE6_CAM-01", "Temperature Sensor Warehouse", "temperature", "Warehouse A", "Building B", 0, "storage",
     35.0, 92, "2024-12-17 10:00:00.000"),
    ("LH-VVK-HV_CAM-04", "Temperature Sensor Office", "temperature", "Office Floor 3", "Building A", 3, "office",
     28.0, 23, "2024-11-02 10:00:00.000"),
]
# Reading id, device, value, unit, quality, minute after 10:00, expected severity.
SEED_READINGS = [
    ("TEMP_001_NORMAL", "MP1-N5-D1_CAM-01", 25.5, "°C", "good", 0, "NORMAL"),
    ("TEMP_001_WARNING", "MP1-N5-D1_CAM-01", 32.5, "°C", "warning", 5, "WARNING"),
    ("TEMP_001_CRITICAL", "MP1-N5-D1_CAM-01", 37.8, "°C", "critical", 10, "CRITICAL"),
    ("TEMP_002_NORMAL", "MP3-NE8-DE6_CAM-01", 20.3, "°C", "good", 0, "NORMAL"),
    ("TEMP_002_WARNING", "MP3-NE8-DE6_CAM-01", 38.1, "°C", "warning", 15, "WARNING"),
    ("TEMP_003_NORMAL", "LH-VVK-HV_CAM-04", 24.7, "°C", "good", 0, "NORMAL"),
    ("TEMP_003_WARNING", "LH-VVK-HV_CAM-04", 30.2, "°C", "warning", 20, "WARNING"),
    ("HUM_001_NORMAL", "TH-VD4-DA2_CAM-02", 45.8, "%", "good", 0, "CRITICAL"),
]
BASE_MS = 1735725600000  # 2025-01-01T10:00:00Z


def seed_device_records():
    rows = []
    for i, (dev, name, kind, location, building, floor, area, threshold, battery, installed) in enumerate(SEED_DEVICES):
        doc = device(f"doc{i}", dev, threshold, installed, device_name=name, device_type=kind, location=location,
                     building=building, floor_level=floor, area_type=area, battery_level=battery,
                     installed_date=installed, created_at=installed)
        rows.append(record(change("c", None, doc, BASE_MS), i))
    return rows


def seed_reading_records():
    rows = []
    for i, (rid, dev, value, unit, quality, minute, _) in enumerate(SEED_READINGS):
        doc = reading(f"doc{i}", rid, dev, value, f"2025-01-01 10:{minute:02d}:00.000", unit=unit, quality=quality)
        rows.append(record(change("c", None, doc, BASE_MS + minute * 60_000), i))
    return rows


def frame(spark, records):
    from tidelog.sources.records import FILE_RECORD

    return spark.createDataFrame([tuple(r.get(f) for f in FILE_RECORD.fieldNames()) for r in records], FILE_RECORD)
