"""The two entities, their change envelopes, and the columns of every output table."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "time": T.TimestampNTZType(),
}


def _struct(columns: str) -> T.StructType:
    """Build a schema from ``name type`` lines."""
    pairs = (line.split() for line in columns.strip().splitlines())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


DEVICES = _struct("""
    _id                    string
    device_id              string
    device_name            string
    device_type            string
    location               string
    building               string
    floor_level            int
    area_type              string
    temperature_threshold  double
    installed_date         time
    status                 string
    battery_level          int
    created_at             time
    updated_at             time
""")

READINGS = _struct("""
    _id            string
    reading_id     string
    device_id      string
    sensor_value   double
    unit           string
    quality        string
    timestamp      time
    battery_level  int
    created_at     time
    updated_at     time
""")


def as_text_times(payload: T.StructType) -> T.StructType:
    """The payload as it travels in JSON: timestamps are text."""
    return T.StructType([
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
        for f in payload
    ])


def envelope(payload: T.StructType) -> T.StructType:
    """A change record: both images, the operation and the capture time."""
    image = as_text_times(payload)
    return T.StructType([
        T.StructField("before", image),
        T.StructField("after", image),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ])


# A document database's change event, as its connector hands it out: everything but the operation is a JSON document.
CHANGE_EVENT = T.StructType([T.StructField(name, T.StringType()) for name in (
    "_id", "operationType", "documentKey", "fullDocument", "fullDocumentBeforeChange", "updateDescription", "clusterTime")])


def _columns(text: str) -> list[str]:
    return text.split()


_DEVICE_BODY = """device_id device_name device_type location building floor_level
    area_type temperature_threshold installed_date status battery_level created_at updated_at"""
_READING_BODY = "reading_id device_id sensor_value unit quality"
_ENRICHED_HEAD = """device_mongo_id reading_mongo_id device_id device_name device_type
    location building floor_level area_type temperature_threshold"""
_ENRICHED_TAIL = """device_status device_battery reading_id sensor_value unit quality
    severity reading_timestamp reading_battery event_timestamp"""

# Columns of the append tables.
DEVICES_RAW = _columns(f"mongo_id {_DEVICE_BODY} event_timestamp cdc_ts partition_date")
READINGS_RAW = _columns(f"""mongo_id {_READING_BODY} reading_timestamp battery_level
    created_at updated_at event_timestamp cdc_ts partition_date""")
ENRICHED_RAW = _columns(f"{_ENRICHED_HEAD} installed_date {_ENRICHED_TAIL} cdc_ts partition_date")
TEMPERATURE_MINUTE = _columns("""window_start window_end device_id device_name location building
    reading_count avg_temperature max_temperature min_temperature
    warning_count critical_count cdc_ts partition_date""")

# Readings that had no device in time.
UNMATCHED_READINGS = _columns("""mongo_id reading_id device_id sensor_value unit quality reading_timestamp battery_level
    event_timestamp cdc_ts partition_date""")

# Columns of the keyed tables.
DEVICES_BY_DAY = _columns(f"mongo_id {_DEVICE_BODY} partition_date")
READINGS_BY_DAY = _columns(f"""mongo_id {_READING_BODY} reading_timestamp battery_level
    created_at updated_at partition_date""")
ENRICHED_BY_DAY = _columns(f"{_ENRICHED_HEAD} installed_date {_ENRICHED_TAIL} partition_date")

# Fields of the search documents.
DEVICE_DOC = _columns(f"mongo_id {_DEVICE_BODY}")
READING_DOC = _columns(f"mongo_id {_READING_BODY} timestamp battery_level created_at updated_at")
ENRICHED_DOC = _columns(f"{_ENRICHED_HEAD} installed_date {_ENRICHED_TAIL}")
ENRICHED_DIRECT_DOC = _columns(f"{_ENRICHED_HEAD} {_ENRICHED_TAIL}")

_COLUMN_TYPES = {
    **{f.name: f.dataType for f in DEVICES},
    **{f.name: f.dataType for f in READINGS},
    **{name: T.StringType() for name in
       _columns("mongo_id device_mongo_id reading_mongo_id device_status severity partition_date")},
    **{name: T.TimestampNTZType() for name in
       _columns("event_timestamp reading_timestamp window_start window_end")},
    **{name: T.IntegerType() for name in _columns("device_battery reading_battery")},
    **{name: T.LongType() for name in _columns("cdc_ts reading_count warning_count critical_count")},
    **{name: T.DoubleType() for name in _columns("avg_temperature max_temperature min_temperature")},
}


def table_schema(columns: list[str]) -> T.StructType:
    """The declared types of an output table, by its column list."""
    return T.StructType([T.StructField(name, _COLUMN_TYPES[name]) for name in columns])


# Name and columns of each append table of the lake.
APPEND_TABLES = {
    "devices_raw": DEVICES_RAW,
    "sensor_readings_raw": READINGS_RAW,
    "devices_readings": ENRICHED_RAW,
    "temperature_readings_minute": TEMPERATURE_MINUTE,
}

# Name, columns and key of each keyed table of the lake.
KEYED_TABLES = {
    "iceberg_devices": (DEVICES_BY_DAY, ["device_id", "partition_date"]),
    "iceberg_sensor_readings": (READINGS_BY_DAY, ["reading_id", "partition_date"]),
    "iceberg_devices_readings_enriched": (ENRICHED_BY_DAY, ["reading_id", "partition_date"]),
}
