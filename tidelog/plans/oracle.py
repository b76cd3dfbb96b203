"""The same queries in SQL, straight from the given tables.

Inputs are shaped by plain projections; no JSON and none of the package's code is
involved, so an error in a decoder or an operator shows as a difference.
"""

from __future__ import annotations

NOW = "TIMESTAMP '2024-06-01 12:34:56.789'"
BASE = "TIMESTAMP '2024-02-01 00:00:00'"

EVENTS = """
ev AS (
  SELECT event_id, date_trunc('milliseconds', ts) AS ts, epoch_us(ts) // 1000 AS ts_ms,
         user_id, event_type, value
  FROM events)"""

DEVICES = f"""
devices AS (
  SELECT 'd' || c_custkey || 'a' AS _id, CAST(c_custkey AS VARCHAR) AS device_id, c_name AS device_name,
         CASE WHEN c_custkey % 4 = 3 THEN 'humidity' ELSE 'temperature' END AS device_type,
         c_mktsegment AS location, n_name AS building, CAST(c_nationkey % 10 AS INTEGER) AS floor_level,
         CASE c_custkey % 3 WHEN 0 THEN 'technical' WHEN 1 THEN 'storage' ELSE 'office' END AS area_type,
         CAST(25.0 + (c_custkey % 11) * 5.0 AS DOUBLE) AS temperature_threshold,
         {BASE} - to_hours(CAST(c_custkey % 1000 AS INTEGER)) - INTERVAL 30 DAY AS installed_date,
         CASE WHEN c_custkey % 7 = 0 THEN 'inactive' ELSE 'active' END AS status,
         CAST(c_custkey % 101 AS INTEGER) AS battery_level,
         {BASE} - to_hours(CAST(c_custkey % 1000 AS INTEGER)) AS created_at,
         {BASE} - to_hours(CAST(c_custkey % 1000 AS INTEGER))
           + to_hours(CAST(c_custkey % 48 AS INTEGER)) AS updated_at,
         c_custkey AS k
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _reading(reading_id: str = "'R' || event_id", device: str = "user_id", value: str = "value",
             timestamp: str = "ts", updated: str = "ts") -> str:
    return f"""'r' || event_id AS _id, {reading_id} AS reading_id, CAST({device} AS VARCHAR) AS device_id,
         {value} AS sensor_value, CASE event_type WHEN 'signup' THEN '%' ELSE '°C' END AS unit,
         CASE event_type WHEN 'error' THEN 'critical' WHEN 'purchase' THEN 'warning' ELSE 'good' END AS quality,
         {timestamp} AS "timestamp", CAST(event_id % 101 AS INTEGER) AS battery_level,
         ts AS created_at, {updated} AS updated_at"""


READINGS = f"""
readings AS (SELECT {_reading()}, event_id, ts_ms FROM ev)"""

# The created devices and readings, as the irregular topics hold them.
DEVICE_ROWS = f"""
device_rows AS (
  SELECT _id AS mongo_id, device_id, device_name, device_type, location, building, floor_level, area_type,
         temperature_threshold,
         CASE WHEN k % 9 = 0 THEN {NOW} WHEN k % 10 = 1 THEN NULL ELSE installed_date END AS installed_date,
         status, battery_level, created_at,
         CASE WHEN k % 8 = 5 THEN {NOW} ELSE updated_at END AS updated_at,
         CASE WHEN k % 13 = 12 THEN {NOW} ELSE make_timestamp((1706745600000 + k * 1000) * 1000) END AS event_timestamp
  FROM devices
  WHERE k % 37 <> 36 AND k % 29 <> 28 AND k % 19 <> 18)"""
READING_ROWS = f"""
reading_rows AS (
  SELECT 'r' || event_id AS mongo_id, CASE WHEN event_id % 41 = 0 THEN NULL ELSE 'R' || event_id END AS reading_id,
         CAST(user_id AS VARCHAR) AS device_id, value AS sensor_value,
         CASE event_type WHEN 'signup' THEN '%' ELSE '°C' END AS unit,
         CASE event_type WHEN 'error' THEN 'critical' WHEN 'purchase' THEN 'warning' ELSE 'good' END AS quality,
         CASE WHEN event_id % 43 = 42 THEN {NOW} ELSE ts END AS "timestamp",
         CAST(event_id % 101 AS INTEGER) AS battery_level, ts AS created_at, ts AS updated_at,
         CASE WHEN event_id % 13 = 12 THEN {NOW} ELSE ts END AS event_timestamp
  FROM ev WHERE event_id % 29 <> 28 AND event_id % 19 <> 18)"""

_UPDATED = "CASE WHEN event_id % 31 = 30 THEN NULL ELSE ts END"


def _device(threshold: str, updated: str) -> str:
    return f"""'d' || user_id || CASE WHEN event_id % 7 = 3 THEN 'b' ELSE 'a' END AS _id,
         CAST(CASE WHEN event_id % 11 = 10 THEN user_id + 1 ELSE user_id END AS VARCHAR) AS device_id,
         'Device ' || user_id AS device_name,
         CASE WHEN user_id % 4 = 3 THEN 'humidity' ELSE 'temperature' END AS device_type,
         event_type AS location, 'B' || (user_id % 5) AS building, CAST(user_id % 10 AS INTEGER) AS floor_level,
         'technical' AS area_type, {threshold} AS temperature_threshold,
         ts - INTERVAL 30 DAY AS installed_date, 'active' AS status,
         CAST(event_id % 101 AS INTEGER) AS battery_level, ts - INTERVAL 1 DAY AS created_at,
         {updated} AS updated_at"""


_BEFORE = _device("value + 1", f"{_UPDATED} - to_days(CAST(event_id % 3 AS INTEGER))")
_AFTER = _device("value", _UPDATED)

DEVICE_CHANGES = f"""
dev_ops AS (
  SELECT *, CASE WHEN event_id % 17 = 0 THEN 'd' WHEN event_id % 3 = 0 THEN 'u'
                 WHEN event_id % 5 = 0 THEN 'r' ELSE 'c' END AS op
  FROM ev),
device_changes AS (
  SELECT CASE op WHEN 'u' THEN '-U' ELSE '-D' END AS row_kind, ts_ms AS ms,
         1 AS rank, event_id % 4 AS part, event_id AS pos, 0 AS ord, {_BEFORE}
  FROM dev_ops WHERE op IN ('u', 'd')
  UNION ALL
  SELECT CASE op WHEN 'u' THEN '+U' ELSE '+I' END, ts_ms, 1, event_id % 4, event_id, 1, {_AFTER}
  FROM dev_ops WHERE op <> 'd')"""

_RID = "CASE WHEN event_id % 41 = 0 THEN NULL ELSE 'R' || event_id END"
_FIRST = _reading(reading_id=_RID)
_SECOND = _reading(
    reading_id="CASE WHEN event_id % 41 = 0 OR event_id % 35 = 0 THEN NULL ELSE 'R' || event_id END",
    device="CASE WHEN event_id % 15 = 0 THEN user_id + 1 ELSE user_id END", value="value + 1",
    timestamp="ts + to_days(CAST(event_id % 2 AS INTEGER))", updated="ts + INTERVAL 1 HOUR")


def _change(kind: str, step: int, rank: int, ord_: int, image: str, where: str) -> str:
    return f"""
  SELECT '{kind}' AS row_kind, ts_ms + {step} AS ms, {rank} AS rank, event_id % 4 AS part,
         event_id * 3 + {step} AS pos, {ord_} AS ord, {image}
  FROM ev WHERE {where}"""


READING_CHANGES = "\nreading_changes AS (" + "\n  UNION ALL".join([
    _change("+I", 0, 1, 1, _FIRST, "true"),
    _change("-U", 1, 1, 0, _FIRST, "event_id % 5 = 0"),
    _change("+U", 1, 1, 1, _SECOND, "event_id % 5 = 0"),
    _change("-D", 2, 1, 0, _FIRST, "event_id % 23 = 0 AND event_id % 5 <> 0"),
    _change("-D", 2, 1, 0, _SECOND, "event_id % 23 = 0 AND event_id % 5 = 0"),
]) + ")"


def latest(source: str, keys: str, name: str, where: str = "true") -> str:
    """Newest change per key, before-images left out."""
    return f"""
{name} AS (
  SELECT * FROM {source} WHERE row_kind <> '-U' AND {where}
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY ms DESC, rank DESC, part DESC, pos DESC, ord DESC) = 1)"""


WINNERS = latest("device_changes", "_id", "latest_devices") + """,
winners AS (
  SELECT * FROM latest_devices WHERE row_kind <> '-D'
  QUALIFY row_number() OVER (PARTITION BY device_id
    ORDER BY ms DESC, rank DESC, part DESC, pos DESC, ord DESC, _id DESC) = 1)"""

SEVERITY = """CASE WHEN sensor_value > temperature_threshold + 5 THEN 'CRITICAL'
         WHEN sensor_value > temperature_threshold THEN 'WARNING' ELSE 'NORMAL' END"""

DEVICE_COLUMNS = """device_id, device_name, device_type, location, building, floor_level, area_type,
         temperature_threshold, installed_date, status, battery_level, created_at, updated_at"""
READING_COLUMNS = """reading_id, device_id, sensor_value, unit, quality, "timestamp", battery_level,
         created_at, updated_at"""


def joined(reading_id: str, device_id: str, event: str, installed: bool = True, present: str | None = None) -> str:
    """The joined columns from ``d`` and ``s``; with ``present`` they are NULL where it is false."""
    columns = [
        (device_id, "device_mongo_id"), (reading_id, "reading_mongo_id"), ("d.device_id", "device_id"),
        ("d.device_name", "device_name"), ("d.device_type", "device_type"), ("d.location", "location"),
        ("d.building", "building"), ("d.floor_level", "floor_level"), ("d.area_type", "area_type"),
        ("d.temperature_threshold", "temperature_threshold"), ("d.installed_date", "installed_date"),
        ("d.status", "device_status"), ("d.battery_level", "device_battery"), ("s.reading_id", "reading_id"),
        ("s.sensor_value", "sensor_value"), ("s.unit", "unit"), ("s.quality", "quality"),
        (f"({SEVERITY})", "severity"), ('s."timestamp"', "reading_timestamp"),
        ("s.battery_level", "reading_battery"), (event, "event_timestamp"),
    ]
    picked = [(e, n) for e, n in columns if installed or n != "installed_date"]
    if present:
        picked = [(f"CASE WHEN {present} THEN {e} END", n) for e, n in picked]
    return ", ".join(f"{e} AS {n}" for e, n in picked)


LOG_EVENT = f's."timestamp", s.updated_at, s.created_at, {NOW}'
DAY = "strftime({}, '%Y-%m-%d')"
CDC_TS = "CAST(floor(epoch({})) AS BIGINT) * 1000"
DEVICE_DAY = f"{DAY.format(f'coalesce(updated_at, created_at, {NOW})')} AS partition_date"
READING_DAY = f"""{DAY.format(f'coalesce("timestamp", updated_at, created_at, {NOW})')} AS partition_date"""


def query(ctes: list[str], select: str) -> str:
    return "WITH" + ",".join(ctes) + "\n" + select.strip()


def temperature(unit: str, days: str) -> str:
    return query([EVENTS, READINGS, DEVICES], f"""
SELECT date_trunc('{unit}', s.updated_at) AS window_start, date_trunc('{unit}', s.updated_at) + {days} AS window_end,
       s.device_id, d.device_name, d.location, d.building, count(*) AS reading_count,
       round(avg(s.sensor_value), 6) AS avg_temperature, max(s.sensor_value) AS max_temperature,
       min(s.sensor_value) AS min_temperature,
       count(CASE WHEN s.quality = 'warning' THEN 1 END) AS warning_count,
       count(CASE WHEN s.quality = 'critical' THEN 1 END) AS critical_count,
       {CDC_TS.format(f"date_trunc('{unit}', s.updated_at)")} AS cdc_ts,
       {DAY.format(f"date_trunc('{unit}', s.updated_at)")} AS partition_date
FROM readings s JOIN devices d ON s.device_id = d.device_id
WHERE s.reading_id IS NOT NULL AND d.device_type = 'temperature' AND s.unit = '°C'
GROUP BY ALL""")


def _by_day(source: str, day: str) -> str:
    """The day per change; the image before an update takes its row away."""
    return f"\nby_day AS (SELECT * REPLACE (replace(row_kind, '-U', '-D') AS row_kind), {day} FROM {source})"


_ENRICHED_PRESENT = "s.row_kind <> '-D' AND d._id IS NOT NULL AND s.reading_id IS NOT NULL"


def _enriched_docs(index: str, event: str, installed: bool) -> str:
    return query(
        [EVENTS, DEVICE_CHANGES, READING_CHANGES, WINNERS, latest("reading_changes", "_id", "latest_readings")], f"""
SELECT '{index}' AS _index, s._id AS doc_id,
       CASE WHEN {_ENRICHED_PRESENT} THEN 'index' ELSE 'delete' END AS action,
       greatest(s.ms, 0) * 2 + s.rank AS version,
       {joined('s._id', 'd._id', event, installed, _ENRICHED_PRESENT)}
FROM latest_readings s LEFT JOIN winners d ON s.device_id = d.device_id""")


def _entity_docs(source: str, ctes: list[str], index: str, columns: list[str]) -> str:
    fields = ", ".join(f"CASE WHEN row_kind <> '-D' THEN {c} END AS {c}" for c in columns)
    return query([EVENTS, *ctes, latest(source, "_id", "newest")], f"""
SELECT '{index}' AS _index, _id AS doc_id, CASE row_kind WHEN '-D' THEN 'delete' ELSE 'index' END AS action,
       greatest(ms, 0) * 2 + rank AS version, CASE WHEN row_kind <> '-D' THEN _id END AS mongo_id, {fields}
FROM newest""")


def _split(columns: str) -> list[str]:
    return [c.strip() for c in columns.split(",")]


_ORDER = "row_kind, ms, pos, ord, _id"

ORACLE = {
    "decode_envelope_devices": query([DEVICES, DEVICE_ROWS], "SELECT * FROM device_rows"),
    "decode_envelope_readings": query([EVENTS, READING_ROWS], "SELECT * FROM reading_rows"),
    "event_time_from_ts_ms": query([EVENTS], f"""
SELECT CASE WHEN event_id % 29 = 28 THEN NULL ELSE 'r' || event_id END AS mongo_id,
       CASE WHEN event_id % 19 = 18 THEN 'u' ELSE 'c' END AS op,
       CASE WHEN event_id % 13 = 12 THEN {NOW} ELSE ts END AS event_time FROM ev"""),
    "insert_only_filter": query([EVENTS], """
SELECT 'r' || event_id AS mongo_id, 'c' AS op, CASE WHEN event_id % 13 = 12 THEN NULL ELSE ts_ms END AS ts_ms
FROM ev WHERE event_id % 29 <> 28 AND event_id % 19 <> 18"""),
    "changelog_undecodable": """SELECT CAST(c_custkey % 4 AS INTEGER) AS part, c_custkey AS pos,
        CASE WHEN c_custkey % 37 = 36 THEN 'no operation' ELSE 'no image' END AS reason
        FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 37 = 36 OR c_custkey % 29 = 28""",
    "changelog_decode_devices": query([EVENTS, DEVICE_CHANGES], f"SELECT {_ORDER}, {DEVICE_COLUMNS} FROM device_changes"),
    "changelog_decode_readings": query([EVENTS, READING_CHANGES], f"SELECT {_ORDER}, {READING_COLUMNS} FROM reading_changes"),
    "changelog_encode": query([EVENTS, DEVICE_CHANGES], """
, texts AS (SELECT *, row_kind IN ('-U', '-D') AS gone,
              strftime(updated_at, '%Y-%m-%d %H:%M:%S.%g') AS updated_text FROM device_changes)
SELECT _id AS key, pos, ord, CASE WHEN gone THEN 'd' ELSE 'c' END AS op,
       CASE WHEN gone THEN _id END AS before_id, CASE WHEN gone THEN temperature_threshold END AS before_threshold,
       CASE WHEN gone THEN updated_text END AS before_updated_at,
       CASE WHEN NOT gone THEN _id END AS after_id, CASE WHEN NOT gone THEN temperature_threshold END AS after_threshold,
       CASE WHEN NOT gone THEN updated_text END AS after_updated_at
FROM texts"""),
    "changelog_roundtrip": query([EVENTS, READING_CHANGES], f"""
SELECT CASE WHEN row_kind IN ('-U', '-D') THEN '-D' ELSE '+I' END AS row_kind, ms, pos * 2 + ord AS pos, ord, _id,
       {READING_COLUMNS} FROM reading_changes"""),
    "cdc_snapshot_union_changes": query([EVENTS, DEVICES, DEVICE_CHANGES], f"""
, log AS (
  SELECT '+I' AS row_kind, -1 AS ms, 0 AS rank, 0 AS part, 0 AS pos, 0 AS ord, _id, {DEVICE_COLUMNS} FROM devices
  UNION ALL
  SELECT row_kind, ms, rank, part, pos, ord, _id, {DEVICE_COLUMNS} FROM device_changes),
{latest("log", "_id", "newest")}
SELECT _id, {DEVICE_COLUMNS} FROM newest WHERE row_kind <> '-D'"""),
    "current_devices": query([EVENTS, DEVICE_CHANGES, latest("device_changes", "_id", "newest")],
                             f"SELECT _id, {DEVICE_COLUMNS} FROM newest WHERE row_kind <> '-D'"),
    "current_readings": query([EVENTS, READING_CHANGES, latest("reading_changes", "_id", "newest")],
                              f"SELECT _id, {READING_COLUMNS} FROM newest WHERE row_kind <> '-D'"),
    "current_enriched": query(
        [EVENTS, DEVICE_CHANGES, READING_CHANGES, WINNERS,
         latest("reading_changes", "_id", "newest")], f"""
SELECT {joined('s._id', 'd._id', f'coalesce({LOG_EVENT})')}
FROM newest s JOIN winners d ON s.device_id = d.device_id WHERE s.row_kind <> '-D' AND s.reading_id IS NOT NULL"""),
    # No log here: what becomes of an event's document follows from its number.
    "changelog_same_instant": query([EVENTS], f"""
, ends AS (
  SELECT {_FIRST}, event_id FROM ev WHERE event_id % 5 <> 0 UNION ALL SELECT {_SECOND}, event_id FROM ev WHERE event_id % 5 = 0)
SELECT _id, {READING_COLUMNS} FROM ends WHERE event_id % 23 <> 0"""),
    "severity_classify": query([EVENTS, READINGS, DEVICES], f"""
SELECT s.device_id, s.reading_id, s.sensor_value, d.temperature_threshold, {SEVERITY} AS severity
FROM readings s JOIN devices d ON s.device_id = d.device_id"""),
    "cdc_ts_and_partition_date": query([EVENTS], f"""
SELECT 'r' || event_id AS mongo_id, {CDC_TS.format('ts')} AS cdc_ts, {DAY.format('ts')} AS partition_date,
       '2025-01-01' AS unknown_date FROM ev"""),
    "raw_devices_append": query([DEVICES, DEVICE_ROWS], f"""
SELECT *, {CDC_TS.format('event_timestamp')} AS cdc_ts, {DAY.format('event_timestamp')} AS partition_date
FROM device_rows"""),
    "raw_readings_append": query([EVENTS, READING_ROWS], f"""
SELECT * RENAME ("timestamp" AS reading_timestamp), {CDC_TS.format('event_timestamp')} AS cdc_ts,
       {DAY.format('event_timestamp')} AS partition_date
FROM reading_rows"""),
    "enriched_append": query([EVENTS, DEVICES, DEVICE_ROWS, READING_ROWS], f"""
SELECT {joined('s.mongo_id', 'd.mongo_id', 'coalesce(s.event_timestamp, d.event_timestamp)')},
       {CDC_TS.format('coalesce(s.event_timestamp, d.event_timestamp)')} AS cdc_ts,
       {DAY.format('coalesce(s.event_timestamp, d.event_timestamp)')} AS partition_date
FROM device_rows d JOIN reading_rows s ON d.device_id = s.device_id WHERE s.reading_id IS NOT NULL"""),
    "devices_left_join_readings": query([EVENTS, READINGS, DEVICES], f"""
SELECT {joined('s._id', 'd._id', 'coalesce(s.updated_at, d.updated_at)')}
FROM devices d LEFT JOIN readings s ON d.device_id = s.device_id"""),
    "enriched_within_ttl": query([EVENTS, READINGS, DEVICE_CHANGES], f"""
SELECT {joined('s._id', 'd._id', 's.updated_at')}
FROM device_changes d JOIN readings s ON d.device_id = s.device_id
WHERE d.row_kind IN ('+I', '+U') AND abs(s.ts_ms - d.ms) <= 7200000"""),
    "temperature_minute": temperature("minute", "INTERVAL 1 MINUTE"),
    "temperature_day": temperature("day", "INTERVAL 1 DAY"),
    "upsert_devices_by_day": query(
        [EVENTS, DEVICE_CHANGES, _by_day("device_changes", DEVICE_DAY),
         latest("by_day", "device_id, partition_date", "newest")],
        f"SELECT _id AS mongo_id, {DEVICE_COLUMNS}, partition_date FROM newest WHERE row_kind <> '-D'"),
    "upsert_readings_by_day": query(
        [EVENTS, READING_CHANGES, _by_day("reading_changes", READING_DAY),
         latest("by_day", "reading_id, partition_date", "newest", "reading_id IS NOT NULL")], """
SELECT _id AS mongo_id, reading_id, device_id, sensor_value, unit, quality, "timestamp" AS reading_timestamp,
       battery_level, created_at, updated_at, partition_date FROM newest WHERE row_kind <> '-D'"""),
    "upsert_enriched_by_day": query(
        [EVENTS, DEVICE_CHANGES, READING_CHANGES, WINNERS, _by_day("reading_changes", READING_DAY),
         latest("by_day", "reading_id, partition_date", "newest", "reading_id IS NOT NULL")], f"""
SELECT {joined('s._id', 'd._id', f'coalesce({LOG_EVENT})')}, s.partition_date
FROM newest s JOIN winners d ON s.device_id = d.device_id WHERE s.row_kind <> '-D'"""),
    "search_docs_devices": _entity_docs("device_changes", [DEVICE_CHANGES], "iot_devices", _split(DEVICE_COLUMNS)),
    "search_docs_readings": _entity_docs("reading_changes", [READING_CHANGES], "iot_sensor_readings",
                                         _split(READING_COLUMNS)),
    "search_docs_enriched": _enriched_docs("iot_enriched_data", f"coalesce({LOG_EVENT})", True),
    "search_docs_enriched_direct": _enriched_docs(
        "devices_readings", f'coalesce(s."timestamp", s.created_at, {NOW})', False),
    "search_doc_id_composite": query(
        [EVENTS, READING_CHANGES, _by_day("reading_changes", READING_DAY),
         latest("by_day", "reading_id, partition_date", "newest", "reading_id IS NOT NULL")], """
SELECT _id AS mongo_id, reading_id || '$' || partition_date AS doc_id FROM newest WHERE row_kind <> '-D'"""),
}

ORACLE |= {
    # The bytes of an action: its line, its document's line unless it is a delete, and a line end after each.
    "search_bulk_requests": f"""
WITH a AS (
  SELECT doc_id, action, (CASE action WHEN 'delete' THEN strlen(head) ELSE strlen(head) + 1 + strlen(body) END) + 1 AS n_bytes,
         CAST('0x' || left(md5(doc_id), 4) AS INTEGER) % 4 AS lane
  FROM (
    SELECT *, '{{"' || action || '":{{"_index":"iot_sensor_readings","_id":"' || doc_id || '","version":' || version
              || ',"version_type":"external_gte"}}}}' AS head,
           '{{"mongo_id":"' || mongo_id || '","reading_id":' || coalesce('"' || reading_id || '"', 'null') || ',"device_id":"' || device_id
           || '","sensor_value":' || CAST(sensor_value AS VARCHAR) || ',"unit":"' || unit || '","quality":"' || quality
           || '","timestamp":"' || strftime("timestamp", '%Y-%m-%d %H:%M:%S.%g') || '","battery_level":' || battery_level
           || ',"created_at":"' || strftime(created_at, '%Y-%m-%d %H:%M:%S.%g') || '","updated_at":"'
           || strftime(updated_at, '%Y-%m-%d %H:%M:%S.%g') || '"}}' AS body
    FROM ({ORACLE["search_docs_readings"]}))),
r AS (
  SELECT *, (row_number() OVER o - 1) // 100 AS by_count, CAST(sum(n_bytes) OVER o - n_bytes AS BIGINT) // 16384 AS by_bytes
  FROM a WINDOW o AS (PARTITION BY lane ORDER BY doc_id))
SELECT CAST(lane AS INTEGER) AS lane, CAST(dense_rank() OVER (PARTITION BY lane ORDER BY by_count, by_bytes) AS INTEGER) AS request,
       doc_id, action, CAST(n_bytes AS INTEGER) AS n_bytes FROM r""",
    "changelog_capture_time": query([EVENTS, READING_CHANGES], f"""
SELECT CASE WHEN row_kind IN ('-U', '-D') THEN '-D' ELSE '+I' END AS row_kind, _id, sensor_value,
       epoch_ms({NOW}) AS captured_ms FROM reading_changes"""),
}

_RAW_READINGS = f"""
raw_readings AS (
  SELECT _id AS mongo_id, reading_id, device_id, sensor_value, "timestamp" AS reading_timestamp,
         {DAY.format('updated_at')} AS partition_date FROM readings)"""

LAKE_ORACLE = {
    "lake_partition_prune": query([EVENTS, READINGS, _RAW_READINGS], """
SELECT partition_date, device_id, count(*) AS readings, max(sensor_value) AS highest
FROM raw_readings WHERE partition_date BETWEEN '2024-01-05' AND '2024-01-07'
GROUP BY partition_date, device_id"""),
    "lake_current_state": ORACLE["upsert_readings_by_day"],
    "lake_catalog_tables": query([EVENTS, READINGS, _RAW_READINGS], """
SELECT partition_date, device_id, count(*) AS readings, max(sensor_value) AS highest
FROM raw_readings WHERE partition_date BETWEEN '2024-01-05' AND '2024-01-07'
GROUP BY partition_date, device_id"""),
    "lake_top_devices": query([EVENTS, READINGS, DEVICES], f"""
SELECT d.device_id, d.device_name, count(*) AS readings,
       count(CASE WHEN {SEVERITY} = 'CRITICAL' THEN 1 END) AS critical_readings
FROM readings s JOIN devices d ON s.device_id = d.device_id
GROUP BY d.device_id, d.device_name
ORDER BY critical_readings DESC, readings DESC, d.device_id LIMIT 10"""),
    "lake_latest_reading": query([EVENTS, READINGS, _RAW_READINGS], """
SELECT device_id, reading_id, sensor_value, reading_timestamp FROM raw_readings
QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY reading_timestamp DESC, reading_id DESC) = 1"""),
    "lake_silent_devices": query([EVENTS, READINGS, DEVICES], """
SELECT device_id, device_name, status FROM devices d
WHERE NOT EXISTS (SELECT 1 FROM readings s WHERE s.device_id = d.device_id)"""),
}

def _held(docs: str) -> str:
    """The documents left once all actions are done."""
    return f"SELECT * EXCLUDE (_index, action, version) FROM ({ORACLE[docs]}) WHERE action = 'index'"


def _within(devices: str = "true") -> str:
    """Pairs of created device images and readings, at most two hours apart."""
    return query([EVENTS, DEVICE_CHANGES, READING_ROWS], f"""
SELECT {joined('s.mongo_id', 'd._id', 's.event_timestamp')},
       {CDC_TS.format('s.event_timestamp')} AS cdc_ts, {DAY.format('s.event_timestamp')} AS partition_date
FROM device_changes d JOIN reading_rows s ON d.device_id = s.device_id
WHERE d.row_kind = '+I' AND d.pos % 3 <> 0 AND d.pos % 5 <> 0 AND s.reading_id IS NOT NULL
  AND abs(epoch_us(s.event_timestamp) // 1000 - d.ms) <= 7200000 AND {devices}""")


_HALF = "(SELECT (min(event_id) + max(event_id)) / 2 FROM ev)"
# The last watermark: the readings' own times, less the 30 seconds that silent devices lag, less ten; rows two hours older are due.
_DUE = "make_timestamp((SELECT max(ts_ms) FROM ev WHERE event_id % 13 <> 12) * 1000) - INTERVAL 40 SECOND - INTERVAL 2 HOUR"

# The batch that a row of a streamed table comes with, and the readings of the first that come with the last.
_BATCH = "({k} - (SELECT min({k}) FROM {t})) // ((SELECT max({k}) - min({k}) FROM {t}) // 3 + 1)"
_LATE = f"(event_id % 50 = 7 AND {_BATCH.format(k='event_id', t='events')} = 0)"
_COUNTED = "event_type <> 'signup' AND event_id % 29 <> 28 AND event_id % 19 <> 18 AND event_id % 41 <> 0"


def _minutes(where: str) -> str:
    """Closed windows of the readings that hold ``where``, with the created devices."""
    return query([EVENTS, DEVICES, DEVICE_ROWS], f"""
, counted AS (
  SELECT CAST(user_id AS VARCHAR) AS device_id, value AS sensor_value,
         CASE event_type WHEN 'error' THEN 'critical' WHEN 'purchase' THEN 'warning' ELSE 'good' END AS quality, ts
  FROM ev WHERE {_COUNTED} AND {where})
SELECT date_trunc('minute', s.ts) AS window_start, date_trunc('minute', s.ts) + INTERVAL 1 MINUTE AS window_end,
       s.device_id, d.device_name, d.location, d.building, count(*) AS reading_count,
       round(avg(s.sensor_value), 6) AS avg_temperature, max(s.sensor_value) AS max_temperature, min(s.sensor_value) AS min_temperature,
       count(CASE WHEN s.quality = 'warning' THEN 1 END) AS warning_count, count(CASE WHEN s.quality = 'critical' THEN 1 END) AS critical_count,
       {CDC_TS.format("date_trunc('minute', s.ts)")} AS cdc_ts, {DAY.format("date_trunc('minute', s.ts)")} AS partition_date
FROM counted s JOIN device_rows d ON s.device_id = d.device_id
WHERE d.device_type = 'temperature'
  AND date_trunc('minute', s.ts) + INTERVAL 1 MINUTE <= (SELECT max(ts) - INTERVAL 10 SECOND FROM counted)
GROUP BY ALL""")


STREAM_ORACLE = {
    # Every change leaves with the image that its document had before; a delete of a document not seen before names its key only.
    "stream_capture_devices": query([EVENTS, DEVICE_CHANGES], f"""
, images AS (SELECT event_id AS n, ts_ms, op, {_AFTER} FROM dev_ops),
pairs AS (
  SELECT i.n, ts_ms, op, _id, i AS a, lag(CASE WHEN op <> 'd' THEN i END) OVER (PARTITION BY _id ORDER BY ts_ms, i.n) AS b FROM images i),
place AS (SELECT *, (ts_ms // 1000) * 1000 AS ms, ((ts_ms % 1000) * 4 + 1) * 2 AS pos FROM pairs)
SELECT '+I' AS row_kind, ms, pos + 1 AS pos, _id, {", ".join(f"a.{c} AS {c}" for c in _split(DEVICE_COLUMNS))} FROM place WHERE op <> 'd'
UNION ALL
SELECT '-D', ms, pos, _id, {", ".join(f"b.{c}" for c in _split(DEVICE_COLUMNS))} FROM place WHERE op = 'd' OR b IS NOT NULL"""),
    "stream_capture_initial": ORACLE["cdc_snapshot_union_changes"],
    "stream_capture_to_readings_by_day": ORACLE["upsert_readings_by_day"],
    "stream_devices_raw": ORACLE["raw_devices_append"],
    "stream_readings_raw": ORACLE["raw_readings_append"],
    "stream_restart_readings": ORACLE["raw_readings_append"],
    "stream_enriched_within_ttl": _within(),
    "stream_enriched_quiet_devices": _within(f"d.pos <= {_HALF}"),
    "stream_unmatched_readings": query([EVENTS, DEVICE_CHANGES, READING_ROWS], f"""
SELECT mongo_id, reading_id, device_id, sensor_value, unit, quality, "timestamp" AS reading_timestamp, battery_level, event_timestamp,
       {CDC_TS.format('event_timestamp')} AS cdc_ts, {DAY.format('event_timestamp')} AS partition_date
FROM reading_rows s
WHERE reading_id IS NOT NULL AND event_timestamp < {_DUE} AND NOT EXISTS (
  SELECT 1 FROM device_changes d
  WHERE d.row_kind = '+I' AND d.pos % 3 <> 0 AND d.pos % 5 <> 0 AND d.pos <= {_HALF} AND d.device_id = s.device_id
    AND abs(epoch_us(s.event_timestamp) // 1000 - d.ms) <= 7200000)"""),
    "stream_temperature_minute": _minutes("true"),
    "stream_late_readings": _minutes(f"NOT ({_LATE})"),
    "stream_late_counts": query([EVENTS, f"""
batches AS (
  SELECT *, CASE WHEN {_LATE} THEN 2 ELSE {_BATCH.format(k='event_id', t='events')} END AS batch_id, {_LATE} AS late FROM ev)"""], f"""
SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS records, 0::BIGINT AS no_operation, 0::BIGINT AS unknown_operation,
       count(*) FILTER (WHERE event_id % 29 = 28 AND event_id % 19 <> 18) AS no_image,
       count(DISTINCT CASE WHEN late AND {_COUNTED} THEN (date_trunc('minute', ts), user_id) END) AS late
FROM batches GROUP BY batch_id"""),
    "stream_decode_counts": f"""
SELECT CAST({_BATCH.format(k='c_custkey', t='customer')} AS BIGINT) AS batch_id, count(*) AS records,
       count(*) FILTER (WHERE c_custkey % 37 = 36) AS no_operation, 0::BIGINT AS unknown_operation,
       count(*) FILTER (WHERE c_custkey % 37 <> 36 AND c_custkey % 29 = 28 AND c_custkey % 19 <> 18) AS no_image
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
    "stream_upsert_devices": ORACLE["upsert_devices_by_day"],
    "stream_upsert_readings": ORACLE["upsert_readings_by_day"],
    "stream_upsert_enriched": ORACLE["upsert_enriched_by_day"],
    "stream_capture_readings": query([EVENTS, READING_CHANGES], f"""
SELECT CASE WHEN row_kind IN ('-U', '-D') THEN '-D' ELSE '+I' END AS row_kind, (ms // 1000) * 1000 AS ms,
       ((ms % 1000) * 4 + pos % 3 + 1) * 2 + ord AS pos, _id, {READING_COLUMNS} FROM reading_changes"""),
    "stream_search_devices": _held("search_docs_devices"),
    "stream_search_readings": _held("search_docs_readings"),
    "stream_search_enriched": _held("search_docs_enriched"),
    "stream_search_direct_devices": _held("search_docs_devices"),
    "stream_search_direct_readings": _held("search_docs_readings"),
    "stream_search_direct_enriched": _held("search_docs_enriched_direct"),
}

ORACLE = {**ORACLE, **LAKE_ORACLE, **STREAM_ORACLE}
