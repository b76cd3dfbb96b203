"""The continuous jobs, run once over the given tables (``availableNow``).

The tables come as streams of several batches; each query returns what its job has written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog import schemas
from tidelog.operators import changelog, decode_rows
from tidelog.plans import views
from tidelog.session import fresh_dir
from tidelog.sinks.append import read_numbered
from tidelog.sources.lake import open_table
from tidelog.sources.records import read_records
from tidelog.streaming import Trigger, start_append_lake, start_capture, start_search, start_upsert_lake
from tidelog.streaming.capture import start_position
from tidelog.streaming.counts import batch_counts
from tidelog.streaming.queries import finish
from tidelog.streaming.upsert_lake import keyed_table

ONCE = Trigger(available_now=True)


def _capture(spark: SparkSession, sf_dir: str, name: str, payload: T.StructType) -> DataFrame:
    """Change events in, envelope records out; the records are decoded again."""
    root = fresh_dir(spark, "capture")
    _captured(spark, sf_dir, root, name)
    rows = changelog.decode(read_records(spark, path=f"{root}/{name}"), payload)
    return rows.withColumns({"ms": F.col("seq.ms"), "pos": F.col("seq.pos")}).drop("seq")


def stream_capture_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _capture(spark, sf_dir, "capture_devices", schemas.DEVICES)


def stream_capture_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _capture(spark, sf_dir, "capture_readings", schemas.READINGS)


def _captured(spark: SparkSession, sf_dir: str, root: str, only: str, **how) -> None:
    # The other collection's job is not started, so its events need not be laid out.
    events = (views.device_change_events if only == "capture_devices" else views.reading_change_events)(spark, sf_dir, streaming=True)
    finish(start_capture(
        events, events, {"path": f"{root}/capture_devices"}, {"path": f"{root}/capture_readings"}, f"{root}/_checkpoints", ONCE,
        views.fixed_now(), only=[only], **how))


def stream_capture_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collection and then its changes, captured in one job; the documents that stand at the end."""
    root = fresh_dir(spark, "initial")
    _captured(spark, sf_dir, root, "capture_devices", since=start_position(spark, f"{root}/_checkpoints", lambda: 0),
              collections={"capture_devices": lambda: views.device_documents(spark, sf_dir)})
    log = changelog.decode(read_records(spark, path=f"{root}/capture_devices"), schemas.DEVICES)
    return changelog.current_state(log, ["_id"]).drop("row_kind", "seq")


def stream_capture_to_readings_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Database events without images, captured into a log, into the table keyed by day: deletes and moves find their rows."""
    root = fresh_dir(spark, "captured")
    _captured(spark, sf_dir, root, "capture_readings")
    log = read_records(spark, streaming=True, path=f"{root}/capture_readings")
    finish(start_upsert_lake(spark, log, log, f"{root}/lake", ONCE, views.fixed_now(), only=["iceberg_sensor_readings"]))
    return keyed_table(spark, f"{root}/lake", "iceberg_sensor_readings").current()


def _append_lake(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    root = fresh_dir(spark, "append")
    finish(start_append_lake(
        views.device_topic(spark, sf_dir, streaming=True), views.reading_topic(spark, sf_dir, streaming=True),
        root, lambda: open_table(spark, f"{root}/devices_raw"), ONCE, views.fixed_now(), only=[name]))
    return open_table(spark, f"{root}/{name}", schemas.table_schema(schemas.APPEND_TABLES[name]))


def stream_devices_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _append_lake(spark, sf_dir, "devices_raw")


def stream_readings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _append_lake(spark, sf_dir, "sensor_readings_raw")


def stream_restart_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw readings' job stopped and started again after every part of the log: each record is there once."""
    root = fresh_dir(spark, "restart")
    for records in views.growing_reading_topic(spark, sf_dir):
        finish(start_append_lake(records, records, root, trigger=ONCE, now=views.fixed_now(), only=["sensor_readings_raw"]))
    return open_table(spark, f"{root}/sensor_readings_raw", schemas.table_schema(schemas.READINGS_RAW))


def _joined(spark: SparkSession, sf_dir: str, name: str, columns: list[str], devices: DataFrame, idle_seconds: int | None = None) -> DataFrame:
    root = fresh_dir(spark, "joined")
    finish(start_append_lake(
        devices, views.reading_topic(spark, sf_dir, streaming=True), root, trigger=ONCE, now=views.fixed_now(), only=[name],
        idle_seconds=idle_seconds))
    return open_table(spark, f"{root}/{name}", schemas.table_schema(columns))


def stream_enriched_within_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-stream join of created device images and readings, two hours apart at most."""
    return _joined(spark, sf_dir, "devices_readings", schemas.ENRICHED_RAW, views.device_change_records(spark, sf_dir, streaming=True))


def stream_enriched_quiet_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where the device stream stops half-way and only readings come."""
    return _joined(spark, sf_dir, "devices_readings", schemas.ENRICHED_RAW, views.early_device_records(spark, sf_dir))


def stream_unmatched_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings without a device within two hours, where the device stream stops half-way: all that are due come out."""
    return _joined(spark, sf_dir, "unmatched_readings", schemas.UNMATCHED_READINGS, views.early_device_records(spark, sf_dir), idle_seconds=30)


def stream_temperature_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that are closed once all input is taken, labelled from the job's own table of devices."""
    root = fresh_dir(spark, "temperature")
    devices, readings = views.device_topic(spark, sf_dir, streaming=True), views.timed_reading_topic(spark, sf_dir)
    for name in ("devices_raw", "temperature_readings_minute"):
        finish(start_append_lake(devices, readings, root, trigger=ONCE, now=views.fixed_now(), only=[name]))
    rows = read_numbered(spark, f"{root}/temperature_readings_minute", schemas.TEMPERATURE_MINUTE)
    return rows.withColumn("avg_temperature", F.round("avg_temperature", 6))


def _late(spark: SparkSession, sf_dir: str) -> tuple[str, StreamingQuery]:
    root = fresh_dir(spark, "late")
    # Only the aggregate is started, and it asks for devices in every batch: they are decoded once, on all cores.
    decode_rows.device_rows(views.device_topic(spark, sf_dir, spread=True), views.fixed_now()).write.parquet(f"{root}/devices")
    readings = views.late_reading_topic(spark, sf_dir)
    queries = start_append_lake(
        readings, readings, root, lambda: open_table(spark, f"{root}/devices"), ONCE, views.fixed_now(), only=["temperature_readings_minute"])
    finish(queries)
    return root, queries[0]


def stream_late_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows where some readings come after their window has closed: those are left out."""
    root, _ = _late(spark, sf_dir)
    rows = read_numbered(spark, f"{root}/temperature_readings_minute", schemas.TEMPERATURE_MINUTE)
    return rows.withColumn("avg_temperature", F.round("avg_temperature", 6))


def stream_late_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the same run, per batch: records, those that decode to nothing, and window totals that came too late."""
    _, query = _late(spark, sf_dir)
    rows = [(r["batch_id"], r["records"], r["no_operation"], r["unknown_operation"], r["no_image"], r["late"]) for r in batch_counts(query)]
    return spark.createDataFrame(rows, "batch_id long, records long, no_operation long, unknown_operation long, no_image long, late long").where(
        "records > 0")


def stream_decode_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per batch of the device log: records, and those that decode to nothing, by reason."""
    root = fresh_dir(spark, "counted")
    topic = views.device_topic(spark, sf_dir, streaming=True)
    queries = start_append_lake(topic, topic, root, trigger=ONCE, now=views.fixed_now(), only=["devices_raw"])
    finish(queries)
    rows = [(r["batch_id"], r["records"], r["no_operation"], r["unknown_operation"], r["no_image"]) for r in batch_counts(queries[0])]
    return spark.createDataFrame(rows, "batch_id long, records long, no_operation long, unknown_operation long, no_image long").where("records > 0")


def _upsert_lake(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    root = fresh_dir(spark, "upsert")
    finish(start_upsert_lake(
        spark, views.device_change_records(spark, sf_dir, streaming=True),
        views.reading_change_records(spark, sf_dir, streaming=True), root, ONCE, views.fixed_now(), only=[name]))
    return keyed_table(spark, root, name).current()


def stream_upsert_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_lake(spark, sf_dir, "iceberg_devices")


def stream_upsert_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_lake(spark, sf_dir, "iceberg_sensor_readings")


def stream_upsert_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_lake(spark, sf_dir, "iceberg_devices_readings_enriched")


def _search(spark: SparkSession, sf_dir: str, index: str, fields: list[str], direct: bool = False) -> DataFrame:
    """The documents of an index that a search service holds after all bulk requests."""
    root = fresh_dir(spark, "search")

    def keep(actions: DataFrame, index: str, batch_id: int) -> None:
        actions.write.mode("overwrite").parquet(f"{root}/{index}/batch_id={batch_id}")

    devices, readings = (
        (views.device_change_events, views.reading_change_events) if direct
        else (views.device_change_records, views.reading_change_records))
    finish(start_search(
        spark, devices(spark, sf_dir, streaming=True), readings(spark, sf_dir, streaming=True), root, direct,
        writer=keep, trigger=ONCE, now=views.fixed_now(), only=[index]))
    actions = spark.read.parquet(f"{root}/{index}").withColumn("batch_id", F.col("batch_id").cast("bigint"))
    newest = F.max(F.struct("version", "batch_id", "action", "doc")).alias("newest")
    held = actions.groupBy("_id").agg(newest).where(F.col("newest.action") == "index")
    doc = F.from_json("newest.doc", schemas.table_schema(fields)).alias("doc")
    return held.select(F.col("_id").alias("doc_id"), doc).select("doc_id", "doc.*")


def stream_search_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, "iot_devices", schemas.DEVICE_DOC)


def stream_search_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, "iot_sensor_readings", schemas.READING_DOC)


def stream_search_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, "iot_enriched_data", schemas.ENRICHED_DOC)


def stream_search_direct_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, "devices", schemas.DEVICE_DOC, direct=True)


def stream_search_direct_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, "sensor_readings", schemas.READING_DOC, direct=True)


def stream_search_direct_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, "devices_readings", schemas.ENRICHED_DIRECT_DOC, direct=True)


STREAM_QUERIES = {
    query.__name__: query
    for query in (
        stream_capture_devices, stream_capture_readings, stream_capture_initial, stream_capture_to_readings_by_day, stream_devices_raw, stream_readings_raw, stream_restart_readings, stream_enriched_within_ttl,
        stream_enriched_quiet_devices, stream_unmatched_readings, stream_temperature_minute,
        stream_late_readings, stream_late_counts, stream_decode_counts, stream_upsert_devices, stream_upsert_readings, stream_upsert_enriched,
        stream_search_devices, stream_search_readings, stream_search_enriched,
        stream_search_direct_devices, stream_search_direct_readings, stream_search_direct_enriched,
    )
}
