"""One batch query per operator, over the given tables.

Each takes ``(spark, sf_dir)`` and returns a DataFrame; nothing runs until it is used,
apart from the ``lake_*`` queries, which write the table they then read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import functions as fn
from tidelog import schemas
from tidelog.operators import change_events, changelog, decode_rows, enrich, search, tables, windows
from tidelog.plans import views
from tidelog.sinks import bulk
from tidelog.sinks.change_log import broker_rows
from tidelog.sources.records import kafka_records

_DEVICE_KEYS = ["device_id", "partition_date"]
_READING_KEYS = ["reading_id", "partition_date"]


def _zoneless_event(df: DataFrame) -> DataFrame:
    return df.withColumn("event_timestamp", fn.zoneless(F.col("event_timestamp")))


def _payload_only(df: DataFrame) -> DataFrame:
    return df.drop("row_kind", "seq")


def _order_columns(df: DataFrame) -> DataFrame:
    """The parts of ``seq`` as flat columns."""
    return df.withColumns({"ms": F.col("seq.ms"), "pos": F.col("seq.pos"), "ord": F.col("seq.ord")}).drop("seq")


# Decoding ------------------------------------------------------------------

def decode_envelope_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless_event(decode_rows.device_rows(views.device_topic(spark, sf_dir), views.fixed_now()))


def decode_envelope_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _zoneless_event(decode_rows.reading_rows(views.reading_topic(spark, sf_dir), views.fixed_now()))


def event_time_from_ts_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = decode_rows.parse_envelope(views.reading_topic(spark, sf_dir), schemas.READINGS).select("change.*")
    at = fn.event_time(F.col("ts_ms"), views.fixed_now())
    return parsed.select(F.col("after._id").alias("mongo_id"), "op", fn.zoneless(at).alias("event_time"))


def insert_only_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = decode_rows.parse_envelope(views.reading_topic(spark, sf_dir), schemas.READINGS)
    return changelog.insert_only(parsed).select(F.col("after._id").alias("mongo_id"), "op", "ts_ms")


# Change logs ---------------------------------------------------------------

def changelog_undecodable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.undecodable(views.device_topic(spark, sf_dir), schemas.DEVICES).drop("value")


def changelog_decode_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_columns(views.device_changes(spark, sf_dir))


def changelog_decode_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_columns(views.reading_changes(spark, sf_dir))


def changelog_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written records, read back with Spark's JSON functions."""
    records = changelog.encode(views.device_changes(spark, sf_dir), schemas.DEVICES)
    change = F.from_json("value", schemas.envelope(schemas.DEVICES)).alias("change")
    parsed = records.select("key", F.col("seq.pos").alias("pos"), F.col("seq.ord").alias("ord"), change)
    return parsed.select(
        "key", "pos", "ord", "change.op",
        F.col("change.before._id").alias("before_id"),
        F.col("change.before.temperature_threshold").alias("before_threshold"),
        F.col("change.before.updated_at").alias("before_updated_at"),
        F.col("change.after._id").alias("after_id"),
        F.col("change.after.temperature_threshold").alias("after_threshold"),
        F.col("change.after.updated_at").alias("after_updated_at"),
    )


def changelog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode, encode, decode: images survive, updates have become delete + create."""
    records = changelog.encode(views.reading_changes(spark, sf_dir), schemas.READINGS).select(
        "value", F.col("seq.part").alias("part"),
        (F.col("seq.pos") * 2 + F.col("seq.ord")).alias("pos"), F.col("seq.ms").alias("record_ms"))
    return _order_columns(changelog.decode(records, schemas.READINGS))


def cdc_snapshot_union_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The device collection, then its change events; current documents come out."""
    changes = change_events.decode_change_events(views.device_change_events(spark, sf_dir), schemas.DEVICES)
    log = changelog.snapshot_then_changes(views.device_documents(spark, sf_dir), changes, schemas.DEVICES)
    return _payload_only(changelog.current_state(log, ["_id"]))


def current_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _payload_only(changelog.current_state(views.device_changes(spark, sf_dir), ["_id"]))


def current_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _payload_only(changelog.current_state(views.reading_changes(spark, sf_dir), ["_id"]))


def changelog_same_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current readings where all changes of a document happen in one millisecond."""
    changes = changelog.decode(views.reading_change_records(spark, sf_dir, at="ts_ms"), schemas.READINGS)
    return _payload_only(changelog.current_state(changes, ["_id"]))


def current_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.current_enriched(
        views.device_changes(spark, sf_dir), views.reading_changes(spark, sf_dir), ["_id"],
        enrich.LOG_TIMES, views.fixed_now())
    return _payload_only(joined)


# Scalars -------------------------------------------------------------------

def severity_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings, devices = views.readings(spark, sf_dir), views.devices(spark, sf_dir)
    joined = readings.select("reading_id", "device_id", "sensor_value").join(
        devices.select("device_id", "temperature_threshold"), "device_id")
    return joined.withColumn("severity", fn.severity(F.col("sensor_value"), F.col("temperature_threshold")))


def cdc_ts_and_partition_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = fn.zoneless(F.col("event_timestamp"))
    return views.readings(spark, sf_dir).select(
        "mongo_id", fn.cdc_ts(at).alias("cdc_ts"), fn.partition_date(at).alias("partition_date"),
        fn.partition_date(F.nullif(at, at)).alias("unknown_date"))


# Append tables -------------------------------------------------------------

def raw_devices_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.devices_raw(decode_rows.device_rows(views.device_topic(spark, sf_dir), views.fixed_now()))


def raw_readings_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.readings_raw(decode_rows.reading_rows(views.reading_topic(spark, sf_dir), views.fixed_now()))


def enriched_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    devices = decode_rows.device_rows(views.device_topic(spark, sf_dir), views.fixed_now())
    readings = decode_rows.reading_rows(views.reading_topic(spark, sf_dir), views.fixed_now())
    return tables.enriched_raw(enrich.enrich_append(devices, readings))


def devices_left_join_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = enrich.devices_with_readings(views.devices(spark, sf_dir), views.readings(spark, sf_dir))
    return _zoneless_event(joined)


def enriched_within_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = views.device_changes(spark, sf_dir).where(
        F.col("row_kind").isin(changelog.INSERT, changelog.AFTER_UPDATE))
    devices = images.withColumnRenamed("_id", "mongo_id").withColumn(
        "event_timestamp", F.timestamp_millis("seq.ms"))
    joined = enrich.enrich_within(devices, views.readings(spark, sf_dir))
    return _zoneless_event(joined)


def temperature_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _temperature(spark, sf_dir, "1 minute")


def temperature_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _temperature(spark, sf_dir, "1 day")


def _temperature(spark: SparkSession, sf_dir: str, size: str) -> DataFrame:
    rows = windows.temperature_per_window(views.readings(spark, sf_dir), views.devices(spark, sf_dir), size)
    return rows.withColumn("avg_temperature", F.round("avg_temperature", 6))


# Keyed tables --------------------------------------------------------------

def upsert_devices_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = tables.devices_by_day(views.device_changes(spark, sf_dir), views.fixed_now())
    return _payload_only(changelog.current_state(changes, _DEVICE_KEYS))


def upsert_readings_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = tables.readings_by_day(views.reading_changes(spark, sf_dir), views.fixed_now())
    return _payload_only(changelog.current_state(changes, _READING_KEYS))


def upsert_enriched_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = tables.with_reading_day(views.reading_changes(spark, sf_dir), views.fixed_now())
    joined = enrich.current_enriched(
        views.device_changes(spark, sf_dir), readings, _READING_KEYS, enrich.LOG_TIMES, views.fixed_now())
    return joined.select(*schemas.ENRICHED_BY_DAY)


# Search documents ----------------------------------------------------------

def _opened(actions: DataFrame, fields: list[str]) -> DataFrame:
    """Actions with their JSON documents read back into typed columns."""
    doc = F.from_json("doc", schemas.table_schema(fields)).alias("doc")
    opened = actions.select("_index", F.col("_id").alias("doc_id"), "action", "version", doc)
    return opened.select("_index", "doc_id", "action", "version", "doc.*")


def search_docs_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = search.documents(views.device_changes(spark, sf_dir), "iot_devices", schemas.DEVICE_DOC)
    return _opened(actions, schemas.DEVICE_DOC)


def search_docs_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions = search.documents(views.reading_changes(spark, sf_dir), "iot_sensor_readings", schemas.READING_DOC)
    return _opened(actions, schemas.READING_DOC)


def _enriched_actions(spark: SparkSession, sf_dir: str, index: str, fields: list[str],
                      times: list[str]) -> DataFrame:
    winners = enrich.device_winners(changelog.current_state(views.device_changes(spark, sf_dir), ["_id"]))
    latest = changelog.latest_changes(views.reading_changes(spark, sf_dir), ["_id"])
    joined = enrich.join_winners(latest, winners, times, views.fixed_now(), how="left")
    return search.search_actions(enrich.mark_unmatched(joined), index, ["reading_mongo_id"], fields)


def search_docs_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = schemas.ENRICHED_DOC
    return _opened(_enriched_actions(spark, sf_dir, "iot_enriched_data", fields, enrich.LOG_TIMES), fields)


def search_docs_enriched_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = schemas.ENRICHED_DIRECT_DOC
    return _opened(_enriched_actions(spark, sf_dir, "devices_readings", fields, enrich.DIRECT_TIMES), fields)


def search_doc_id_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = tables.readings_by_day(views.reading_changes(spark, sf_dir), views.fixed_now())
    state = changelog.current_state(changes, _READING_KEYS)
    return state.select("mongo_id", fn.document_id(*[F.col(k) for k in _READING_KEYS]).alias("doc_id"))


def search_bulk_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which request each action goes with, at 100 actions or 16 KB a request."""
    actions = search.documents(views.reading_changes(spark, sf_dir), "iot_sensor_readings", schemas.READING_DOC)
    return bulk.flushes(actions, max_actions=100, max_bytes=16_384, lanes=4).select(
        "lane", "request", F.col("_id").alias("doc_id"), "action", "n_bytes")


def changelog_capture_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time at which a record was written, through the broker's headers and back into the decoded rows."""
    sent = broker_rows(views.reading_changes(spark, sf_dir), schemas.READINGS, views.fixed_now())
    returned = sent.select(
        F.encode("value", "utf-8").alias("value"), "headers", F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"))
    rows = changelog.decode(kafka_records(returned), schemas.READINGS, captured=True)
    return rows.select("row_kind", "_id", "sensor_value", "captured_ms")


BATCH_QUERIES = {
    query.__name__: query
    for query in (
        decode_envelope_devices, decode_envelope_readings, event_time_from_ts_ms, insert_only_filter,
        changelog_undecodable, changelog_decode_devices, changelog_decode_readings, changelog_encode, changelog_roundtrip,
        cdc_snapshot_union_changes, current_devices, current_readings, changelog_same_instant, current_enriched,
        severity_classify, cdc_ts_and_partition_date,
        raw_devices_append, raw_readings_append, enriched_append, devices_left_join_readings,
        enriched_within_ttl, temperature_minute, temperature_day,
        upsert_devices_by_day, upsert_readings_by_day, upsert_enriched_by_day,
        search_docs_devices, search_docs_readings, search_docs_enriched, search_docs_enriched_direct,
        search_doc_id_composite, search_bulk_requests, changelog_capture_time,
    )
}
