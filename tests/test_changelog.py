"""The change-log cases: decode, encode, current state."""

from __future__ import annotations

import json
import random
from datetime import datetime

import pytest
from fixtures import change, cluster_time, device, fixed_now, frame, reading, record
from pyspark.sql import functions as F

from tidelog.functions import document_id, partition_date, payload_time, severity
from tidelog.operators import decode_rows, enrich, tables
from tidelog.operators.change_events import decode_change_events
from tidelog.operators.changelog import (
    current_state,
    decode,
    encode,
    snapshot_then_changes,
)
from tidelog.operators.search import documents
from tidelog.schemas import DEVICE_DOC, DEVICES, READINGS

V1, V2 = device(threshold=30.0), device(threshold=40.0, updated="2025-01-01 11:00:00.000")
V2_NEXT_DAY = device(threshold=40.0, updated="2025-01-02 11:00:00.000")


def kinds(spark, *values):
    rows = decode(frame(spark, [record(v, i + 1) for i, v in enumerate(values)]), DEVICES)
    return [(r.row_kind, r.temperature_threshold) for r in rows.orderBy("seq").collect()]


def state(spark, records, keyed=True):
    rows = current_state(decode(frame(spark, records), DEVICES, keyed), ["_id"]).collect()
    return {r._id: r.temperature_threshold for r in rows}


@pytest.mark.parametrize("value,expected", [
    (change("c", None, V1), [("+I", 30.0)]),
    (change("r", None, V1), [("+I", 30.0)]),
    (change("u", V1, V2), [("-U", 30.0), ("+U", 40.0)]),
    (change("u", None, V2), [("+U", 40.0)]),
    (change("d", V1, None), [("-D", 30.0)]),
    (change("c", None, None), []),
    (change("x", V1, V2), []),
    ("garbage", []),
    ("", []),
    ("[1]", []),
])
def test_decode(spark, value, expected):
    assert kinds(spark, value) == expected


@pytest.mark.parametrize("values,expected", [
    ([change("c", None, V1)], {"d1": 30.0}),
    ([change("c", None, V1), change("u", V1, V2)], {"d1": 40.0}),
    ([change("c", None, V1), change("d", V1), change("c", None, V2)], {"d1": 40.0}),
    ([change("c", None, V1), change("d", V1)], {}),
])
def test_state_does_not_depend_on_arrival(spark, values, expected):
    records = [record(v, i + 1) for i, v in enumerate(values)]
    assert state(spark, records) == expected
    assert state(spark, records + records[-1:]) == expected
    random.Random(7).shuffle(records)
    assert state(spark, records) == expected


def test_position_decides_within_one_millisecond(spark):
    steps = [change("c", None, V1, 5), change("u", V1, V2, 5), change("d", V2, None, 5), change("c", None, V1, 5)]
    for n, expected in enumerate([{"d1": 30.0}, {"d1": 40.0}, {}, {"d1": 30.0}], 1):
        records = [record(v, i) for i, v in enumerate(steps[:n])]
        assert state(spark, records) == expected
        assert state(spark, records[::-1]) == expected


def test_delete_and_create_at_the_same_time_is_an_update_in_a_log_without_keys(spark):
    pair = [record(change("d", V1, None, 5), 9, part=1), record(change("c", None, V2, 5), 3, part=0)]
    first = record(change("c", None, V1, 1), 1)
    assert state(spark, [first, *pair], keyed=False) == {"d1": 40.0}


def test_encode_writes_updates_as_delete_and_create(spark):
    records = encode(decode(frame(spark, [record(change("u", V1, V2), 1)]), DEVICES), DEVICES)
    written = [json.loads(r.value) for r in records.orderBy("seq").collect()]
    assert written == [{"before": V1, "after": None, "op": "d"}, {"before": None, "after": V2, "op": "c"}]


def test_encode_keeps_nulls(spark):
    doc = device(location=None, battery_level=None)
    value = encode(decode(frame(spark, [record(change("c", None, doc), 1)]), DEVICES), DEVICES).first().value
    assert json.loads(value)["after"] == doc


def test_append_tables_take_rewritten_but_not_native_updates(spark):
    native = frame(spark, [record(change("u", V1, V2), 1)])
    assert decode_rows.device_rows(native, fixed_now()).count() == 0
    rewritten = encode(decode(native, DEVICES), DEVICES).select("value")
    assert [r.temperature_threshold for r in decode_rows.device_rows(rewritten, fixed_now()).collect()] == [40.0]


def by_day(spark, values, **how):
    records = frame(spark, [record(v, i + 1) for i, v in enumerate(values)])
    changes = tables.devices_by_day(decode(records, DEVICES), fixed_now(), **how)
    rows = current_state(changes, ["device_id", "partition_date"])
    return {r.partition_date: r.temperature_threshold for r in rows.collect()}


def test_update_on_another_day_moves_the_row(spark):
    """A native update and the delete + create that the log writes for it have one result."""
    values = [change("c", None, V1), change("u", V1, V2_NEXT_DAY)]
    assert by_day(spark, values) == {"2025-01-02": 40.0}
    assert by_day(spark, [values[0], change("d", V1), change("c", None, V2_NEXT_DAY)]) == {"2025-01-02": 40.0}
    assert by_day(spark, [values[0], change("u", V1, V2)]) == {"2025-01-01": 40.0}
    assert by_day(spark, [*values, change("d", V2_NEXT_DAY)]) == {}


def test_update_on_another_day_adds_a_row_if_old_days_are_kept(spark):
    values = [change("c", None, V1), change("u", V1, V2_NEXT_DAY)]
    assert by_day(spark, values, keep_old_days=True) == {"2025-01-01": 30.0, "2025-01-02": 40.0}
    assert by_day(spark, [*values, change("d", V2_NEXT_DAY)], keep_old_days=True) == {"2025-01-01": 30.0}


def test_update_that_takes_the_reading_id_away(spark):
    devices = decode(frame(spark, [record(change("c", None, V1), 1)]), DEVICES)
    log = decode(frame(spark, [record(change("c", None, reading()), 1),
                               record(change("u", reading(), reading(reading_id=None)), 2)]), READINGS)
    assert enrich.current_enriched(devices, log, ["_id"]).count() == 0
    by_day = tables.with_reading_day(log, fixed_now())
    assert enrich.current_enriched(devices, by_day, ["reading_id", "partition_date"]).count() == 0
    assert current_state(tables.readings_by_day(log, fixed_now()), ["reading_id", "partition_date"]).count() == 0


def test_initial_snapshot_precedes_changes(spark):
    typed = decode(frame(spark, [record(change("c", None, V1), 1), record(change("c", None, device("d2")), 2)]), DEVICES)
    events = frame(spark, [
        record(json.dumps({"operationType": "update", "documentKey": {"_id": "d1"}, "fullDocument": V2,
                           "fullDocumentBeforeChange": V1, "clusterTime": cluster_time(10)}), 1),
        record(json.dumps({"operationType": "delete", "documentKey": {"_id": "d2"}, "clusterTime": cluster_time(11)}), 2),
        record(json.dumps({"operationType": "insert", "documentKey": {"_id": "d3"},
                           "fullDocument": device("d3", threshold=1.0), "clusterTime": cluster_time(12)}), 3),
        record(json.dumps({"operationType": "drop"}), 4),
    ])
    log = snapshot_then_changes(typed.drop("row_kind", "seq"), decode_change_events(events, DEVICES), DEVICES)
    assert {r._id: r.temperature_threshold for r in current_state(log, ["_id"]).collect()} == {"d1": 40.0, "d3": 1.0}


@pytest.mark.parametrize("text,expected", [
    ("2025-01-01 10:00:00.250", datetime(2025, 1, 1, 10, 0, 0, 250000)),
    ("2025-01-01 10:00:00", datetime(2025, 1, 1, 10)),
    ("2025-01-01 10:00:00.2505", None),
    ("2025-01-01T10:00:00.250", None),
    ("2025-01-01 10:00:00 UTC", None),
    ("2025-02-30 10:00:00.000", None),
    ("bad", None),
    (None, datetime(2025, 6, 1, 0, 0, 0, 500000)),
])
def test_payload_time(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(payload_time(F.col("t"), fixed_now()).alias("t")).first().t == expected


@pytest.mark.parametrize("value,threshold,expected", [
    (30.0, 30.0, "NORMAL"), (30.1, 30.0, "WARNING"), (35.0, 30.0, "WARNING"), (35.1, 30.0, "CRITICAL"),
    (None, 30.0, "NORMAL"), (99.0, None, "NORMAL"),
])
def test_severity(spark, value, threshold, expected):
    df = spark.createDataFrame([(value, threshold)], "v double, t double")
    assert df.select(severity(F.col("v"), F.col("t"))).first()[0] == expected


def test_document_id_and_default_day(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(document_id(F.col("x"), F.col("y"))).collect()] == ["a$b", None]
    assert df.select(partition_date(F.lit(None).cast("timestamp_ntz"))).first()[0] == "2025-01-01"


def test_threshold_change_and_duplicate_device_id(spark):
    readings = decode(frame(spark, [record(change("c", None, reading()), 1)]), READINGS)

    def enriched(*device_values):
        devices = decode(frame(spark, [record(v, i + 1) for i, v in enumerate(device_values)]), DEVICES)
        return [(r.device_mongo_id, r.severity) for r in enrich.current_enriched(devices, readings, ["_id"]).collect()]

    assert enriched(change("c", None, V1)) == [("d1", "WARNING")]
    assert enriched(change("c", None, V1), change("u", V1, V2)) == [("d1", "NORMAL")]
    other = device("d0", threshold=10.0)
    assert enriched(change("c", None, V1), change("c", None, other)) == [("d0", "CRITICAL")]
    assert enriched(change("c", None, V1), change("d", V1)) == []


def test_append_join_keeps_every_pair_and_drops_readings_without_id(spark):
    devices = decode_rows.device_rows(frame(spark, [
        record(change("c", None, V1, 1), 1), record(change("c", None, device("d9"), 1), 2)]), fixed_now())
    readings = decode_rows.reading_rows(frame(spark, [
        record(change("c", None, reading(), 1), 1), record(change("c", None, reading("r2", None), 1), 2)]), fixed_now())
    assert readings.count() == 2
    assert enrich.enrich_append(devices, readings).count() == 2


def test_documents_are_whole_json(spark):
    log = decode(frame(spark, [record(change("c", None, V1, 7), 1)]), DEVICES)
    action = documents(log, "iot_devices", DEVICE_DOC).first()
    expected = {"mongo_id" if k == "_id" else k: v for k, v in V1.items()}
    assert (action._id, action.action, action.version, json.loads(action.doc)) == ("d1", "index", 15, expected)
