"""Document-database events: their order, complete images, and the start with a snapshot in one job."""

from __future__ import annotations

import json

import pytest
from fixtures import cluster_time, device, fixed_now, frame, reading, record, write_records
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.operators import changelog
from tidelog.operators.change_events import change_records, decode_change_events
from tidelog.sources.records import connector_records, read_change_events, read_records
from tidelog.streaming import Trigger, start_capture, start_upsert_lake
from tidelog.streaming.capture import start_position
from tidelog.streaming.images import patched
from tidelog.streaming.queries import finish
from tidelog.streaming.upsert_lake import keyed_table

ONCE = Trigger(available_now=True)


def event(kind, doc, n, after=None, before=None, sets=None, removes=(), token=None, second=1):
    body = {"operationType": kind, "documentKey": {"_id": doc}, "fullDocument": after, "fullDocumentBeforeChange": before,
            "clusterTime": {"$timestamp": {"t": second, "i": n}}, "_id": {"_data": token or f"{second:08x}{n:08x}"}}
    if sets is not None or removes:
        body["updateDescription"] = {"updatedFields": sets or {}, "removedFields": list(removes)}
    return record(json.dumps(body), n)


def capture(spark, tmp_path, only="capture_readings", **how):
    """Run the capture over what is there; the whole log so far comes back."""
    sources = []
    for name in ("dev", "read"):
        write_records(tmp_path / name, [], "0")
        sources.append(read_change_events(spark, streaming=True, path=str(tmp_path / name), maxFilesPerTrigger="1"))
    finish(start_capture(*sources, *[{"path": str(tmp_path / "log" / n)} for n in ("capture_devices", "capture_readings")],
                         str(tmp_path / "cp"), ONCE, fixed_now(), only=[only], **how))
    payload = schemas.DEVICES if only == "capture_devices" else schemas.READINGS
    return changelog.decode(read_records(spark, path=str(tmp_path / "log" / only)), payload)


def values(log):
    return [(r.row_kind, r._id, r.sensor_value) for r in log.orderBy("seq").collect()]


def test_cluster_time_and_token_order_changes_of_one_second(spark):
    """The order in the file says nothing: increment first, then the token, as within a transaction."""
    events = [event("update", "r1", 2, reading(value=4.0), token="0b"), event("insert", "r1", 1, reading(value=1.0)),
              event("update", "r1", 2, reading(value=3.0), token="0a"), event("update", "r1", 7, reading(value=5.0)), event("update", "r1", 10, reading(value=6.0))]
    log = decode_change_events(frame(spark, events), schemas.READINGS)
    assert [r.sensor_value for r in log.orderBy("seq").collect()] == [1.0, 3.0, 4.0, 5.0, 6.0]
    assert changelog.current_state(log, ["_id"]).first().sensor_value == 6.0


def test_rows_as_the_connector_hands_them_out(spark):
    """Every field but the operation is a JSON document in text, with extended types."""
    doc = reading()
    for name in ("timestamp", "created_at", "updated_at"):
        doc[name] = {"$date": "2025-01-01T10:05:00.250Z"}
    doc["_id"] = {"$oid": "65a0"}
    row = ('{"_data": "8265"}', "insert", '{"_id": {"$oid": "65a0"}}', json.dumps(doc), None, None, '{"$timestamp": {"t": 1704067200, "i": 3}}')
    rows = connector_records(spark.createDataFrame([row], schemas.CHANGE_EVENT))
    change = change_records(rows, schemas.READINGS).first()
    assert (change._id, change.op, change.ms, change.pos, change.token) == ("65a0", "c", 1704067200000, 3, "8265")
    typed = decode_change_events(rows, schemas.READINGS).first()
    assert typed._id == "65a0" and str(typed.timestamp) == "2025-01-01 10:05:00.250000" and typed.battery_level == 85


def test_events_that_change_no_document(spark):
    events = [record(json.dumps({"operationType": "drop", "clusterTime": cluster_time(1)}), 1), record("garbage", 2), record("{}", 3),
              event("invalidate", "r1", 4), event("insert", None, 5, reading())]
    assert change_records(frame(spark, events), schemas.READINGS).count() == 0


def test_images_are_restored(spark, tmp_path):
    """Deletes that name a key, updates that name fields, also in a later run."""
    write_records(tmp_path / "read", [event("insert", "r1", 1, reading(value=1.0)), event("insert", "r2", 2, reading("r2", "R2", value=2.0))], "1")
    write_records(tmp_path / "read", [event("update", "r1", 3, sets={"sensor_value": 1.5, "updated_at": {"$date": "2025-01-01T11:00:00Z"}, "other": 1})], "2")
    assert values(capture(spark, tmp_path)) == [("+I", "r1", 1.0), ("+I", "r2", 2.0), ("-D", "r1", 1.0), ("+I", "r1", 1.5)]
    write_records(tmp_path / "read", [event("delete", "r1", 4), event("update", "r2", 5, removes=["sensor_value"])], "3")
    log = capture(spark, tmp_path)
    assert values(log)[4:] == [("-D", "r1", 1.5), ("-D", "r2", 2.0), ("+I", "r2", None)]
    last = log.where("row_kind = '-D' AND sensor_value = 1.5").first()
    assert str(last.updated_at) == "2025-01-01 11:00:00" and last.reading_id == "R1"


def test_replays_and_late_changes_go(spark, tmp_path):
    first, second = event("insert", "r1", 1, reading(value=1.0)), event("replace", "r1", 3, reading(value=3.0))
    write_records(tmp_path / "read", [second, first], "1")
    write_records(tmp_path / "read", [first, second, event("update", "r1", 2, reading(value=2.0)), event("delete", "r1", 4)], "2")
    write_records(tmp_path / "read", [event("update", "r1", 3, reading(value=9.0)), event("delete", "r9", 5), event("update", "r8", 6, sets={"sensor_value": 1.0})], "3")
    write_records(tmp_path / "read", [event("insert", "r1", 7, reading(value=7.0)), event("insert", "r1", 8, reading(value=8.0))], "4")
    assert values(capture(spark, tmp_path)) == [
        ("+I", "r1", 1.0), ("-D", "r1", 1.0), ("+I", "r1", 3.0), ("-D", "r1", 3.0), ("-D", "r9", None),
        ("+I", "r1", 7.0), ("-D", "r1", 7.0), ("+I", "r1", 8.0)]


def test_without_images_events_leave_as_they_are(spark, tmp_path):
    write_records(tmp_path / "read", [event("insert", "r1", 1, reading(value=1.0)), event("delete", "r1", 2)], "1")
    assert values(capture(spark, tmp_path, images=False)) == [("+I", "r1", 1.0), ("-D", "r1", None)]


def test_patches():
    assert patched(None, '{"a": 1}', None) is None
    assert json.loads(patched('{"a": 1, "b": "é", "t": null}', '{"a": 2, "x": 3, "t": {"$date": "2025-01-01T10:00:00Z"}}', ["b"])) == {
        "a": 2, "b": None, "t": "2025-01-01 10:00:00.000"}
    assert patched('{"a": 1}', None, None) == '{"a": 1}'


def test_a_key_only_delete_reaches_the_table_by_day(spark, tmp_path):
    day = "2025-01-02 10:05:00.000"
    write_records(tmp_path / "read", [event("insert", "r1", 1, reading()), event("insert", "r2", 2, reading("r2", "R2"))], "1")
    write_records(tmp_path / "read", [event("update", "r2", 3, sets={"timestamp": day}), event("delete", "r1", 4)], "2")
    capture(spark, tmp_path)
    log = read_records(spark, streaming=True, path=str(tmp_path / "log" / "capture_readings"))
    finish(start_upsert_lake(spark, log, log, str(tmp_path / "lake"), ONCE, fixed_now(), only=["iceberg_sensor_readings"]))
    rows = keyed_table(spark, str(tmp_path / "lake"), "iceberg_sensor_readings").current().collect()
    assert [(r.reading_id, r.partition_date) for r in rows] == [("R2", "2025-01-02")]


def collection(spark, *docs):
    rows = changelog.decode(frame(spark, [record(json.dumps({"op": "c", "after": d}), i) for i, d in enumerate(docs)]), schemas.DEVICES)
    return rows.drop("row_kind", "seq")


def thresholds(log):
    return [(r.row_kind, r._id, r.temperature_threshold) for r in log.orderBy("seq", "_id").collect()]


def test_snapshot_and_changes_in_one_job(spark, tmp_path):
    """A change that falls between the position and the snapshot is in both; restarts lose and double nothing."""
    opened = []

    def read():
        opened.append(1)
        return collection(spark, device("d1", threshold=2.0), device("d2", threshold=5.0))

    def run():
        since = start_position(spark, str(tmp_path / "cp"), lambda: 10)
        return capture(spark, tmp_path, "capture_devices", since=since, collections={"capture_devices": read})

    write_records(tmp_path / "dev", [event("update", "d1", 1, device("d1", threshold=1.0), second=9), event("update", "d1", 2, device("d1", threshold=2.0), second=10)], "1")
    first = thresholds(run())
    # The event of second 9 is older than the position; that of second 10 comes out again, to the same image.
    assert first == [("+I", "d1", 2.0), ("+I", "d2", 5.0), ("-D", "d1", 2.0), ("+I", "d1", 2.0)]
    assert thresholds(run()) == first
    write_records(tmp_path / "dev", [event("delete", "d2", 3, second=11)], "2")
    assert thresholds(run()) == [*first, ("-D", "d2", 5.0)]
    assert len(opened) == 1


def test_a_stop_between_snapshot_and_stream(spark, tmp_path):
    """The job ends while the snapshot is written, and again after it: the next start goes on from there."""
    def broken():
        docs = collection(spark, device("d1"), device("d2"))
        return docs.withColumn("_id", F.when(F.col("_id") == "d2", F.raise_error(F.lit("lost"))).otherwise(F.col("_id")))

    def run(read):
        since = start_position(spark, str(tmp_path / "cp"), lambda: 10 + len(positions))
        positions.append(since)
        return capture(spark, tmp_path, "capture_devices", since=since, collections={"capture_devices": read})

    positions = []
    with pytest.raises(Exception, match="lost"):
        run(broken)
    write_records(tmp_path / "dev", [event("insert", "d3", 1, device("d3"), second=10)], "1")
    log = run(lambda: collection(spark, device("d1"), device("d2")))
    assert [r[:2] for r in thresholds(log)] == [("+I", "d1"), ("+I", "d2"), ("+I", "d3")]
    assert thresholds(run(broken)) == thresholds(log) and set(positions) == {10}
