"""The continuous jobs over folders of records, batch by batch."""

from __future__ import annotations

import glob
import json

import pytest
from fixtures import SF
from fixtures import (
    BASE_MS,
    change,
    cluster_time,
    device,
    fixed_now,
    frame,
    reading,
    record,
    seed_device_records,
    seed_reading_records,
    write_records,
)
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.operators import changelog, decode_rows, tables
from tidelog.plans import views
from tidelog.sinks.append import read_numbered, write_append
from tidelog.sinks.catalog import create_append_tables, register_partitions
from tidelog.sinks.merge import merge_sql
from tidelog.sources.lake import open_table, register_lake
from tidelog.sources.records import read_change_events, read_records
from tidelog.streaming import Trigger, capture_snapshot, start_append_lake, start_capture, start_search, start_upsert_lake
from tidelog.streaming.append_lake import temperature_writer
from tidelog.streaming.queries import finish, start
from tidelog.streaming.upsert_lake import create_keyed_tables, keyed_states, keyed_table

ONCE = Trigger(available_now=True)


def stream(spark, path):
    return read_records(spark, streaming=True, path=str(path), maxFilesPerTrigger="1")


def minute_reading(i, minute, second=0, **more):
    doc = reading(f"r{i}", f"R{i}", at=f"2025-01-01 10:{minute:02d}:{second:02d}.000", **more)
    return record(change("c", None, doc, BASE_MS + minute * 60_000 + second * 1000), i)


def run_append(spark, tmp_path, only=None):
    root = str(tmp_path / "lake")
    finish(start_append_lake(stream(spark, tmp_path / "devices"), stream(spark, tmp_path / "readings"), root,
                             lambda: open_table(spark, f"{root}/devices_raw"), ONCE, fixed_now(), salts=3, only=only))
    return root


def windows_of(spark, root):
    rows = read_numbered(spark, f"{root}/temperature_readings_minute", schemas.TEMPERATURE_MINUTE).collect()
    return {(r.window_start.minute, r.device_id): r.reading_count for r in rows}


def test_append_lake_on_the_seed(spark, tmp_path):
    write_records(tmp_path / "devices", seed_device_records(), "0")
    write_records(tmp_path / "readings", seed_reading_records(), "0")
    root = run_append(spark, tmp_path, ["devices_raw"])
    run_append(spark, tmp_path, ["sensor_readings_raw", "devices_readings", "temperature_readings_minute"])
    # The window of the newest reading is still open.
    assert set(windows_of(spark, root)) == {
        (0, "LH-VVK-HV_CAM-04"), (0, "MP1-N5-D1_CAM-01"), (0, "MP3-NE8-DE6_CAM-01"),
        (5, "MP1-N5-D1_CAM-01"), (10, "MP1-N5-D1_CAM-01"), (15, "MP3-NE8-DE6_CAM-01")}
    views = {n: schemas.table_schema(c) for n, c in schemas.APPEND_TABLES.items() if n != "temperature_readings_minute"}
    register_lake(spark, root, views)
    counts = spark.sql("""SELECT (SELECT count(*) FROM devices_raw), (SELECT count(*) FROM sensor_readings_raw),
                          (SELECT count(*) FROM devices_readings), (SELECT max(severity) FROM devices_readings)""").first()
    assert tuple(counts) == (4, 8, 8, "WARNING")
    assert spark.table("devices_raw").schema["partition_date"].dataType.simpleString() == "string"


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    only = ["sensor_readings_raw", "devices_readings"]
    write_records(tmp_path / "devices", [record(change("c", None, device(), BASE_MS), 0)], "0")
    write_records(tmp_path / "readings", [minute_reading(0, 0), minute_reading(1, 1)], "0")
    root = run_append(spark, tmp_path, only)
    run_append(spark, tmp_path, only)
    write_records(tmp_path / "readings", [minute_reading(2, 2)], "1")
    run_append(spark, tmp_path, only)
    for name in only:
        ids = [r.reading_id for r in open_table(spark, f"{root}/{name}").select("reading_id").collect()]
        assert sorted(ids) == ["R0", "R1", "R2"], name


def test_late_rows_and_devices_that_arrive_meanwhile(spark, tmp_path):
    """A reading two batches behind the watermark is ignored; an idle device stream holds nothing
    back; a device that arrives before the window closes is part of it."""
    root, readings = str(tmp_path / "lake"), tmp_path / "readings"
    devices = tmp_path / "devices"
    write_records(devices, [record(change("c", None, device(), BASE_MS), 0)], "0")

    def run():
        rows = decode_rows.reading_rows(stream(spark, readings), fixed_now())
        known = lambda: decode_rows.device_rows(read_records(spark, path=str(devices)), fixed_now())
        finish([start(temperature_writer(rows, known, f"{root}/temperature_readings_minute"), "minute",
                      f"{root}/_checkpoints", ONCE)])

    write_records(readings, [minute_reading(0, 0), minute_reading(1, 1, 15), minute_reading(2, 1, 15, device_id="dev2")], "0")
    run()
    assert windows_of(spark, root) == {(0, "dev1"): 1}
    write_records(devices, [record(change("c", None, device("d2", "dev2"), BASE_MS), 1)], "1")
    write_records(readings, [minute_reading(3, 5)], "1")
    run()
    write_records(readings, [minute_reading(4, 6)], "2")
    write_records(readings, [minute_reading(5, 0, 30), minute_reading(6, 9)], "3")
    write_records(readings, [minute_reading(7, 12)], "4")
    run()
    assert windows_of(spark, root) == {
        (0, "dev1"): 1, (1, "dev1"): 1, (1, "dev2"): 1, (5, "dev1"): 1, (6, "dev1"): 1, (9, "dev1"): 1}


def test_all_append_queries_with_a_quiet_device_stream(spark, tmp_path):
    write_records(tmp_path / "devices", [], "0")
    write_records(tmp_path / "readings", [minute_reading(0, 0), minute_reading(1, 5)], "0")
    root = str(tmp_path / "lake")

    def run():
        finish(start_append_lake(stream(spark, tmp_path / "devices"), stream(spark, tmp_path / "readings"), root,
                                 trigger=ONCE, now=fixed_now(), salts=3))

    run()
    assert open_table(spark, f"{root}/sensor_readings_raw").count() == 2
    assert windows_of(spark, root) == {}
    write_records(tmp_path / "devices", [record(change("c", None, device(), BASE_MS), 0)], "1")
    run()
    write_records(tmp_path / "readings", [minute_reading(2, 9)], "1")
    run()
    assert windows_of(spark, root) == {(5, "dev1"): 1}


def test_old_device_images_count_in_the_append_variant(spark, tmp_path):
    images = [change("c", None, device(threshold=t), BASE_MS) for t in (30.0, 31.0, 32.0)]
    write_records(tmp_path / "devices", [record(v, i) for i, v in enumerate(images)], "0")
    write_records(tmp_path / "readings", [minute_reading(0, 0), minute_reading(1, 5)], "0")
    root = run_append(spark, tmp_path, ["devices_raw"])
    run_append(spark, tmp_path, ["temperature_readings_minute"])
    assert windows_of(spark, root) == {(0, "dev1"): 3}


def test_capture_writes_what_the_next_job_reads(spark, tmp_path):
    events = [
        {"operationType": "insert", "documentKey": {"_id": "d1"}, "fullDocument": device(), "clusterTime": cluster_time(1)},
        {"operationType": "update", "documentKey": {"_id": "d1"}, "fullDocument": device(threshold=40.0),
         "fullDocumentBeforeChange": device(), "clusterTime": cluster_time(2)},
    ]
    write_records(tmp_path / "dev", [record(json.dumps(e), i) for i, e in enumerate(events)], "0")
    write_records(tmp_path / "read", [record(json.dumps(
        {"operationType": "insert", "documentKey": {"_id": "r1"}, "fullDocument": reading(), "clusterTime": cluster_time(3)}), 0)], "0")
    sources = [read_change_events(spark, streaming=True, path=str(tmp_path / n)) for n in ("dev", "read")]
    finish(start_capture(*sources, {"path": str(tmp_path / "log" / "dev")}, {"path": str(tmp_path / "log" / "read")},
                         str(tmp_path / "cp"), ONCE, fixed_now()))
    log = changelog.decode(read_records(spark, path=str(tmp_path / "log" / "dev")), schemas.DEVICES)
    assert [(r.row_kind, r.temperature_threshold) for r in log.orderBy("seq").collect()] == [
        ("+I", 30.0), ("-D", 30.0), ("+I", 40.0)]
    assert changelog.decode(read_records(spark, path=str(tmp_path / "log" / "read")), schemas.READINGS).count() == 1
    # The collection as it was before: consumers read its folder too, and every change is newer.
    known = changelog.decode(frame(spark, [record(change("c", None, device(d, threshold=1.0)), 1)
                                           for d in ("d1", "d2")]), schemas.DEVICES)
    capture_snapshot(known.drop("row_kind", "seq"), schemas.DEVICES, fixed_now(), path=str(tmp_path / "log" / "snapshot"))
    both = read_records(spark, path=str(tmp_path / "log" / "snapshot")).unionByName(
        read_records(spark, path=str(tmp_path / "log" / "dev")))
    state = changelog.current_state(changelog.decode(both, schemas.DEVICES), ["_id"])
    assert {r._id: r.temperature_threshold for r in state.collect()} == {"d1": 40.0, "d2": 1.0}
    written = spark.read.json(str(tmp_path / "log" / "dev"))
    assert {r.captured_ms for r in written.collect()} == {1748736000500}


def test_upsert_lake_over_several_batches(spark, tmp_path):
    root = str(tmp_path / "lake")

    def run():
        finish(start_upsert_lake(spark, stream(spark, tmp_path / "devices"), stream(spark, tmp_path / "readings"),
                                 root, ONCE, fixed_now(), compact_every=1))
        return keyed_states(spark, root)

    next_day = "2025-01-02 10:05:00.000"
    write_records(tmp_path / "devices", [record(change("c", None, device()), 1)], "0")
    write_records(tmp_path / "readings", [record(change("c", None, reading()), 1),
                                          record(change("c", None, reading("r0", None)), 2)], "0")
    states = run()
    enriched = states["iceberg_devices_readings_enriched"]
    assert [(r.reading_id, r.severity) for r in enriched.collect()] == [("R1", "WARNING")]
    assert enriched.columns == schemas.ENRICHED_BY_DAY
    # The device gets another threshold; the reading moves to the next day.
    write_records(tmp_path / "devices", [record(change("u", device(), device(threshold=40.0)), 3)], "1")
    write_records(tmp_path / "readings", [record(change("u", reading(), reading(at=next_day)), 4)], "1")
    states = run()
    rows = states["iceberg_devices_readings_enriched"].collect()
    assert [(r.partition_date, r.severity) for r in rows] == [("2025-01-02", "NORMAL")]
    assert [r.partition_date for r in states["iceberg_sensor_readings"].collect()] == ["2025-01-02"]
    # The moved reading is deleted, another one comes.
    write_records(tmp_path / "readings", [record(change("d", reading(at=next_day)), 5),
                                          record(change("c", None, reading("r5", "R5")), 6)], "2")
    states = run()
    for name in ("iceberg_devices_readings_enriched", "iceberg_sensor_readings"):
        assert [(r.reading_id, r.partition_date) for r in states[name].collect()] == [("R5", "2025-01-01")], name
    assert [r.temperature_threshold for r in states["iceberg_devices"].collect()] == [40.0]
    # The device goes, and with it every joined row; compaction changes nothing.
    write_records(tmp_path / "devices", [record(change("d", device(threshold=40.0)), 6)], "2")
    states = run()
    assert states["iceberg_devices_readings_enriched"].count() == 0
    for name in states:
        table = keyed_table(spark, root, name)
        before = table.current().count()
        table.compact()
        table.expire()
        assert table.current().count() == before


def held_documents(path):
    """What a search service holds: requests in order, an older version is refused."""
    held = {}
    folders = sorted(glob.glob(f"{path}/batch_id=*"), key=lambda p: int(p.rsplit("=", 1)[1]))
    for folder in folders:
        lines = [x for part in sorted(glob.glob(f"{folder}/part-*")) for x in open(part, encoding="utf-8").read().splitlines()]
        seen, i = set(), 0
        while i < len(lines):
            (action, meta), = json.loads(lines[i]).items()
            assert meta["_id"] not in seen, "one action per document and batch"
            seen.add(meta["_id"])
            doc = json.loads(lines[i + 1]) if action == "index" else None
            i += 2 if action == "index" else 1
            if meta["version"] >= held.get(meta["_id"], (-1, None))[0]:
                held[meta["_id"]] = (meta["version"], doc)
    return {k: doc for k, (_, doc) in held.items() if doc is not None}


@pytest.mark.parametrize("direct", [False, True])
def test_search(spark, tmp_path, direct):
    def wrap(op, before, after, pos):
        if not direct:
            return record(change(op, before, after, pos), pos)
        kind = {"c": "insert", "u": "update", "d": "delete"}[op]
        return record(json.dumps({"operationType": kind, "documentKey": {"_id": (after or before)["_id"]},
                                  "fullDocument": after, "fullDocumentBeforeChange": before, "clusterTime": cluster_time(pos)}), pos)

    root = str(tmp_path / "search")

    def run():
        finish(start_search(spark, stream(spark, tmp_path / "devices"), stream(spark, tmp_path / "readings"), root,
                            direct, trigger=ONCE, now=fixed_now()))

    write_records(tmp_path / "devices", [wrap("c", None, device(), 1)], "0")
    write_records(tmp_path / "readings", [wrap("c", None, reading(), 2), wrap("c", None, reading("r2", "R2"), 3),
                                          wrap("u", reading("r2", "R2"), reading("r2", "R2", value=20.0), 4)], "0")
    run()
    joined = "devices_readings" if direct else "iot_enriched_data"
    docs = held_documents(f"{root}/bulk/{joined}")
    assert {k: d["severity"] for k, d in docs.items()} == {"r1": "WARNING", "r2": "NORMAL"}
    assert set(docs["r1"]) == set(schemas.ENRICHED_DIRECT_DOC if direct else schemas.ENRICHED_DOC)
    # The device changes, one reading moves to a device that does not exist.
    write_records(tmp_path / "devices", [wrap("u", device(), device(threshold=10.0), 5)], "1")
    write_records(tmp_path / "readings", [wrap("u", reading(), reading(device_id="dev9"), 6)], "1")
    run()
    assert {k: d["severity"] for k, d in held_documents(f"{root}/bulk/{joined}").items()} == {"r2": "CRITICAL"}
    write_records(tmp_path / "readings", [wrap("d", reading("r2", "R2", value=20.0), None, 7)], "2")
    run()
    assert held_documents(f"{root}/bulk/{joined}") == {}
    assert set(held_documents(f"{root}/bulk/{'sensor_readings' if direct else 'iot_sensor_readings'}")) == {"r1"}


def test_catalog_ddl_can_run_twice(spark, tmp_path):
    root = str(tmp_path / "lake")
    write_records(tmp_path / "devices", seed_device_records(), "0")
    write_records(tmp_path / "readings", seed_reading_records(), "0")
    run_append(spark, tmp_path, ["devices_raw"])
    for _ in range(2):
        names = create_append_tables(spark, root, "iot_test")
    # One table was filled by a stream, the other by a batch.
    readings = decode_rows.reading_rows(read_records(spark, path=str(tmp_path / "readings")), fixed_now())
    write_append(tables.readings_raw(readings), f"{root}/sensor_readings_raw")
    for name, rows in (("devices_raw", 4), ("sensor_readings_raw", 8)):
        register_partitions(spark, f"iot_test.{name}")
        assert spark.table(f"iot_test.{name}").where("partition_date = '2025-01-01'").count() == rows
    assert len(names) == 4
    spark.sql("DROP DATABASE iot_test CASCADE")


def test_merge_statement_parses(spark):
    sql = merge_sql("cat.db.t", "src", schemas.DEVICES_BY_DAY, ["device_id", "partition_date"])
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    assert "MergeIntoTable" in plan and "deleteaction" in plan.lower()
    assert sql.count("coalesce(s.seq >= t.seq, true)") == 2


def test_keyed_tables_can_take_merges(spark, tmp_path):
    """The tables have a column for each row's place; batches are handed to MERGE (which plain files refuse)."""
    names = create_keyed_tables(spark, "keyed_test", "parquet")
    assert [spark.table(name).columns[0] for name in names] == ["seq"] * 3
    assert set(schemas.DEVICES_BY_DAY) < set(spark.table(names[0]).columns)
    write_records(tmp_path / "devices", seed_device_records(), "0")
    write_records(tmp_path / "readings", seed_reading_records(), "0")
    with pytest.raises(StreamingQueryException, match="MERGE"):
        finish(start_upsert_lake(spark, stream(spark, tmp_path / "devices"), stream(spark, tmp_path / "readings"), str(tmp_path / "lake"),
                                 ONCE, fixed_now(), only=["iceberg_devices"], merge_into="keyed_test"))
    spark.sql("DROP DATABASE keyed_test CASCADE")


@pytest.mark.parametrize("table", ["customer", "events"])
def test_a_registered_stream_takes_several_batches(spark, tmp_path, table):
    """Oldest rows first, each row once, slice by slice."""
    number, batches = views._NUMBER[table], []
    rows = views._table(spark, SF, table, streaming=True).select(number)
    query = rows.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).foreachBatch(
        lambda batch, _: batches.append(sorted(r[0] for r in batch.collect()))).start()
    finish([query])
    assert len(batches) == views.SLICES
    assert sum(batches, []) == sorted(r[0] for r in views._table(spark, SF, table).select(number).collect())


def test_unknown_output_is_refused(spark, tmp_path):
    write_records(tmp_path / "devices", [], "0")
    with pytest.raises(ValueError, match="no such output"):
        start_search(spark, stream(spark, tmp_path / "devices"), stream(spark, tmp_path / "devices"),
                     str(tmp_path), only=["nothing"])
