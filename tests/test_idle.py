"""Joins whose device side is silent: state is freed, and what is due comes out."""

from __future__ import annotations

import pytest
from fixtures import BASE_MS, change, device, fixed_now, reading, record, write_records

from tidelog import schemas
from tidelog.operators import decode_rows, enrich
from tidelog.sources.lake import open_table
from tidelog.sources.records import read_records
from tidelog.streaming import Trigger, start_append_lake
from tidelog.streaming.append_lake import enriched_stream
from tidelog.streaming.idle import beats
from tidelog.streaming.queries import finish

ONCE = Trigger(available_now=True)
HOUR = 3_600_000


def at(ms):
    return record(change("c", None, reading(f"r{ms}", f"R{ms}", at="2025-01-01 10:00:00.000"), BASE_MS + ms), ms)


def stream(spark, path):
    return read_records(spark, streaming=True, path=str(path), maxFilesPerTrigger="1")


def run(spark, tmp_path, only, **how):
    root = str(tmp_path / "lake")
    queries = start_append_lake(stream(spark, tmp_path / "devices"), stream(spark, tmp_path / "readings"), root, trigger=ONCE,
                                now=fixed_now(), salts=2, only=[only], **how)
    finish(queries)
    return open_table(spark, f"{root}/{only}"), queries[0]


def one_old_device(tmp_path):
    """A device at 0:00 and nothing else; readings every 15 minutes for 24 hours, an hour a batch."""
    write_records(tmp_path / "devices", [record(change("c", None, device(), BASE_MS), 0)], "00")
    for hour in range(24):
        write_records(tmp_path / "readings", [at(hour * HOUR + q * HOUR // 4) for q in range(4)], f"{hour:02d}")


def test_a_day_of_readings_and_one_old_device(spark, tmp_path):
    one_old_device(tmp_path)
    rows, query = run(spark, tmp_path, "devices_readings")
    devices = decode_rows.device_rows(read_records(spark, path=str(tmp_path / "devices")), fixed_now())
    readings = decode_rows.reading_rows(read_records(spark, path=str(tmp_path / "readings")), fixed_now())
    expected = enrich.enrich_within(devices, readings)
    ids = ["device_mongo_id", "reading_id"]
    assert sorted(rows.select(*ids).collect()) == sorted(expected.select(*ids).collect()) and rows.count() == 9
    state = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress]
    # Twice the limit, by four readings an hour, the batch at hand and the device's copies: not the day.
    assert len(state) >= 24 and max(state) <= 4 * (2 + 2 + 2) + 2


def test_without_beats_the_same_join_keeps_everything(spark, tmp_path):
    one_old_device(tmp_path)
    devices = decode_rows.device_rows(stream(spark, tmp_path / "devices"), fixed_now())
    readings = decode_rows.reading_rows(stream(spark, tmp_path / "readings"), fixed_now())
    query = enriched_stream(devices, readings, salts=2).writeStream.format("noop").option(
        "checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] >= 96


@pytest.mark.parametrize("quiet", ["devices", "readings"])
def test_either_side_may_be_silent(spark, tmp_path, quiet):
    """The silent side's watermark follows the other: what is left over of the talking side is dropped from state, and
    readings that had no device come out."""
    write_records(tmp_path / "devices", [record(change("c", None, device(), BASE_MS), 0)], "00")
    write_records(tmp_path / "readings", [at(0), record(change("c", None, reading("x", "X", "other"), BASE_MS), 1)], "00")
    for hour in range(1, 8):
        if quiet == "devices":
            write_records(tmp_path / "readings", [at(hour * HOUR)], f"{hour:02d}")
        else:
            write_records(tmp_path / "devices", [record(change("c", None, device(f"d{hour}", f"dev{hour}"), BASE_MS + hour * HOUR), hour)], f"{hour:02d}")
    rows, _ = run(spark, tmp_path, "unmatched_readings", idle_seconds=30)
    due = {"X"} | ({f"R{hour * HOUR}" for hour in (3, 4)} if quiet == "devices" else set())
    assert {r.reading_id for r in rows.collect()} == due
    assert set(rows.columns) == set(schemas.UNMATCHED_READINGS)


def test_a_side_that_lags_by_less_than_the_limit_loses_nothing(spark, tmp_path):
    """Readings of two hours come first, their devices' changes after them."""
    for i, minutes in enumerate((0, 60, 119)):
        write_records(tmp_path / "readings", [at(minutes * 60_000)], f"{i:02d}")
        write_records(tmp_path / "devices", [], f"{i:02d}")
    write_records(tmp_path / "devices", [record(change("c", None, device(), BASE_MS), 0)], "03")
    rows, _ = run(spark, tmp_path, "devices_readings")
    assert rows.count() == 3


def test_records_without_a_capture_time_do_not_beat(spark, tmp_path):
    write_records(tmp_path / "log", [record(change("c", None, reading(), None), 0), record("garbage", 1), at(5)], "0")
    times = beats(read_records(spark, path=str(tmp_path / "log")), 30).collect()
    assert [t.event_timestamp.timestamp() * 1000 for t in times] == [BASE_MS + 5 - 30_000]
