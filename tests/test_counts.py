"""What running jobs count, requests cut by actions and bytes, and the time a record was written."""

from __future__ import annotations

import json

import pytest
from fixtures import BASE_MS, change, device, fixed_now, frame, reading, record, write_records
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.operators import changelog
from tidelog.sinks.bulk import flushes, requests
from tidelog.sinks.change_log import broker_rows, file_rows
from tidelog.sources.records import FILE_RECORD, kafka_records, read_records
from tidelog.streaming import Trigger, start_append_lake, start_search, start_upsert_lake
from tidelog.streaming.counts import DEVICE_COUNTS, READING_COUNTS, JobCounts, batch_counts
from tidelog.streaming.queries import finish
from tidelog.streaming.search import request_writer

ONCE = Trigger(available_now=True)


def stream(spark, path):
    return read_records(spark, streaming=True, path=str(path), maxFilesPerTrigger="1")


def a_log_with_faults(tmp_path):
    write_records(tmp_path / "devices", [record(change("c", None, device()), 1), record("garbage", 2), record(change("d"), 3)], "0")
    write_records(tmp_path / "devices", [record(change("x", None, device()), 4), record(change("c"), 5), record("{}", 6), record(change("u", device(), device()), 7)], "1")
    write_records(tmp_path / "readings", [record(change("c", None, reading(), BASE_MS), 1)], "0")


def test_faults_are_counted_per_batch(spark, tmp_path):
    a_log_with_faults(tmp_path)
    queries = start_upsert_lake(spark, stream(spark, tmp_path / "devices"), stream(spark, tmp_path / "readings"), str(tmp_path / "lake"), ONCE,
                                fixed_now(), only=["iceberg_devices"])
    finish(queries)
    rows = [r for r in batch_counts(queries[0]) if r["records"]]
    assert [(r["log"], r["batch_id"], r["records"], r["no_operation"], r["unknown_operation"], r["no_image"]) for r in rows] == [
        (DEVICE_COUNTS, 0, 3, 1, 0, 1), (DEVICE_COUNTS, 1, 4, 1, 1, 1)]


def test_a_listener_sums_up_all_jobs(spark, tmp_path):
    a_log_with_faults(tmp_path)
    alarms = []
    listener = JobCounts(alarms.append)
    spark.streams.addListener(listener)
    try:
        both = [stream(spark, tmp_path / n) for n in ("devices", "readings")]
        finish(start_append_lake(*both, str(tmp_path / "lake"), trigger=ONCE, now=fixed_now()))
        finish(start_search(spark, *both, str(tmp_path / "search"), trigger=ONCE, now=fixed_now(), only=["iot_enriched_data"]))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    totals = listener.totals()
    # The append tables ask for created rows only: a delete without its image is none of theirs.
    assert totals["devices_raw", DEVICE_COUNTS] == {"records": 7, "no_operation": 2, "unknown_operation": 1, "no_image": 1, "late": 0}
    assert totals["search_iot_enriched_data", DEVICE_COUNTS]["no_image"] == 2
    assert totals["search_iot_enriched_data", READING_COUNTS]["records"] == 1
    assert {a["query"] for a in alarms} >= {"devices_raw", "search_iot_enriched_data"}


def test_counting_does_not_parse_twice(spark):
    records = frame(spark, [record(change("c", None, device()), 1)])
    plan = changelog.decode(records, schemas.DEVICES, count_as="n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1 and "CollectMetrics" in plan


def actions(spark, sizes):
    rows = [("i", f"d{i:03d}", "index", i, "x" * n) for i, n in enumerate(sizes)] + [("i", "z", "delete", 9, None), ("i", None, "index", 1, "{}")]
    return spark.createDataFrame(rows, "_index string, _id string, action string, version long, doc string")


@pytest.mark.parametrize("most,limit", [(1, 1 << 20), (5, 1 << 20), (1000, 700), (3, 400), (1000, 1)])
def test_requests_end_with_the_action_that_fills_them(spark, most, limit):
    sizes = [10, 900, 20, 300, 300, 300, 5, 5, 5, 5, 5, 5, 5, 2000, 1]
    rows = flushes(actions(spark, sizes), most, limit, lanes=1).orderBy("_id").collect()
    assert [r["_id"] for r in rows] == [f"d{i:03d}" for i in range(len(sizes))] + ["z"]
    assert all(r["n_bytes"] == len(r["value"].encode()) + 1 for r in rows)
    got = {}
    for r in rows:
        got.setdefault(r["request"], []).append(r["n_bytes"])
    assert list(got) == list(range(1, len(got) + 1))
    assert all(len(r) <= most and sum(r[:-1]) < max(limit, 1) + max(r) for r in got.values())
    bodies = requests(actions(spark, sizes), most, limit, lanes=1).orderBy("request").collect()
    assert [(b["n_actions"], b["n_bytes"]) for b in bodies] == [(len(r), sum(r)) for r in got.values()]
    assert "".join(b["body"] for b in bodies) == "".join(r["value"] + "\n" for r in rows)
    assert all(len(b["body"].encode()) == b["n_bytes"] for b in bodies)


def test_by_default_every_action_is_a_request_of_its_own(spark):
    bodies = requests(actions(spark, [5] * 20)).collect()
    assert len(bodies) == 21 and all(b["n_actions"] == 1 for b in bodies)
    assert requests(actions(spark, []).limit(0)).count() == 0


def test_the_search_job_writes_requests(spark, tmp_path):
    write_records(tmp_path / "devices", [record(change("c", None, device(f"d{i}", f"dev{i}")), i) for i in range(10)], "0")
    write_records(tmp_path / "readings", [], "0")
    root = str(tmp_path / "search")
    finish(start_search(spark, stream(spark, tmp_path / "devices"), stream(spark, tmp_path / "readings"), root, trigger=ONCE, now=fixed_now(),
                        only=["iot_devices"], writer=request_writer(f"{root}/requests", max_actions=4, lanes=1)))
    rows = spark.read.parquet(f"{root}/requests/iot_devices").orderBy("request").collect()
    assert [r["n_actions"] for r in rows] == [4, 4, 2]
    heads = [json.loads(line) for r in rows for line in r["body"].splitlines()[::2]]
    assert {h["index"]["_id"] for h in heads} == {f"d{i}" for i in range(10)}


def test_the_time_a_record_was_written_comes_back(spark, tmp_path):
    """Through a directory and through the broker's headers; older records have none."""
    log = changelog.decode(frame(spark, [record(change("u", device(), device(threshold=9.0)), 5)]), schemas.DEVICES)
    file_rows(log, schemas.DEVICES, fixed_now()).write.json(str(tmp_path / "log"))
    from_files = changelog.decode(read_records(spark, path=str(tmp_path / "log")), schemas.DEVICES, captured=True)
    sent = broker_rows(log, schemas.DEVICES, fixed_now()).select(
        F.encode("value", "utf-8").alias("value"), "headers", F.lit(0).alias("partition"), F.lit(1).cast("long").alias("offset"),
        F.timestamp_millis(F.lit(77)).alias("timestamp"))
    from_broker = changelog.decode(kafka_records(sent), schemas.DEVICES, captured=True)
    for rows in (from_files, from_broker):
        assert [(r.row_kind, r.captured_ms) for r in rows.orderBy("row_kind").collect()] == [("+I", 1748736000500), ("-D", 1748736000500)]
    assert kafka_records(sent.drop("headers")).first()["captured_ms"] is None
    other = sent.withColumn("headers", F.array(F.struct(F.lit("event_timestamp").alias("key"), F.encode(F.lit("soon"), "utf-8").alias("value"))))
    assert kafka_records(other).first()["captured_ms"] is None
    assert FILE_RECORD["captured_ms"].nullable
