"""What keeps the streams' time in step with their input."""

from __future__ import annotations

import json
import re

from fixtures import frame, reading, record
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.operators.change_events import RECORD, change_records
from tidelog.plans import views
from tidelog.streaming.images import with_images


def test_images_are_kept_by_bucket(spark, tmp_path):
    """Forty documents in four buckets: four calls of the operator, and each document still has its own image."""
    def rows(op, after, pos):
        return spark.createDataFrame([(f"r{i}", op, None, after and f'{{"v": {i}}}', None, None, 1000, 0, pos, None) for i in range(40)], RECORD)

    folder = str(tmp_path / "changes")
    rows("c", True, 1).coalesce(1).write.mode("append").parquet(folder)
    rows("d", None, 2).coalesce(1).write.mode("append").parquet(folder)
    changes = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(folder)
    query = (with_images(changes, buckets=4).writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.numInputRows] == [4, 4]
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r._id, r.op, r.before, r.after) for r in out) == sorted(
        change for i in range(40) for change in ((f"r{i}", "c", None, f'{{"v": {i}}}'), (f"r{i}", "d", f'{{"v": {i}}}', None)))


def test_a_slice_is_several_tasks_and_one_batch(spark):
    """A table in one part is dealt out to as many files as the session has cores; a small one, or one with an empty slice, to one."""
    def batches(table):
        stream = views._as_log(table, "event_id")
        seen = []

        def look(batch, _):
            files = batch.groupBy(F.input_file_name()).count().collect()
            seen.append((len(files), sum(r["count"] for r in files)))

        query = stream.writeStream.foreachBatch(look).trigger(availableNow=True).start()
        query.awaitTermination()
        return seen

    assert batches(spark.range(0, 60_000, numPartitions=1).toDF("event_id")) == [(4, 20_000)] * 3
    assert batches(spark.range(0, 60, numPartitions=1).toDF("event_id")) == [(1, 20)] * 3
    apart = spark.range(0, 60_000, numPartitions=1).selectExpr("if(id < 30000, id, id + 1000000) AS event_id")
    assert [rows for _, rows in batches(apart) if rows] == [30_000, 30_000]


def test_a_document_is_parsed_once(spark):
    body = json.dumps({"operationType": "insert", "documentKey": {"_id": "r1"}, "fullDocument": reading()})
    changes = change_records(frame(spark, [record(body, 1)]), schemas.READINGS)
    plan = changes._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"from_json\([^#]*fullDocument#", plan)) == 1


def test_database_events_are_derived_on_all_cores(spark, tmp_path):
    rows = spark.range(0, 100, numPartitions=1).selectExpr(
        "id AS event_id", "timestamp'2024-01-01' AS ts", "id % 7 AS user_id", "'view' AS event_type", "1.0D AS value")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    events = views.device_change_events(spark, str(tmp_path))
    assert events.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and events.count() == 100


def test_join_state_holds_a_device_row_once_or_twice(spark, tmp_path):
    """A hundred readings of one device, six hours apart, and its hundred images: state has at most two rows an image, and each pair is there once."""
    from datetime import datetime, timedelta

    from tidelog.operators import enrich
    from tidelog.streaming.append_lake import enriched_stream

    times = [datetime(2024, 1, 1) + timedelta(hours=6 * i) for i in range(100)]

    def rows(schema, ids, name):
        columns = [*schema.fieldNames()[1:]]
        some = spark.createDataFrame([(f"{name}{i}", t) for i, t in zip(ids, times)], "mongo_id string, event_timestamp timestamp")
        filled = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name in columns}
        filled |= {"device_id": F.lit("hot")} | ({"reading_id": F.col("mongo_id")} if "reading_id" in columns else {})
        some = some.withColumns(filled)
        some.write.parquet(str(tmp_path / name))
        return some, spark.readStream.schema(some.schema).parquet(str(tmp_path / name))

    devices, device_stream = rows(schemas.DEVICES, range(100), "d")
    readings, reading_stream = rows(schemas.READINGS, range(100), "r")
    query = (enriched_stream(device_stream, reading_stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    ids = ["device_mongo_id", "reading_mongo_id"]
    out = spark.read.parquet(str(tmp_path / "out")).select(*ids).collect()
    assert sorted(out) == sorted(enrich.enrich_within(devices, readings).select(*ids).collect()) and len(out) == 100
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= 300


def test_an_empty_part_of_a_keyed_table_leaves_the_plan(spark, tmp_path):
    from pyspark.sql import types as T

    from tidelog.sinks.change_table import ChangeTable, change_schema

    table = ChangeTable(spark, str(tmp_path / "t"), change_schema(T.StructType([T.StructField("k", T.StringType())])), ["k"])
    assert table.current().collect() == []
    table.write_batch(spark.createDataFrame([("+I", None, "a")], table.schema), 0)
    plan = table.changes()._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "RDD" not in plan
    assert [r.k for r in table.current().collect()] == ["a"]


def test_late_run_decodes_its_devices_once(spark, monkeypatch):
    from fixtures import SF
    from tidelog.plans import stream_runs

    calls, topic = [], views.device_topic
    monkeypatch.setattr(views, "device_topic", lambda *a, **k: calls.append(k) or topic(*a, **k))
    assert stream_runs.stream_late_readings(spark, SF).count() > 0
    assert calls == [{"spread": True}]
