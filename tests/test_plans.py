"""Plans: what reaches the scan, what is shuffled, and what happens to a hot device."""

from __future__ import annotations

import re
import time

import pytest
from fixtures import SF
from fixtures import change, device, fixed_now, frame, record
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog import schemas
from tidelog.operators import changelog, decode_rows, enrich, tables, windows
from tidelog.plans import lake_reports, views
from tidelog.plans.queries import BATCH_QUERIES
from tidelog.session import configure
from tidelog.sinks.append import write_append
from tidelog.sinks.bulk import bulk_lines, by_operation
from tidelog.sinks.change_log import broker_rows
from tidelog.sinks.change_table import ChangeTable, change_schema
from tidelog.sources.lake import open_table, register_lake
from tidelog.sources.records import kafka_records


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def conf(spark):
    saved = {}

    def put(**values):
        for name, value in values.items():
            saved.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield lambda values: put(**values)
    for name, value in saved.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    configure(spark)


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_no_python_and_no_cross_join(spark, name):
    plan = physical(BATCH_QUERIES[name](spark, SF))
    for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "InPandas"):
        assert operator not in plan, operator


def test_a_record_is_parsed_once(spark):
    records = frame(spark, [record(change("c", None, device()), 1)])
    assert optimized(decode_rows.device_rows(records, fixed_now())).count("from_json") == 1
    assert optimized(changelog.decode(records, schemas.DEVICES)).count("from_json") == 1
    latest = changelog.current_state(changelog.decode(records, schemas.DEVICES), ["_id"])
    assert optimized(latest).count("from_json") == 1


def test_joining_decoded_rows_is_planned_quickly(spark):
    """Constraint inference must not grow with the number of columns."""
    devices = decode_rows.device_rows(views.device_topic(spark, SF), fixed_now())
    readings = decode_rows.reading_rows(views.reading_topic(spark, SF), fixed_now())
    planning = tables.enriched_raw(enrich.enrich_append(devices, readings))
    phases = planning._jdf.queryExecution()
    phases.executedPlan()
    assert phases.tracker().phases().apply("optimization").durationMs() < 20_000


@pytest.fixture
def lake(spark, tmp_path):
    root = str(tmp_path)
    write_append(tables.readings_raw(views.readings(spark, SF)), f"{root}/sensor_readings_raw")
    write_append(tables.devices_raw(views.devices(spark, SF)), f"{root}/devices_raw", rebalance=True)
    readings, devices = (
        open_table(spark, f"{root}/{n}", schemas.table_schema(schemas.APPEND_TABLES[n]))
        for n in ("sensor_readings_raw", "devices_raw"))
    return readings, devices


def test_aggregate_runs_before_the_join_and_filters_reach_the_scan(spark, lake):
    readings, devices = lake
    plan = physical(windows.temperature_per_window(readings, devices))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "sensor_value" in line)
    assert "EqualTo(unit,°C)" in scan and "IsNotNull(reading_id)" in scan
    assert re.search(r"ReadSchema: struct<(.*)>", scan).group(1).count(":") == 6
    device_scan = next(line for line in plan.splitlines() if "FileScan" in line and "device_name" in line)
    assert "EqualTo(device_type,temperature)" in device_scan
    # Below the join, each side is reduced before its exchange.
    assert plan.count("partial_count") >= 4
    assert plan.index("Join") < plan.index("partial_count")


def test_day_filter_prunes_folders(spark, lake):
    lake[0].createOrReplaceTempView("sensor_readings_raw")
    df = spark.sql(lake_reports.PRUNE_SQL)
    scan = next(line for line in physical(df).splitlines() if "FileScan" in line)
    assert "partition_date#" in re.search(r"PartitionFilters: \[(.*?)\]", scan).group(1)
    assert len({f.split("partition_date=")[1].split("/")[0] for f in df.inputFiles()}) <= 30


def test_latest_reading_is_limited_before_the_exchange(spark, lake):
    lake[0].createOrReplaceTempView("sensor_readings_raw")
    plan = physical(spark.sql(lake_reports.LATEST_SQL))
    assert plan.count("WindowGroupLimit") == 2 and plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_latest_change_is_reduced_before_the_exchange(spark):
    plan = physical(changelog.current_state(views.reading_changes(spark, SF), ["_id"]))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.index("Exchange") < plan.index("partial_max")


def hot_readings(spark, rows=60_000):
    """A third of the readings belong to one device."""
    ids = spark.range(0, rows, 1, 8)
    hot = F.col("id") % 3 == 0
    return ids.select(
        F.concat(F.lit("r"), "id").alias("mongo_id"), F.concat(F.lit("R"), "id").alias("reading_id"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("dev"), F.col("id") % 500)).alias("device_id"),
        (F.col("id") % 50).cast("double").alias("sensor_value"), F.lit("°C").alias("unit"), F.lit("good").alias("quality"),
        F.lit("2025-01-01 10:00:00").cast("timestamp_ntz").alias("timestamp"), F.lit(1).alias("battery_level"),
        F.timestamp_seconds(F.lit(1735725600) + F.col("id")).alias("event_timestamp"))


def some_devices(spark, extra_hot=3):
    ids = spark.range(0, 500, 1, 4).select(F.concat(F.lit("dev"), "id").alias("device_id"), F.lit("0").alias("copy"))
    hot = spark.range(extra_hot).select(F.lit("hot").alias("device_id"), F.col("id").cast("string").alias("copy"))
    columns = {f.name: F.lit(None).cast(f.dataType) for f in schemas.DEVICES if f.name not in ("_id", "device_id")}
    rows = ids.unionByName(hot).withColumns({**columns, "temperature_threshold": F.lit(20.0)})
    return rows.withColumns({
        "mongo_id": F.concat("device_id", "copy"), "device_type": F.lit("temperature"), "building": F.lit("B"),
        "device_name": F.col("device_id"), "location": F.lit("L"),
        "event_timestamp": F.lit("2025-01-01 10:00:00").cast("timestamp")}).drop("copy")


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB", "spark.sql.shuffle.partitions": "16",
}


def test_hot_device_is_split_in_the_join(spark, conf):
    conf(SKEW)
    joined = enrich.enrich_append(some_devices(spark), hot_readings(spark))
    assert joined.count() == 40_000 + 20_000 * 3
    joined = enrich.enrich_append(some_devices(spark), hot_readings(spark))
    joined.write.format("noop").mode("overwrite").save()
    joined.collect()
    assert "skew=true" in physical(joined)


def test_hot_device_with_silent_devices(spark, conf):
    conf(SKEW)
    silent = some_devices(spark, 0).withColumn("device_id", F.concat(F.lit("quiet"), "device_id"))
    joined = enrich.devices_with_readings(some_devices(spark).unionByName(silent), hot_readings(spark))
    rows = joined.collect()
    assert len(rows) == 40_000 + 60_000 + 500
    assert sum(r.reading_id is None for r in rows) == 500
    assert "skew=true" in physical(joined)


def test_hot_device_costs_its_windows_only(spark):
    """The window totals are reduced in each input partition: 20,000 rows of one device become two."""
    totals = windows.window_totals(hot_readings(spark), "1 day")
    assert totals.where("device_id = 'hot'").count() == 2
    plan = physical(totals)
    assert plan.index("Exchange") < plan.index("partial_count")


def keyed(spark, path, **layout):
    return ChangeTable(spark, str(path), change_schema(schemas.DEVICES), ["_id"], **layout)


def test_keyed_table_reads_only_the_buckets_it_needs(spark, tmp_path):
    table = keyed(spark, tmp_path / "t", buckets=8)
    changes = views.device_changes(spark, SF)
    table.write_batch(changes.where("seq.pos < 500"), 0)
    table.write_batch(changes.where("seq.pos >= 500"), 1)
    assert table.compact() == 1 and table.compact() is None
    wanted = table.buckets_of(spark.createDataFrame([("d1a",)], "_id string"))
    scan = next(line for line in physical(table.changes(wanted)).splitlines() if "FileScan" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#", scan)
    full = changelog.current_state(changes, ["_id"])
    assert table.current().exceptAll(full.drop("row_kind", "seq")).count() == 0
    assert table.current().count() == full.count()


def test_day_filter_reaches_the_files_of_a_keyed_table(spark, tmp_path):
    columns, keys = schemas.KEYED_TABLES["iceberg_sensor_readings"]
    table = ChangeTable(spark, str(tmp_path / "t"), change_schema(schemas.table_schema(columns)), keys, by_day=True)
    changes = tables.readings_by_day(views.reading_changes(spark, SF), fixed_now())
    for batch_id in range(3):
        table.write_batch(changes.where(F.col("seq.pos") % 3 == batch_id), batch_id)
    assert table.compact(before=2) == 1
    day = table.current().where("partition_date = '2024-01-05'")
    scans = [line for line in physical(day).splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert all(re.search(r"PartitionFilters: \[[^\]]*partition_date#", scan) for scan in scans)
    full = changelog.current_state(changes, keys).where("partition_date = '2024-01-05'")
    assert day.count() == full.count() > 0


def test_a_merge_rewrites_what_batches_touch(spark, tmp_path):
    """Only the days of new batches get a new folder; what a merge replaced goes with the next one."""
    columns, keys = schemas.KEYED_TABLES["iceberg_sensor_readings"]
    table = ChangeTable(spark, str(tmp_path / "t"), change_schema(schemas.table_schema(columns)), keys, by_day=True)
    changes = tables.readings_by_day(views.reading_changes(spark, SF), fixed_now()).persist()
    halves = [changes.where(f"seq.pos % 2 = {i}") for i in range(2)]
    late = changes.where("partition_date = '2024-01-05'")
    folders = lambda: {str(p.relative_to(tmp_path / "t")) for p in (tmp_path / "t").glob("merged/*/upto=*")}
    table.write_batch(halves[0], 0)
    assert table.compact() == 0
    first = folders()
    table.write_batch(halves[1].where("partition_date <> '2024-01-05'"), 1)
    table.write_batch(late, 2)
    assert table.compact(before=2) == 1
    assert first <= folders() and not (tmp_path / "t/merged/partition_date=2024-01-05/upto=1").exists()
    assert table.compact() == 2
    # What the first merge made was replaced by the second and went with the third, the untouched day too.
    assert sorted({f.rsplit("=", 1)[1] for f in folders()}) == ["0", "1", "2"]
    table.expire()
    assert len(folders()) == len({f.split("/")[1] for f in folders()}) and not list((tmp_path / "t").glob("batches/batch_id=*"))
    expected = changelog.current_state(changes, keys).drop("row_kind", "seq")
    assert table.current().exceptAll(expected).count() == 0 and table.current().count() == expected.count()
    changes.unpersist()


def test_unfinished_work_does_not_count(spark, tmp_path):
    table = keyed(spark, tmp_path / "t", buckets=2)
    assert table.current().count() == 0
    changes = views.device_changes(spark, SF)
    table.write_batch(changes.where("seq.pos < 500"), 0)
    table.write_batch(changes.where("seq.pos >= 500"), 1)
    expected = table.current().count()
    table.write_batch(changes, 2)  # no end marker: it is still being written
    (tmp_path / "t/batches/batch_id=2/_SUCCESS").unlink()
    assert table.current().count() == expected and table._batches(-1, None) == [0, 1]
    assert table.compact() == 1
    (tmp_path / "t/_merged/1").unlink()  # as if the merge had ended before it was published: batches still count
    assert table.current().count() == expected and table.compact() == 1
    assert table.current().count() == expected


def test_ten_thousand_batch_names_are_one_listing(spark, tmp_path):
    table = keyed(spark, tmp_path / "t")
    for i in range(10_000):
        (tmp_path / f"t/batches/batch_id={i}").mkdir(parents=True)
    (tmp_path / "t/batches/batch_id=9999/_SUCCESS").touch()
    table._batches(-1, None)
    started = time.perf_counter()
    assert len(table._batches(-1, None)) == 10_000
    assert time.perf_counter() - started < 5


@pytest.mark.parametrize("by_day", [True, False])
def test_views_show_what_is_there_when_asked(spark, tmp_path, by_day):
    """Registered before the first batch; batches, merges and expiry in between."""
    columns, keys = schemas.KEYED_TABLES["iceberg_sensor_readings"]
    schema = change_schema(schemas.table_schema(columns))
    table = ChangeTable(spark, str(tmp_path / "t"), schema, keys, by_day=by_day, buckets=3)
    register_lake(spark, str(tmp_path / "lake"), {"sensor_readings_raw": schemas.table_schema(schemas.READINGS_RAW)}, keyed={"keyed_readings": table})
    assert spark.table("keyed_readings").count() == spark.table("sensor_readings_raw").count() == 0
    assert spark.table("keyed_readings").columns == columns
    changes = tables.readings_by_day(views.reading_changes(spark, SF), fixed_now())
    for batch_id in range(4):
        table.write_batch(changes.where(f"seq.pos % 4 = {batch_id}"), batch_id)
        if batch_id in (1, 2):
            table.compact()
        if batch_id == 2:
            table.expire()
        expected = changelog.current_state(changes.where(f"seq.pos % 4 <= {batch_id}"), keys).drop("row_kind", "seq")
        shown = spark.sql("SELECT * FROM keyed_readings")
        assert shown.exceptAll(expected).count() == expected.exceptAll(shown).count() == 0
    write_append(tables.readings_raw(views.readings(spark, SF)), str(tmp_path / "lake/sensor_readings_raw"))
    assert spark.sql("SELECT count(*) FROM sensor_readings_raw").first()[0] == views.readings(spark, SF).count()
    day = spark.sql("SELECT * FROM keyed_readings WHERE partition_date = '2024-01-05'")
    scans = [line for line in physical(day).splitlines() if "FileScan" in line]
    assert len(scans) == 2 and (not by_day or all(re.search(r"PartitionFilters: \[[^\]]*partition_date#", scan) for scan in scans))


def test_broker_rows_and_back(spark):
    """The broker's own columns, without a broker."""
    log = changelog.decode(frame(spark, [record(change("u", device(), device(threshold=9.0)), 5)]), schemas.DEVICES)
    rows = broker_rows(log, schemas.DEVICES, fixed_now())
    assert rows.columns == ["key", "value", "headers"]
    assert {(r.key, r.headers[0].key, bytes(r.headers[0].value)) for r in rows.collect()} == {
        ("d1", "event_timestamp", b"1748736000500")}
    source = rows.select(
        F.col("value").cast("binary").alias("value"), F.lit(2).alias("partition"),
        F.get_json_object("value", "$.op").eqNullSafe("c").cast("bigint").alias("offset"),
        F.timestamp_millis(F.lit(77)).alias("timestamp"))
    source = source.unionByName(source.limit(1).withColumn("value", F.lit(None).cast(T.BinaryType())))
    decoded = changelog.decode(kafka_records(source), schemas.DEVICES)
    assert {(r.row_kind, r.seq.ms, r.seq.part) for r in decoded.collect()} == {("-D", 77, 2), ("+I", 77, 2)}


def test_bulk_lines(spark):
    actions = spark.createDataFrame(
        [("i", "a", "index", 3, '{"x":1}'), ("i", "b", "delete", 4, None), ("i", None, "index", 1, "{}")],
        "_index string, _id string, action string, version bigint, doc string")
    assert sorted(r.value for r in bulk_lines(actions).collect()) == [
        '{"delete":{"_index":"i","_id":"b","version":4,"version_type":"external_gte"}}',
        '{"index":{"_index":"i","_id":"a","version":3,"version_type":"external_gte"}}\n{"x":1}']


def test_service_requests_compute_the_actions_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    schema = "_id string, action string, version bigint, doc string"
    actions = spark.createDataFrame([("a", "index", 3, '{"mongo_id":"x"}'), ("b", "delete", 4, None)], schema)
    requests = by_operation(actions.mapInArrow(counted, schema), ["mongo_id"], str(tmp_path / "scratch"))
    assert {operation: [tuple(r) for r in rows.collect()] for rows, operation in requests} == {
        "index": [("a", 3, "x")], "delete": [("b", 4)]}
    assert seen.value == 2


def test_time_slots_lose_no_pair(spark):
    """The slot join against comparing every pair, at and around the limit."""
    base = 1735725600
    devices = some_devices(spark, 1).where("device_id = 'hot'").withColumn(
        "event_timestamp", F.explode(F.array(*[F.timestamp_seconds(F.lit(base + s)) for s in (0, 3599, 7200, 20000)])))
    readings = hot_readings(spark, 3).where("device_id = 'hot'").withColumn("event_timestamp", F.explode(F.array(
        *[F.timestamp_seconds(F.lit(base + s)) for s in (-7201, -7200, -1, 0, 7199, 7200, 7201, 14400, 14401, 27200)])))
    got = enrich.enrich_within(devices, readings, 7200)
    pairs = sum(abs(d - r) <= 7200 for d in (0, 3599, 7200, 20000)
                for r in (-7201, -7200, -1, 0, 7199, 7200, 7201, 14400, 14401, 27200))
    assert got.count() == pairs
    assert got.distinct().count() <= pairs
