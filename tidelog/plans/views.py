"""The given tables in the shape of the device fleet.

``customer`` and ``nation`` become devices, ``events`` become readings and the two change
logs. Every mapping is a projection (one row in, a fixed number of records out), so
deriving an input shuffles by no key, whatever the distribution of ids. ``nation`` has 25 rows
at every scale; Spark sees its size and broadcasts it.

``plans/oracle.py`` states the same mapping in SQL, without going through JSON.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.timeparts import TIME_FORMAT, zoneless
from tidelog.operators.changelog import decode
from tidelog.schemas import DEVICES, READINGS
from tidelog.session import fresh_dir
from tidelog.sources.records import as_records, connector_records

_JSON = {"ignoreNullFields": "false", "timestampNTZFormat": TIME_FORMAT}
_BASE = "timestamp_ntz'2024-02-01 00:00:00'"
# The instant that stands for "now", so that results do not depend on the clock.
NOW = "2024-06-01 12:34:56.789"


def fixed_now() -> Column:
    return F.lit(NOW).cast("timestamp")


#: What the rows of a streamed table are numbered by, in the order they came.
_NUMBER = {"customer": "c_custkey", "events": "event_id"}
#: Batches in which a stream takes a table.
SLICES = 3
#: Rows that are worth a file of their own in a slice.
FILE_ROWS = 5_000


def _table(spark: SparkSession, sf_dir: str, name: str, streaming: bool = False) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _as_log(table, _NUMBER[name]) if streaming else table


def _slice(table: DataFrame, number: str) -> tuple[Column, int]:
    """The batch a row comes with, and the batches' width: rows are dealt out by number, oldest first."""
    low, high = table.agg(F.coalesce(F.min(number), F.lit(0)), F.coalesce(F.max(number), F.lit(0))).first()
    width = (high - low) // SLICES + 1
    return F.coalesce(F.floor((F.col(number) - low) / width), F.lit(0)).cast("int"), width


def _files(batches: DataFrame, parts: int) -> int:
    """The number of files of each slice: a file is a task of the stream, so as many as the cluster works on at a time.

    A table may well lie in fewer parts. A slice has rows for all of its files, since a file without rows is not written.
    """
    rows = {r["batch"]: r["count"] for r in batches.groupBy("batch").count().collect()}
    least = min(rows.get(i, 0) for i in range(SLICES))
    return max(1, min(max(parts, batches.sparkSession.sparkContext.defaultParallelism), least // FILE_ROWS))


def _as_log(table: DataFrame, number: str, late: Column | None = None) -> DataFrame:
    """A table as a stream of several batches, oldest rows first.

    It is written to the shared folder slice after slice, each as the same number of files (see :func:`_files`), and a
    batch takes that many. So a batch is a slice at every size, and no row comes later than its slice, but those of the first slice for which
    ``late`` holds: they come with the last.
    """
    spark = table.sparkSession
    folder = fresh_dir(spark, f"log-{number}")
    batch, _ = _slice(table, number)
    if late is not None:
        batch = F.when((batch == 0) & late, SLICES - 1).otherwise(batch)
    files = _files(table.select(batch.alias("batch")), -(-table.rdd.getNumPartitions() // SLICES))
    for i in range(SLICES):
        table.where(batch == i).repartition(files).write.mode("append").parquet(folder)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(folder)


_CREATED = f"({_BASE} - make_dt_interval(0, cast(c_custkey % 1000 as int)))"
_DEVICE_DOCUMENT = {
    "_id": "concat('d', c_custkey, 'a')",
    "device_id": "cast(c_custkey AS string)",
    "device_name": "c_name",
    "device_type": "CASE WHEN c_custkey % 4 = 3 THEN 'humidity' ELSE 'temperature' END",
    "location": "c_mktsegment",
    "building": "n_name",
    "floor_level": "c_nationkey % 10",
    "area_type": "CASE c_custkey % 3 WHEN 0 THEN 'technical' WHEN 1 THEN 'storage' ELSE 'office' END",
    "temperature_threshold": "25.0D + (c_custkey % 11) * 5.0D",
    "installed_date": f"{_CREATED} - interval 30 days",
    "status": "CASE WHEN c_custkey % 7 = 0 THEN 'inactive' ELSE 'active' END",
    "battery_level": "cast(c_custkey % 101 AS int)",
    "created_at": _CREATED,
    "updated_at": f"{_CREATED} + make_dt_interval(0, cast(c_custkey % 48 as int))",
}


def _customers(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    return _table(spark, sf_dir, "customer", streaming).join(
        _table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))


def device_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One device document per customer."""
    return _customers(spark, sf_dir).selectExpr(*[f"{e} AS {name}" for name, e in _DEVICE_DOCUMENT.items()])


def _events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Events with their time in whole milliseconds."""
    return _with_times(_table(spark, sf_dir, "events", streaming))


def _spread(table: DataFrame) -> DataFrame:
    """The rows dealt out over all cores. What is derived from a row costs far more than moving it, and a file's row groups may be few."""
    return table.repartition(max(table.sparkSession.sparkContext.defaultParallelism, table.rdd.getNumPartitions()))


def _with_times(events: DataFrame) -> DataFrame:
    return events.select("event_id", "ts", "user_id", "event_type", "value").withColumn("ts", zoneless(F.date_trunc("millisecond", "ts"))).withColumn(
        "ts_ms", F.unix_millis(F.col("ts").cast("timestamp")))


def _struct(fields: dict[str, str]) -> str:
    return f"named_struct({', '.join(f'{name!r}, {e}' for name, e in fields.items())})"


def _reading_fields(reading_id: str = "concat('R', event_id)", device: str = "user_id",
                    value: str = "value", timestamp: str = "ts", updated: str = "ts") -> dict[str, str]:
    return {
        "_id": "concat('r', event_id)",
        "reading_id": reading_id,
        "device_id": f"cast({device} AS string)",
        "sensor_value": value,
        "unit": "CASE event_type WHEN 'signup' THEN '%' ELSE '°C' END",
        "quality": """CASE event_type WHEN 'error' THEN 'critical' WHEN 'purchase' THEN 'warning'
            ELSE 'good' END""",
        "timestamp": timestamp,
        "battery_level": "cast(event_id % 101 AS int)",
        "created_at": "ts",
        "updated_at": updated,
    }


def reading_documents(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """One reading document per event."""
    rows = _events(spark, sf_dir, streaming)
    return rows.selectExpr(*[f"{e} AS {name}" for name, e in _reading_fields().items()])


def flat(documents: DataFrame) -> DataFrame:
    """Documents as flat rows that were captured when they were last updated."""
    return documents.withColumnRenamed("_id", "mongo_id").withColumn(
        "event_timestamp", F.col("updated_at").cast("timestamp"))


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(device_documents(spark, sf_dir))


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(reading_documents(spark, sf_dir))


def _envelope_text(before: str, after: str, op: str, ts_ms: str) -> Column:
    return F.to_json(F.expr(f"named_struct('before', {before}, 'after', {after}, 'op', {op}, 'ts_ms', {ts_ms})"), _JSON)


def device_topic(spark: SparkSession, sf_dir: str, streaming: bool = False, spread: bool = False) -> DataFrame:
    """Creates of all devices, with the irregularities a log may hold: missing and bad time
    texts, missing capture times, other operations, missing images, text that is no JSON.

    The record is one expression over the table's own columns. Were it built over columns
    that are aliases themselves, the optimizer would derive a constraint for every
    combination of alias and source.
    """
    text, doc = f"'{TIME_FORMAT}'", _DEVICE_DOCUMENT
    fields = {
        **doc,
        "installed_date": f"""CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_custkey % 10 = 1 THEN 'bad'
            WHEN c_custkey % 10 = 2 THEN date_format({doc['installed_date']}, 'yyyy-MM-dd HH:mm:ss')
            ELSE date_format({doc['installed_date']}, {text}) END""",
        "created_at": f"date_format({doc['created_at']}, {text})",
        "updated_at": f"CASE WHEN c_custkey % 8 = 5 THEN NULL ELSE date_format({doc['updated_at']}, {text}) END",
    }
    image = _struct(fields)
    value = F.when(F.col("c_custkey") % 37 == 36, F.lit("garbage")).otherwise(_envelope_text(
        f"if(false, {image}, NULL)",
        f"if(c_custkey % 29 = 28, NULL, {image})",
        "CASE WHEN c_custkey % 19 = 18 THEN 'u' ELSE 'c' END",
        "if(c_custkey % 13 = 12, NULL, 1706745600000 + c_custkey * 1000)"))
    key = F.col("c_custkey")
    rows = _customers(spark, sf_dir, streaming)
    return as_records(_spread(rows) if spread else rows, value, key % 4, key, F.lit(None))


def reading_topic(spark: SparkSession, sf_dir: str, streaming: bool = False, timed: bool = False) -> DataFrame:
    """Creates of all readings, with updates, missing images and (unless ``timed``) missing capture times in between."""
    return _reading_topic_of(_events(spark, sf_dir, streaming), timed)


def _reading_topic_of(events: DataFrame, timed: bool) -> DataFrame:
    image = _struct(_reading_fields(reading_id="if(event_id % 41 = 0, NULL, concat('R', event_id))",
                           timestamp="if(event_id % 43 = 42, NULL, ts)"))
    value = _envelope_text(
        f"if(false, {image}, NULL)",
        f"if(event_id % 29 = 28, NULL, {image})",
        "CASE WHEN event_id % 19 = 18 THEN 'u' ELSE 'c' END",
        "ts_ms" if timed else "if(event_id % 13 = 12, NULL, ts_ms)")
    return as_records(events, value, F.col("event_id") % 4, F.col("event_id"), F.col("ts_ms"))


def timed_reading_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reading topic as a stream whose records all carry their capture time, so that the last of them closes windows."""
    return reading_topic(spark, sf_dir, streaming=True, timed=True)


def growing_reading_topic(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The reading topic as a folder that grows: each step adds a slice and gives the stream over all there is so far."""
    events, folder = _table(spark, sf_dir, "events"), fresh_dir(spark, "growing")
    batch, _ = _slice(events, "event_id")
    for i in range(SLICES):
        events.where(batch == i).write.mode("append").parquet(folder)
        yield _reading_topic_of(_with_times(spark.readStream.schema(events.schema).parquet(folder)), timed=False)


def late_reading_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timed reading topic, with every 50th record of the first batch arriving in the last."""
    rows = _as_log(_table(spark, sf_dir, "events"), "event_id", F.col("event_id") % 50 == 7)
    return _reading_topic_of(_with_times(rows), timed=True)


def early_device_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The device change log as a stream that falls silent after the first half of its time."""
    half = spark.read.parquet(f"{sf_dir}/events.parquet").agg(((F.min("event_id") + F.max("event_id")) / 2).alias("half")).first()["half"]
    return device_change_records(spark, sf_dir, streaming=True).where(F.col("pos") <= F.lit(half or 0))


def _device_image(threshold: str, updated: str) -> str:
    return _struct({
        "_id": "concat('d', user_id, if(event_id % 7 = 3, 'b', 'a'))",
        "device_id": "cast(if(event_id % 11 = 10, user_id + 1, user_id) AS string)",
        "device_name": "concat('Device ', user_id)",
        "device_type": "CASE WHEN user_id % 4 = 3 THEN 'humidity' ELSE 'temperature' END",
        "location": "event_type",
        "building": "concat('B', user_id % 5)",
        "floor_level": "cast(user_id % 10 AS int)",
        "area_type": "'technical'",
        "temperature_threshold": threshold,
        "installed_date": "ts - interval 30 days",
        "status": "'active'",
        "battery_level": "cast(event_id % 101 AS int)",
        "created_at": "ts - interval 1 day",
        "updated_at": updated,
    })


DEVICE_OP = """CASE WHEN event_id % 17 = 0 THEN 'd' WHEN event_id % 3 = 0 THEN 'u'
    WHEN event_id % 5 = 0 THEN 'r' ELSE 'c' END"""


def device_change_records(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """A device change log: one envelope per event, several documents per device id."""
    updated = "if(event_id % 31 = 30, NULL, ts)"
    before = _device_image("value + 1", f"{updated} - make_dt_interval(cast(event_id % 3 AS int))")
    after = _device_image("value", updated)
    rows = _events(spark, sf_dir, streaming).withColumn("op", F.expr(DEVICE_OP))
    value = _envelope_text(
        f"if(op IN ('u', 'd'), {before}, NULL)", f"if(op = 'd', NULL, {after})", "op", "ts_ms")
    return as_records(rows, value, F.col("event_id") % 4, F.col("event_id"), F.col("ts_ms"))


def _reading_changes(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Reading changes (``step``, ``op``, ``before``, ``after``): a create per event, an update of every
    fifth (to another day or device, or to no reading id at times), a delete of every 23rd."""
    first = _struct(_reading_fields(reading_id="if(event_id % 41 = 0, NULL, concat('R', event_id))"))
    second = _struct(_reading_fields(
        reading_id="if(event_id % 41 = 0 OR event_id % 35 = 0, NULL, concat('R', event_id))",
        device="if(event_id % 15 = 0, user_id + 1, user_id)", value="value + 1",
        timestamp="ts + make_dt_interval(cast(event_id % 2 AS int))", updated="ts + interval 1 hour"))
    last = f"if(event_id % 5 = 0, {second}, {first})"

    def record(step: int, op: str, before: str, after: str) -> str:
        return f"named_struct('step', {step}, 'op', '{op}', 'before', {before}, 'after', {after})"

    none = f"if(false, {first}, NULL)"
    records = F.expr(f"""inline(filter(array(
        {record(0, 'c', none, first)},
        if(event_id % 5 = 0, {record(1, 'u', first, second)}, NULL),
        if(event_id % 23 = 0, {record(2, 'd', last, none)}, NULL)), x -> x IS NOT NULL))""")
    return _events(spark, sf_dir, streaming).select("event_id", "ts_ms", records)


def _as_reading_records(rows: DataFrame, value: Column) -> DataFrame:
    return as_records(rows, value, F.col("event_id") % 4, F.col("event_id") * 3 + F.col("step"), F.col("ts_ms"))


def reading_change_records(spark: SparkSession, sf_dir: str, streaming: bool = False,
                           at: str = "ts_ms + step") -> DataFrame:
    """A reading change log. With ``at="ts_ms"`` all changes of a document carry one time."""
    rows = _reading_changes(spark, sf_dir, streaming)
    return _as_reading_records(rows, _envelope_text("before", "after", "op", at))


def _extended(image: Column, fields: list[T.StructField]) -> Column:
    """Fields of a document as extended JSON has them."""
    def value(f: T.StructField) -> Column:
        if not isinstance(f.dataType, T.TimestampNTZType):
            return image[f.name]
        text = F.date_format(image[f.name], "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        return F.when(text.isNotNull(), F.struct(text.alias("$date")))
    return F.struct(*[value(f).alias(f.name) for f in fields])


def _as_event_records(changes: DataFrame, payload: T.StructType, patched: Column, sets: tuple[str, ...] = ()) -> DataFrame:
    """Changes (``op``, ``key``, ``after``, ``ms``, ``step``, ``event_id``) as rows of a document database's connector.

    Many changes share a second: the increment tells them apart. No event carries an image before, a delete names its document only,
    and an update that is ``patched`` has the fields it sets instead of the document after it.
    """
    whole = {"ignoreNullFields": "false"}
    second, increment = F.floor(F.col("ms") / 1000), F.pmod(F.col("ms"), F.lit(1000)) * 4 + F.col("step") + 1
    patched = (F.col("op") == "u") & patched
    token = F.concat(*[F.lpad(F.hex(part), 16, "0") for part in (second, increment, F.col("event_id"))])
    stamp = F.struct(F.struct(second.alias("t"), increment.alias("i")).alias("$timestamp"))
    update = F.struct(_extended(F.col("after"), [f for f in payload if f.name in sets] or payload.fields).alias("updatedFields"),
                      F.array().cast("array<string>").alias("removedFields"))
    return connector_records(changes.select(
        F.to_json(F.struct(token.alias("_data"))).alias("_id"),
        F.expr("CASE op WHEN 'd' THEN 'delete' WHEN 'u' THEN 'update' WHEN 'r' THEN 'replace' ELSE 'insert' END").alias("operationType"),
        F.to_json(F.struct(F.col("key").alias("_id"))).alias("documentKey"),
        F.when(~patched & (F.col("op") != "d"), F.to_json(_extended(F.col("after"), payload.fields), whole)).alias("fullDocument"),
        F.lit(None).cast("string").alias("fullDocumentBeforeChange"),
        F.when(patched, F.to_json(update, whole)).alias("updateDescription"),
        F.to_json(stamp).alias("clusterTime")))


def reading_change_events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """The reading changes as a document database publishes them; every other update says only what it sets."""
    rows = _reading_changes(spark, sf_dir, streaming).select(
        "op", "after", "step", "event_id", F.expr("concat('r', event_id)").alias("key"), (F.col("ts_ms") + F.col("step")).alias("ms"))
    sets = ("reading_id", "device_id", "sensor_value", "timestamp", "updated_at")
    return _as_event_records(rows, READINGS, F.col("event_id") % 10 == 0, sets)


def device_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(device_change_records(spark, sf_dir), DEVICES)


def reading_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode(reading_change_records(spark, sf_dir), READINGS)


def device_change_events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """The device changes as a document database publishes them."""
    after = _device_image("value", "if(event_id % 31 = 30, NULL, ts)")
    events = _events(spark, sf_dir, streaming)
    rows = (events if streaming else _spread(events)).select(
        F.expr(DEVICE_OP).alias("op"), F.expr(after).alias("after"), F.lit(0).alias("step"), "event_id", F.col("ts_ms").alias("ms"),
        F.expr("concat('d', user_id, if(event_id % 7 = 3, 'b', 'a'))").alias("key"))
    return _as_event_records(rows, DEVICES, F.lit(False))
