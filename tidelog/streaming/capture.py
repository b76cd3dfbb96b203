"""Document collections to change logs."""

from __future__ import annotations

import time
from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators.change_events import RECORD, change_records, snapshot_records, typed_changes
from tidelog.operators.changelog import snapshot
from tidelog.schemas import DEVICES, READINGS
from tidelog.sinks.change_log import log_batch, log_stream
from tidelog.sources.lake import is_complete
from tidelog.streaming.images import with_images
from tidelog.streaming.queries import Trigger, chosen, start

_POSITION = "second bigint"


def capture_snapshot(documents: DataFrame, payload: T.StructType, now: Column | None = None, **sink: str) -> None:
    """Write a whole collection as creates that precede every change, by itself.

    Open the change stream first, then take the snapshot: a change that falls in between is in both,
    and the greater ``seq`` of the change decides. A directory written by a stream shows only that
    stream's files, so in files the snapshot gets a folder of its own, and consumers read both.
    ``start_capture`` with ``collections`` does both in one job.
    """
    log_batch(snapshot(documents, payload), payload, now=now, **sink)


def start_position(spark: SparkSession, checkpoints: str, clock: Callable[[], float] = time.time) -> int:
    """The second from which a capture reads changes: now at the first call, the same ever after.

    Ask for it *before* the collection is read; then no change falls between the snapshot and the stream.
    """
    path = f"{checkpoints.rstrip('/')}/_start_position"
    if not is_complete(spark, path):
        spark.createDataFrame([(int(clock()),)], _POSITION).write.mode("overwrite").parquet(path)
    return spark.read.schema(_POSITION).parquet(path).first()["second"]


def _snapshot_stream(spark: SparkSession, collection: Callable[[], DataFrame], payload: T.StructType, path: str) -> DataFrame:
    """The collection as a stream that has all of it at once. It is read and written once: a restart finds it whole, or starts it over."""
    if not is_complete(spark, path):
        snapshot_records(collection(), payload).write.mode("overwrite").parquet(path)
    return spark.readStream.schema(RECORD).parquet(path)


def start_capture(device_events: DataFrame, reading_events: DataFrame, device_sink: dict, reading_sink: dict,
                  checkpoints: str, trigger: Trigger = Trigger(), now: Column | None = None,
                  only: Collection[str] | None = None, images: bool = True, since: int | None = None,
                  collections: dict[str, Callable[[], DataFrame]] | None = None) -> list[StreamingQuery]:
    """Write both collections' change events as envelope records.

    A sink is ``{"fmt": "kafka", "topic": …, "kafka.bootstrap.servers": …}`` or
    ``{"path": …}``. Delivery to a broker is at least once: consumers order by ``seq``,
    so a repeated record has no effect on keyed tables.

    With ``images`` every change leaves with its full images (:mod:`tidelog.streaming.images`); without, with those the event carries.

    ``collections`` (a function that opens each collection, by output name) is the start mode *initial*: the collection goes first,
    then its changes, in one query with one checkpoint. Get ``since`` from :func:`start_position` and open the
    events from there. A restart gives the same arguments; the collection is not read again. A change that the snapshot already
    holds comes out once more as an update to the same image.
    """
    outputs = {
        "capture_devices": (device_events, DEVICES, device_sink),
        "capture_readings": (reading_events, READINGS, reading_sink),
    }
    queries = []
    for name, (events, payload, sink) in chosen(outputs, only).items():
        changes = change_records(events, payload, since)
        if collections and name in collections:
            changes = changes.unionByName(_snapshot_stream(
                events.sparkSession, collections[name], payload, f"{checkpoints.rstrip('/')}/_snapshots/{name}"))
        rows = typed_changes(with_images(changes) if images else changes, payload)
        queries.append(start(log_stream(rows, payload, now=now, **sink), name, checkpoints, trigger))
    return queries
