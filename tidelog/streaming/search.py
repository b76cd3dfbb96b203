"""Change streams to search documents."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidelog import schemas
from tidelog.operators import enrich
from tidelog.operators.change_events import change_records, typed_changes, typed_sides
from tidelog.operators.changelog import decode
from tidelog.operators.search import database_version, document_version, documents, search_actions
from tidelog.sinks.bulk import FLUSH_ACTIONS, FLUSH_BYTES, write_bulk, write_requests
from tidelog.streaming.counts import DEVICE_COUNTS, READING_COUNTS
from tidelog.streaming.enriched_feed import EnrichedFeed, both_sides
from tidelog.streaming.images import with_images
from tidelog.streaming.queries import Trigger, chosen, start
from tidelog.streaming.upsert_lake import every

# Index names and joined fields, through the log and directly.
LOG_INDICES = ("iot_devices", "iot_sensor_readings", "iot_enriched_data")
DIRECT_INDICES = ("devices", "sensor_readings", "devices_readings")

Writer = Callable[[DataFrame, str, int], None]


def file_writer(root: str) -> Writer:
    """Bulk requests as files, one folder per index and batch."""
    return lambda actions, index, batch_id: write_bulk(actions, f"{root.rstrip('/')}/{index}", batch_id)


def request_writer(root: str, max_actions: int = FLUSH_ACTIONS, max_bytes: int = FLUSH_BYTES, lanes: int = 64) -> Writer:
    """Request bodies cut by actions and bytes, one folder per index and batch."""
    return lambda actions, index, batch_id: write_requests(
        actions, f"{root.rstrip('/')}/{index}", batch_id, max_actions, max_bytes, lanes)


def _database_changes(records: DataFrame, payload: T.StructType) -> DataFrame:
    return typed_changes(with_images(change_records(records, payload)), payload)


def _database_sides(devices: DataFrame, readings: DataFrame) -> DataFrame:
    """:func:`both_sides` of a document database's events."""
    framed = [change_records(records, payload).withColumn("side", F.lit(side))
              for side, records, payload in (("device", devices, schemas.DEVICES), ("reading", readings, schemas.READINGS))]
    return typed_sides(with_images(framed[0].unionByName(framed[1])), {"device": schemas.DEVICES, "reading": schemas.READINGS})


def start_search(spark: SparkSession, device_records: DataFrame, reading_records: DataFrame, root: str,
                 direct: bool = False, writer: Writer | None = None, trigger: Trigger = Trigger(),
                 now: Column | None = None, compact_every: int | None = 10, buckets: int = 64,
                 only: Collection[str] | None = None) -> list[StreamingQuery]:
    """Three queries: device documents, reading documents, joined documents.

    ``direct`` reads a document database's change events instead of envelope records and completes their images, uses the
    other index names, and leaves ``installed_date`` and ``updated_at`` out of the joined documents.
    A batch sends at most one action per document.
    """
    root = root.rstrip("/")
    def logged(records: DataFrame, payload: T.StructType) -> DataFrame:
        return decode(records, payload, count_as=DEVICE_COUNTS if payload is schemas.DEVICES else READING_COUNTS)

    read = _database_changes if direct else logged
    version = database_version if direct else document_version
    device_index, reading_index, joined_index = DIRECT_INDICES if direct else LOG_INDICES
    fields = schemas.ENRICHED_DIRECT_DOC if direct else schemas.ENRICHED_DOC
    times = enrich.DIRECT_TIMES if direct else enrich.LOG_TIMES
    send = writer or file_writer(f"{root}/bulk")
    device_changes, reading_changes = read(device_records, schemas.DEVICES), read(reading_records, schemas.READINGS)
    feed = EnrichedFeed(spark, f"{root}/_enriched_state", ["_id"], times, by_day=False, now=now, buckets=buckets)

    def entity(index: str, doc_fields: list[str]) -> Callable[[DataFrame, int], None]:
        return lambda batch, batch_id: send(documents(batch, index, doc_fields, version), index, batch_id)

    def joined(batch: DataFrame, batch_id: int) -> None:
        rows = feed.apply(batch, batch_id)
        send(search_actions(rows, joined_index, ["reading_mongo_id"], fields, version), joined_index, batch_id)
        every(compact_every, batch_id, feed.compact)

    outputs = {
        device_index: (device_changes, entity(device_index, schemas.DEVICE_DOC)),
        reading_index: (reading_changes, entity(reading_index, schemas.READING_DOC)),
        joined_index: (_database_sides(device_records, reading_records) if direct else both_sides(device_changes, reading_changes), joined),
    }
    return [
        start(stream.writeStream.outputMode("append").foreachBatch(write), f"search_{name}",
              f"{root}/_checkpoints", trigger)
        for name, (stream, write) in chosen(outputs, only).items()
    ]
