"""Change logs to keyed tables, by key and day."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidelog.operators import enrich, tables
from tidelog.operators.changelog import decode
from tidelog.schemas import DEVICES, KEYED_TABLES, READINGS, table_schema
from tidelog.sinks.catalog import create_database, create_keyed_table_sql
from tidelog.sinks.change_table import SEQ, ChangeTable, change_schema
from tidelog.sinks.merge import merge_batch
from tidelog.streaming.counts import DEVICE_COUNTS, READING_COUNTS
from tidelog.streaming.enriched_feed import OUTPUT_SEQ, EnrichedFeed, both_sides
from tidelog.streaming.queries import Trigger, chosen, start

DEVICE_TABLE, READING_TABLE, ENRICHED_TABLE = KEYED_TABLES


def keyed_table(spark: SparkSession, root: str, name: str) -> ChangeTable:
    """Open one of the keyed tables below ``root``."""
    columns, keys = KEYED_TABLES[name]
    payload = table_schema(columns)
    schema = change_schema(payload, OUTPUT_SEQ) if name == ENRICHED_TABLE else change_schema(payload)
    return ChangeTable(spark, f"{root.rstrip('/')}/{name}", schema, keys, by_day=True)


def keyed_tables(spark: SparkSession, root: str) -> dict[str, ChangeTable]:
    """All keyed tables, by name."""
    return {name: keyed_table(spark, root, name) for name in KEYED_TABLES}


def keyed_states(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The current rows of all keyed tables, by name."""
    return {name: table.current() for name, table in keyed_tables(spark, root).items()}


def create_keyed_tables(spark: SparkSession, database: str, fmt: str = "iceberg") -> list[str]:
    """Create the keyed tables in a catalog whose format supports MERGE. Returns their full names."""
    create_database(spark, database)
    names = []
    for name, (columns, _) in KEYED_TABLES.items():
        seq = OUTPUT_SEQ if name == ENRICHED_TABLE else SEQ
        spark.sql(create_keyed_table_sql(f"{database}.{name}", columns, seq, fmt))
        names.append(f"{database}.{name}")
    return names


def every(n: int | None, batch_id: int, merge: Callable[[int], object]) -> None:
    """Merge small folders after each n-th batch. The batch itself is left out, because it
    may run again until its checkpoint is written."""
    if n and batch_id and batch_id % n == 0:
        merge(batch_id)


def enriched_batch(feed: EnrichedFeed, table: ChangeTable, compact_every: int | None) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        table.write_batch(feed.apply(batch, batch_id), batch_id)
        every(compact_every, batch_id, lambda before: (feed.compact(before), table.compact(before)))

    return write


def start_upsert_lake(spark: SparkSession, device_records: DataFrame, reading_records: DataFrame, root: str,
                      trigger: Trigger = Trigger(), now: Column | None = None,
                      compact_every: int | None = 10, buckets: int = 64,
                      only: Collection[str] | None = None, merge_into: str | None = None) -> list[StreamingQuery]:
    """Three queries: devices, readings, and their join.

    ``spark`` is the session batches are processed in (with adaptive execution). ``buckets`` is
    the layout of the join's state: choose it so that one bucket of readings is a moderate read.
    With ``merge_into``, a database made by :func:`create_keyed_tables`, batches go there by MERGE; the state
    of the join stays below ``root``.
    """
    root = root.rstrip("/")
    device_changes = decode(device_records, DEVICES, count_as=DEVICE_COUNTS)
    reading_changes = decode(reading_records, READINGS, count_as=READING_COUNTS)

    def merged(name: str, rows: Callable[[DataFrame, int], DataFrame], compact: Callable[[int], object] | None = None):
        columns, keys = KEYED_TABLES[name]

        def write(batch: DataFrame, batch_id: int) -> None:
            merge_batch(rows(batch, batch_id), f"{merge_into}.{name}", columns, keys)
            if compact:
                every(compact_every, batch_id, compact)

        return write

    def plain(table: ChangeTable) -> Callable[[DataFrame, int], None]:
        def write(batch: DataFrame, batch_id: int) -> None:
            table.write_batch(batch, batch_id)
            every(compact_every, batch_id, table.compact)

        return write

    feed = EnrichedFeed(spark, f"{root}/_enriched_state", ["reading_id", "partition_date"],
                        enrich.LOG_TIMES, by_day=True, now=now, buckets=buckets)
    if merge_into:
        writers = {name: merged(name, lambda batch, batch_id: batch) for name in (DEVICE_TABLE, READING_TABLE)}
        writers[ENRICHED_TABLE] = merged(ENRICHED_TABLE, feed.apply, feed.compact)
    else:
        writers = {name: plain(keyed_table(spark, root, name)) for name in (DEVICE_TABLE, READING_TABLE)}
        writers[ENRICHED_TABLE] = enriched_batch(feed, keyed_table(spark, root, ENRICHED_TABLE), compact_every)
    streams = {
        DEVICE_TABLE: tables.devices_by_day(device_changes, now),
        READING_TABLE: tables.readings_by_day(reading_changes, now),
        ENRICHED_TABLE: both_sides(device_changes, tables.with_reading_day(reading_changes, now)),
    }
    outputs = {name: (stream, writers[name]) for name, stream in streams.items()}
    return [
        start(stream.writeStream.outputMode("append").foreachBatch(write), name, f"{root}/_checkpoints", trigger)
        for name, (stream, write) in chosen(outputs, only).items()
    ]
