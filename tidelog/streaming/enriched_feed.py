"""Changes of the joined table, batch by batch.

A device change alters every row joined with that device; a reading change alters one row.
Each batch yields just the rows concerned, found without scanning what did not change:

* Both sides are kept in tables bucketed and sorted by ``device_id``. New readings look up
  their devices; a changed device looks up its readings.
* An output row carries the reading's ``seq`` and the number of the batch that made it, and
  the greatest such pair wins. So a row that was made from an outdated reading loses by
  itself, and no batch has to search for the reading versions it replaces.

After each batch the winning rows are what joining the full current tables would give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators import enrich
from tidelog.operators.changelog import BEFORE_UPDATE, DELETE, latest_changes
from tidelog.schemas import DEVICES, READINGS, table_schema
from tidelog.sinks.change_table import SEQ, ChangeTable, change_schema

OUTPUT_SEQ = T.StructType([*SEQ.fields, T.StructField("batch", T.LongType())])


def both_sides(device_changes: DataFrame, reading_changes: DataFrame) -> DataFrame:
    """Two change streams as one, so that a single query sees both in order of arrival."""
    device = F.struct(*DEVICES.fieldNames()).alias("device")
    reading = F.struct(*[c for c in reading_changes.columns if c not in ("row_kind", "seq")]).alias("reading")
    left = device_changes.select(F.lit("device").alias("side"), "row_kind", "seq", device)
    right = reading_changes.select(F.lit("reading").alias("side"), "row_kind", "seq", reading)
    return left.unionByName(right, allowMissingColumns=True)


class EnrichedFeed:
    """Joins two change streams and remembers what it needs in ``path``."""

    def __init__(self, spark: SparkSession, path: str, reading_keys: list[str], times: list[str],
                 by_day: bool, now: Column | None = None, buckets: int = 64):
        self.spark, self.reading_keys, self.times, self.now = spark, reading_keys, times, now
        path = path.rstrip("/")
        # Holds one batch at a time.
        self.incoming = f"{path}/incoming"
        reading = T.StructType([*READINGS.fields, *([T.StructField("partition_date", T.StringType())] if by_day else [])])
        self.reading_schema = reading
        self.devices = ChangeTable(
            spark, f"{path}/devices", change_schema(DEVICES), ["device_id", "_id"],
            bucket_by=["device_id"], buckets=buckets)
        # Which device ids a document has had: the same rows without their payload, to be found by document.
        places = T.StructType([DEVICES["device_id"], DEVICES["_id"]])
        self.places = ChangeTable(
            spark, f"{path}/places", change_schema(places), ["device_id", "_id"], bucket_by=["_id"], buckets=buckets)
        self.readings = ChangeTable(
            spark, f"{path}/readings", change_schema(reading), reading_keys,
            bucket_by=["device_id"], buckets=buckets)
        self.output_columns = [*enrich.JOINED_COLUMNS, *(["partition_date"] if by_day else [])]

    def output_schema(self) -> T.StructType:
        return change_schema(table_schema(self.output_columns), OUTPUT_SEQ)

    def apply(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Take in a batch; returns the changes of the joined table it causes.

        The batch is written first and read back per side: its source is read once, and what
        follows is ordinary batch work under adaptive execution, safe to run again. A file holds one side, as the two logs
        meet in a union, so a reader's filter skips the others by their statistics and the write need not sort rows by side.
        """
        batch.write.mode("overwrite").parquet(self.incoming)
        arrived = self._side("device", DEVICES)
        self.readings.write_batch(self._side("reading", self.reading_schema), batch_id)
        self.devices.write_batch(self._settle_devices(arrived, batch_id), batch_id)
        self.places.write_batch(self.devices.batch(batch_id), batch_id)
        fresh = self.readings.batch(batch_id)
        moved = self.devices.batch(batch_id).select("device_id").distinct()

        stored = self._rows_of(self.readings, moved, before=batch_id)
        concerned = latest_changes(fresh.unionByName(stored), self.reading_keys)

        asked = fresh.select("device_id").union(moved).distinct()
        known = latest_changes(self._rows_of(self.devices, asked), self.devices.keys)
        known = known.where(F.col("row_kind") != DELETE)
        joined = enrich.join_winners(concerned, enrich.device_winners(known), self.times, self.now, how="left")
        seq = F.struct("seq.*", F.lit(batch_id).cast("bigint").alias("batch")).alias("seq")
        return enrich.mark_unmatched(joined).select("row_kind", seq, *self.output_columns)

    def compact(self, before: int | None = None) -> None:
        for table in (self.devices, self.places, self.readings):
            table.compact(before)

    def _rows_of(self, table: ChangeTable, ids: DataFrame, before: int | None = None) -> DataFrame:
        """Rows of a table that belong to some device ids, from the buckets of these ids."""
        ids = ids.where(F.col("device_id").isNotNull())
        return table.changes(table.buckets_of(ids), before).join(ids, "device_id", "left_semi").select(
            *table.schema.fieldNames())

    def _side(self, side: str, payload: T.StructType) -> DataFrame:
        schema = T.StructType([
            T.StructField("row_kind", T.StringType()), T.StructField("seq", SEQ), T.StructField(side, payload),
            T.StructField("side", T.StringType())])
        rows = self.spark.read.schema(schema).parquet(self.incoming).where(F.col("side") == side)
        return rows.select("row_kind", "seq", f"{side}.*")

    def _settle_devices(self, arrived: DataFrame, batch_id: int) -> DataFrame:
        """Device changes with the departures they imply.

        The table is keyed by (device_id, _id), because readings ask for a device id. A document
        that now has another device id must leave the old one: the before-image names it, or the
        stored row does. Of all rows of a document only the newest stands; the others are written
        as deletes with the newest row's ``seq``.
        """
        if arrived.isEmpty():
            return arrived
        kind = F.when(F.col("row_kind") == BEFORE_UPDATE, DELETE).otherwise(F.col("row_kind"))
        fresh = arrived.withColumns({"row_kind": kind, "stored": F.lit(False)})
        # The lookup by document reads the buckets of the documents that have changed.
        stored = self.places.changes(self.places.buckets_of(arrived), before=batch_id)
        stored = stored.join(arrived.select("_id").distinct(), "_id", "left_semi").withColumn("stored", F.lit(True))
        per_place = latest_changes(fresh.unionByName(stored, allowMissingColumns=True), ["device_id", "_id"])
        newest = per_place.groupBy("_id").agg(F.max("seq").alias("newest"))
        stands = F.col("seq") == F.col("newest")
        settled = per_place.join(newest, "_id").where(
            ~F.col("stored") | (~stands & (F.col("row_kind") != DELETE)))
        return settled.withColumns({
            "row_kind": F.when(stands, F.col("row_kind")).otherwise(DELETE), "seq": F.col("newest"),
        })
