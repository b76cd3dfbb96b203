"""Change logs as record streams.

Every source yields the same five columns, so that the decoders do not care where
a record comes from:

==============  =========================================================
``value``       the JSON text of the change
``part``        partition of the log (0 for files)
``pos``         position in that partition
``record_ms``   record time, used when the change itself carries none
``captured_ms`` when the capture wrote the record, where it says so
==============  =========================================================
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.schemas import CHANGE_EVENT

# A record in a file: the log position travels with it. ``value`` may be any JSON text.
FILE_RECORD = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("pos", T.LongType()),
    T.StructField("record_ms", T.LongType()),
    T.StructField("captured_ms", T.LongType()),
])


def read_records(spark: SparkSession, fmt: str = "json", streaming: bool = False,
                 path: str | None = None, **options: str) -> DataFrame:
    """Read a change log from a broker (``kafka``) or from a directory.

    ``json`` and ``parquet`` directories hold ``FILE_RECORD`` rows. A ``text``
    directory holds one bare change per line: its position is unknown, so such
    changes must carry ``ts_ms`` to be ordered.
    """
    reader = spark.readStream if streaming else spark.read
    reader = reader.format(fmt)
    if fmt == "kafka":
        # A first run starts at the earliest offset; later runs resume from the
        # checkpoint, which plays the part of the consumer group's offsets.
        # The capture time travels as a header.
        options = {"startingOffsets": "earliest", "includeHeaders": "true", **options}
        return kafka_records(reader.options(**options).load())
    if fmt == "text":
        rows = reader.options(**options).load(path)
        return rows.select(
            "value",
            F.lit(0).alias("part"),
            F.lit(0).cast("bigint").alias("pos"),
            F.lit(None).cast("bigint").alias("record_ms"),
            F.lit(None).cast("bigint").alias("captured_ms"),
        )
    return reader.schema(FILE_RECORD).options(**options).load(path)


def kafka_records(rows: DataFrame) -> DataFrame:
    """Rows of the broker source in record form; tombstones (no value) are dropped."""
    if "headers" in rows.columns:
        sent = F.get(F.filter("headers", lambda h: h["key"] == "event_timestamp"), F.lit(0))["value"]
        captured = sent.cast("string").try_cast("bigint")
    else:
        captured = F.lit(None).cast("bigint")
    return rows.where(F.col("value").isNotNull()).select(
        F.col("value").cast("string").alias("value"),
        F.col("partition").cast("int").alias("part"),
        F.col("offset").cast("bigint").alias("pos"),
        F.unix_millis(F.col("timestamp")).alias("record_ms"),
        captured.alias("captured_ms"),
    )


def read_change_events(spark: SparkSession, fmt: str = "json", streaming: bool = False,
                       path: str | None = None, since: int | None = None, **options: str) -> DataFrame:
    """Read a document collection's change events as records.

    With the document-database connector on the classpath (``mongodb``), whole change events are asked for, with the current
    document of an update and, where the collection keeps them, the image before a change; ``since`` starts the stream at that second. Event
    rows become JSON text; :func:`tidelog.operators.change_events.change_records` types them.
    """
    if fmt != "mongodb":
        return read_records(spark, fmt, streaming, path, **options)
    asked = {"change.stream.publish.full.document.only": "false",
             "change.stream.lookup.full.document": "updateLookup",
             "change.stream.lookup.full.document.before.change": "whenAvailable"}
    if since is not None:
        asked |= {"change.stream.startup.mode": "timestamp", "change.stream.startup.mode.timestamp.start.at.operation.time": str(since)}
    reader = spark.readStream if streaming else spark.read
    return connector_records(reader.format(fmt).schema(CHANGE_EVENT).options(**{**asked, **options}).load())


def connector_records(rows: DataFrame) -> DataFrame:
    """Rows of the document-database connector (``CHANGE_EVENT``) in record form. Their place is in the event itself."""
    return as_records(rows, F.to_json(F.struct(*CHANGE_EVENT.fieldNames())), F.lit(0), F.lit(0), F.lit(None))


def as_records(df: DataFrame, value: Column, part: Column, pos: Column, record_ms: Column) -> DataFrame:
    """Frame any rows as records (used to derive a log from a table)."""
    return df.select(
        value.alias("value"), part.cast("int").alias("part"),
        pos.cast("bigint").alias("pos"), record_ms.cast("bigint").alias("record_ms"),
        F.lit(None).cast("bigint").alias("captured_ms"),
    )
