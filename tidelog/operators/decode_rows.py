"""Envelope records to typed rows, the way the append tables read them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.timeparts import event_time, payload_time
from tidelog.operators.changelog import counted, insert_only
from tidelog.schemas import DEVICES, READINGS, as_text_times


def parse_envelope(records: DataFrame, payload: T.StructType) -> DataFrame:
    """``after``, ``op`` and ``ts_ms`` of each record, as struct ``change``; the before-image is not parsed."""
    schema = T.StructType([
        T.StructField("after", as_text_times(payload)),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ])
    return records.select(F.from_json("value", schema).alias("change"))


def _flatten(creates: DataFrame, payload: T.StructType, now: Column | None) -> DataFrame:
    columns = []
    for field in payload:
        value = F.col(f"after.{field.name}")
        if isinstance(field.dataType, T.TimestampNTZType):
            value = payload_time(value, now)
        columns.append(value.alias("mongo_id" if field.name == "_id" else field.name))
    return creates.select(*columns, event_time(F.col("ts_ms"), now).alias("event_timestamp"))


def _creates(records: DataFrame, payload: T.StructType, count_as: str | None) -> DataFrame:
    parsed = parse_envelope(records, payload)
    if count_as:
        op, after = F.col("change.op"), F.col("change.after")
        # Updates and deletes are none of the append tables' business, so their images are not asked for.
        fault = (F.when(op.isNull(), "no operation").when(~op.isin("c", "r", "u", "d"), "unknown operation")
                 .when((op == "c") & after.isNull(), "no image"))
        parsed = counted(parsed, count_as, fault)
    return insert_only(parsed)


def device_rows(records: DataFrame, now: Column | None = None, count_as: str | None = None) -> DataFrame:
    """Created devices, flat, with ``event_timestamp`` (a TIMESTAMP, fit for a watermark). ``count_as``: see ``changelog.counted``."""
    return _flatten(_creates(records, DEVICES, count_as), DEVICES, now)


def reading_rows(records: DataFrame, now: Column | None = None, count_as: str | None = None) -> DataFrame:
    """Created readings, flat, with ``event_timestamp``."""
    return _flatten(_creates(records, READINGS, count_as), READINGS, now)
