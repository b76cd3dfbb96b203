"""Change events of a document database.

An event's place is its cluster time, a pair of seconds and an increment, and then its resume token: the database makes
tokens that sort like the events, also those of one transaction, which share a cluster time. Documents, times and keys are
extended JSON (``{"$date": …}``, ``{"$oid": …}``); plain values are taken as well.

:func:`change_records` frames events as one row per change, with images as JSON text::

    _id, op (c, u, d), before, after, patch, removed, ms, part, pos, token

which :func:`tidelog.streaming.images.with_images` can complete, and :func:`typed_changes` turns into changelog rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.timeparts import TIME_FORMAT
from tidelog.operators.changelog import BEFORE_ALL, image_rows, images, typed_fields
from tidelog.schemas import CHANGE_EVENT, as_text_times

RECORD = T.StructType([
    T.StructField("_id", T.StringType()), T.StructField("op", T.StringType()),
    T.StructField("before", T.StringType()), T.StructField("after", T.StringType()),
    T.StructField("patch", T.StringType()), T.StructField("removed", T.ArrayType(T.StringType())),
    T.StructField("ms", T.LongType()), T.StructField("part", T.IntegerType()),
    T.StructField("pos", T.LongType()), T.StructField("token", T.StringType()),
])


def _plain(text: Column, wrapper: str) -> Column:
    """The value of ``{"$wrapper": value}``, or the text itself."""
    return F.when(text.startswith("{"), F.get_json_object(text, f"$['{wrapper}']")).otherwise(text)


def _plain_time(text: Column) -> Column:
    """An extended date in the log's own form; plain text stays as it is."""
    instant = F.get_json_object(text, "$['$date']").try_cast("timestamp")
    return F.when(text.startswith("{"), F.date_format(instant, TIME_FORMAT)).otherwise(text)


def plain_image(document: Column, fields: Column, payload: T.StructType) -> Column:
    """A document of extended JSON as the JSON text of the payload's fields, null where there is no document. ``fields`` is what it parses to."""
    values = [
        (_plain_time(fields[f.name]) if isinstance(f.dataType, T.TimestampNTZType)
         else _plain(fields[f.name], "$oid") if f.name == "_id" else fields[f.name]).alias(f.name)
        for f in payload]
    return F.when(document.isNotNull(), F.to_json(F.struct(*values), {"ignoreNullFields": "false"}))


def change_records(records: DataFrame, payload: T.StructType, since: int | None = None) -> DataFrame:
    """One row per change (``RECORD``). Events that are no insert, update, replace or delete, and text that is no event, give none.

    A record without a cluster time has its place in the log instead. ``since`` leaves out events
    before that second of the cluster's time.
    """
    event = F.from_json("value", CHANGE_EVENT)
    rows = records.select(F.inline(F.array(event)), "part", "pos", "record_ms")
    time = F.from_json("clusterTime", "`$timestamp` struct<t: bigint, i: bigint>")["$timestamp"]
    # Each document is parsed by the generator, once: what is asked of its fields under a condition would parse it once per field.
    rows = rows.select("*", F.inline(F.array(F.struct(
        time.alias("time"), *[F.from_json(text, as_text_times(payload)).alias(name)
                              for name, text in (("was", "fullDocumentBeforeChange"), ("is", "fullDocument"))]))))
    kind = F.col("operationType")
    op = (F.when(kind == "insert", "c").when(kind.isin("update", "replace"), "u").when(kind == "delete", "d"))
    timed = F.col("time.t").isNotNull()
    framed = rows.where(kind.isin("insert", "update", "replace", "delete")).select(
        _plain(F.get_json_object("documentKey", "$._id"), "$oid").alias("_id"),
        op.alias("op"),
        plain_image(F.col("fullDocumentBeforeChange"), F.col("was"), payload).alias("before"),
        plain_image(F.col("fullDocument"), F.col("is"), payload).alias("after"),
        F.when(kind == "update", F.get_json_object("updateDescription", "$.updatedFields")).alias("patch"),
        F.when(kind == "update", F.from_json(F.get_json_object("updateDescription", "$.removedFields"), "array<string>")).alias("removed"),
        F.when(timed, F.col("time.t") * 1000).otherwise(F.coalesce("record_ms", F.lit(BEFORE_ALL))).alias("ms"),
        F.when(timed, F.lit(0)).otherwise(F.col("part")).alias("part"),
        F.when(timed, F.col("time.i")).otherwise(F.col("pos")).alias("pos"),
        F.coalesce(F.get_json_object("_id", "$._data"), F.col("_id")).alias("token"),
    ).where(F.col("_id").isNotNull())
    return framed if since is None else framed.where((F.col("ms") >= since * 1000) | (F.col("ms") == BEFORE_ALL))


def snapshot_records(documents: DataFrame, payload: T.StructType) -> DataFrame:
    """Existing documents as creates that precede every change (``RECORD``)."""
    options = {"ignoreNullFields": "false", "timestampNTZFormat": TIME_FORMAT}
    known = {
        "_id": F.col("_id"), "op": F.lit("c"), "after": F.to_json(F.struct(*payload.fieldNames()), options),
        "ms": F.lit(BEFORE_ALL), "part": F.lit(0), "pos": F.lit(0)}
    return documents.select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RECORD])


def typed_changes(changes: DataFrame, payload: T.StructType) -> DataFrame:
    """Framed changes to changelog rows. A delete without an image names its key: the row then holds the key and nothing else."""
    image = as_text_times(payload)
    key_only = F.struct(*[(F.col("_id") if f.name == "_id" else F.lit(None)).cast(f.dataType).alias(f.name) for f in image])
    before = F.coalesce(F.from_json("before", image), F.when(F.col("op") == "d", key_only))
    return image_rows(
        changes.select("op", before.alias("before"), F.from_json("after", image).alias("after"), "ms", "part", "pos", "token"),
        payload, keyed=True)


def typed_sides(changes: DataFrame, payloads: dict[str, T.StructType]) -> DataFrame:
    """Framed changes of several collections (``side``) to changelog rows with one struct per side; the other sides' are null."""
    before = F.coalesce("before", F.when(F.col("op") == "d", F.to_json(F.struct("_id"))))
    rows = images(changes.withColumn("before", before), keyed=True, also=("side",))
    parsed = F.struct(*[F.when(F.col("side") == side, F.from_json("image", as_text_times(payload))).alias(f"{side}_image")
                        for side, payload in payloads.items()])
    return rows.select("side", "row_kind", "seq", F.inline(F.array(parsed))).select("side", "row_kind", "seq", *[
        F.when(F.col("side") == side, F.struct(*typed_fields(F.col(f"{side}_image"), payload))).alias(side)
        for side, payload in payloads.items()])


def decode_change_events(records: DataFrame, payload: T.StructType) -> DataFrame:
    """Change events to changelog rows, with the images that the events carry."""
    return typed_changes(change_records(records, payload), payload)
