"""Change logs: decode, encode, and reduction to the current state.

Spark rows have no kind, so a changelog frame carries it in columns:

``row_kind``
    ``+I`` insert, ``-U`` image before an update, ``+U`` image after it, ``-D`` delete.
``seq``
    the change's place in the log; a greater one is newer.

followed by the payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.timeparts import TIME_FORMAT, parse_time
from tidelog.schemas import envelope

INSERT, BEFORE_UPDATE, AFTER_UPDATE, DELETE = "+I", "-U", "+U", "-D"
CHANGE_COLUMNS = ["row_kind", "seq"]

# Snapshot rows precede every change.
BEFORE_ALL = -(2**63)


def sequence(ms: Column, deletes: Column, part: Column, pos: Column, ord_: Column, keyed: bool = True,
             token: Column | None = None) -> Column:
    """Order of a change: its time, then its position, then its ``token`` where the source has one.

    A keyed log holds all changes of a document in one partition, so at equal time the
    position decides. In a log that is not ``keyed`` positions of different partitions
    cannot be compared: there a delete sorts first, because an update that was written as
    delete + create must end in the created row.
    """
    return F.struct(
        ms.cast("bigint").alias("ms"),
        (F.lit(1) if keyed else F.when(deletes, 0).otherwise(1)).alias("rank"),
        part.cast("int").alias("part"),
        pos.cast("bigint").alias("pos"),
        (F.lit(None) if token is None else token).cast("string").alias("token"),
        ord_.cast("int").alias("ord"),
    )


def typed_fields(image: Column, payload: T.StructType) -> list[Column]:
    """The fields of a JSON image, time texts parsed."""
    return [
        (parse_time(image[f.name]) if isinstance(f.dataType, T.TimestampNTZType) else image[f.name]).alias(f.name)
        for f in payload
    ]


def images(parsed: DataFrame, keyed: bool, also: tuple[str, ...] = ()) -> DataFrame:
    """From (op, ms, part, pos, before, after) and maybe ``token`` to one row (row_kind, seq, image) per image that counts.

    The images are unfolded by a generator and filtered after it. The filter refers to
    generated columns, so it stays above the parsing: each record is parsed once, inside
    generated code, and no row is shuffled.
    """
    op = F.col("op")
    removed = F.struct(
        F.when(op == "u", BEFORE_UPDATE).when(op == "d", DELETE).alias("row_kind"),
        F.lit(0).alias("ord"),
        F.col("before").alias("image"),
    )
    added = F.struct(
        F.when(op.isin("c", "r"), INSERT).when(op == "u", AFTER_UPDATE).alias("row_kind"),
        F.lit(1).alias("ord"),
        F.col("after").alias("image"),
    )
    token = [c for c in ("token",) if c in parsed.columns]
    rows = parsed.select(*also, "op", "ms", "part", "pos", *token, F.inline(F.array(removed, added))).where(
        F.col("row_kind").isNotNull() & F.col("image").isNotNull())
    place = sequence(F.col("ms"), F.col("op") == "d", F.col("part"), F.col("pos"), F.col("ord"), keyed, *map(F.col, token))
    return rows.select(*also, "row_kind", place.alias("seq"), "image")


def image_rows(parsed: DataFrame, payload: T.StructType, keyed: bool, also: tuple[str, ...] = ()) -> DataFrame:
    """:func:`images`, each spread out into the payload's typed fields."""
    return images(parsed, keyed, also).select("row_kind", "seq", *also, *typed_fields(F.col("image"), payload))


def _fault(op: Column, before: Column, after: Column) -> Column:
    """Why a record gives no row, null where it gives one."""
    return (
        F.when(op.isNull(), "no operation")
        .when(~op.isin("c", "r", "u", "d"), "unknown operation")
        .when(op.isin("c", "r") & after.isNull(), "no image")
        .when((op == "u") & before.isNull() & after.isNull(), "no image")
        .when((op == "d") & before.isNull(), "no image"))


#: What may be wrong with a record, with the name that counts have it under.
FAULTS = {"no operation": "no_operation", "unknown operation": "unknown_operation", "no image": "no_image"}


def counted(parsed: DataFrame, name: str, fault: Column) -> DataFrame:
    """``parsed`` as it is; a running query reports, as metrics ``name`` of every batch, its records and those of each fault."""
    return parsed.observe(name, F.count(F.lit(1)).alias("records"), *[
        F.count_if(fault.eqNullSafe(reason)).alias(column) for reason, column in FAULTS.items()])


def decode(records: DataFrame, payload: T.StructType, keyed: bool = True, count_as: str | None = None,
           captured: bool = False) -> DataFrame:
    """Envelope records to changelog rows.

    ``c`` and ``r`` give ``+I``; ``u`` gives ``-U`` and ``+U`` (only ``+U`` when the
    source keeps no before-image); ``d`` gives ``-D``. Text that is no envelope, or
    an operation without its image, gives no row; with ``count_as`` such records are counted, see :func:`counted`. ``keyed``: see
    :func:`sequence`; :func:`encode` keys its records by document id. With ``captured`` rows also say when their record was written
    (``captured_ms``).
    """
    more = ["captured_ms"] if captured else []
    parsed = records.select(F.from_json("value", envelope(payload)).alias("change"), "part", "pos", "record_ms", *more)
    if count_as:
        parsed = counted(parsed, count_as, _fault(F.col("change.op"), F.col("change.before"), F.col("change.after")))
    parsed = parsed.select(
        "change.op", "change.before", "change.after", "part", "pos",
        F.coalesce("change.ts_ms", "record_ms", F.lit(BEFORE_ALL)).alias("ms"), *more,
    )
    return image_rows(parsed, payload, keyed, tuple(more))


def undecodable(records: DataFrame, payload: T.StructType) -> DataFrame:
    """The records that :func:`decode` gives no row for (``part, pos, value, reason``), to be counted or kept aside."""
    change = F.struct(F.from_json("value", envelope(payload)).alias("change"))
    reason = _fault(*(F.col(f"change.{name}") for name in ("op", "before", "after")))
    rows = records.select("part", "pos", "value", F.inline(F.array(change)))
    return rows.select("part", "pos", "value", reason.alias("reason")).where(F.col("reason").isNotNull())


def snapshot(documents: DataFrame, payload: T.StructType) -> DataFrame:
    """Existing documents as inserts that precede every change."""
    zero = F.lit(0)
    return documents.select(
        F.lit(INSERT).alias("row_kind"),
        sequence(F.lit(BEFORE_ALL), F.lit(False), zero, zero, zero).alias("seq"),
        *payload.fieldNames(),
    )


def snapshot_then_changes(documents: DataFrame, changes: DataFrame, payload: T.StructType) -> DataFrame:
    """Start mode *initial*: the full collection first, its changes after."""
    return snapshot(documents, payload).unionByName(changes)


def encode(changes: DataFrame, payload: T.StructType) -> DataFrame:
    """Changelog rows to envelope records (``key``, ``value``).

    Every row becomes a record of its own: ``+I`` and ``+U`` a create, ``-U`` and
    ``-D`` a delete. An update therefore leaves as delete + create. Keying a record
    by document id keeps a document's changes in one partition, in order.
    """
    image = F.struct(*payload.fieldNames())
    gone = F.col("row_kind").isin(BEFORE_UPDATE, DELETE)
    body = F.struct(
        F.when(gone, image).alias("before"),
        F.when(~gone, image).alias("after"),
        F.when(gone, "d").otherwise("c").alias("op"),
    )
    options = {"ignoreNullFields": "false", "timestampNTZFormat": TIME_FORMAT}
    return changes.select(
        "row_kind", "seq", F.col("_id").alias("key"), F.to_json(body, options).alias("value"),
    )


def insert_only(parsed: DataFrame) -> DataFrame:
    """Creates with an image, from parsed records (column ``change``): what the append tables accept.

    Since :func:`encode` writes an update as delete + create, images after an update
    arrive here as well; a native ``u`` does not. The generator keeps the filter above the
    parser: pushed below it, it would parse every record once more per condition.
    """
    changes = parsed.select(F.inline(F.array("change")))
    return changes.where(F.col("after").isNotNull() & (F.col("op") == "c"))


def leaving(changes: DataFrame) -> DataFrame:
    """Images before an update as deletes of the key they carry.

    Needed where an update can change the key: the row of the old key goes. The image after
    the update is newer (``ord``), so an update that keeps its key replaces its row.
    """
    kind = F.when(F.col("row_kind") == BEFORE_UPDATE, DELETE).otherwise(F.col("row_kind"))
    return changes.withColumn("row_kind", kind)


def latest_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """The newest change per key, deletes included.

    A before-image by itself removes nothing (see :func:`leaving`), so ``-U`` rows are left out.
    The aggregate reduces each input partition before the exchange: at most one row
    per key and partition is shuffled, however hot the key.
    """
    payload = [c for c in changes.columns if c not in keys and c != "seq"]
    newest = F.max(F.struct("seq", *payload)).alias("newest")
    rows = changes.where(F.col("row_kind") != BEFORE_UPDATE).groupBy(*keys).agg(newest)
    return rows.select(*[F.col(c) if c in keys else F.col(f"newest.{c}").alias(c) for c in changes.columns])


def current_state(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a keyed table: the newest change per key, deleted keys gone."""
    return latest_changes(changes, keys).where(F.col("row_kind") != DELETE)
