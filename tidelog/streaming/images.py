"""Complete images for every change: the newest image of each document, kept as stream state.

A database does not always publish the image before a change: a delete may name its key only, an update only the fields it
sets. Tables keyed by more than the document's id need those images, or a delete cannot find its row. This operator
keeps one image per document and hands it out as the image before the next change, as a changelog normalised by its primary key has it:

* a delete leaves with the image it removes, an update with the image it replaces; a create of a document that is there
  counts as its update;
* an update without an image after it gets one from the fields it sets and removes;
* a change that is not newer than the document's last one (a replay, a repeated event) goes.

State holds one image per document, deleted ones included (without image), so that older changes which come late stay out. What a call of
Python costs is far more than what a change costs in it, so documents are dealt out to buckets: a call takes a bucket's changes of a micro-batch,
and a bucket's images are one packed row of state, which is rewritten when one of its documents changes.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict, namedtuple
from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidelog.operators.change_events import RECORD

_STATE = T.StructType([T.StructField("documents", T.BinaryType())])
#: Documents are dealt out to so many buckets.
BUCKETS = 4096
_Change = namedtuple("_Change", [f.name.strip("_") for f in RECORD])


def _packed(documents: dict[str, tuple]) -> bytes:
    return zlib.compress(json.dumps(documents).encode(), 1)


def _unpacked(packed: bytes) -> dict[str, list]:
    """(ms, part, pos, token, image) of the newest change, by document."""
    return json.loads(zlib.decompress(packed))


def _plain(value: object) -> object:
    """A value of extended JSON as the log has it."""
    if isinstance(value, dict) and "$date" in value:
        return datetime.fromisoformat(value["$date"]).strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]
    return value["$oid"] if isinstance(value, dict) and "$oid" in value else value


def patched(image: str | None, fields: str | None, removed: list[str] | None) -> str | None:
    """An image after an update of some fields; None where there is no image to update. Fields that the image does not have are left out."""
    if image is None:
        return None
    row = json.loads(image)
    changed = {**{name: None for name in ([] if removed is None else removed)}, **json.loads(fields or "{}")}
    row.update({name: _plain(value) for name, value in changed.items() if name in row})
    return json.dumps(row, ensure_ascii=False)


def _place(change: _Change) -> tuple:
    return int(change.ms), int(change.part), int(change.pos), change.token or ""


def _completed(changes: list[_Change], last: tuple | None, image: str | None) -> tuple[list[tuple], tuple | None, str | None]:
    """The changes of one document in one micro-batch, in order, with both images; then the place of its last change, and its image."""
    out = []
    for place, row in sorted(((_place(row), row) for row in changes), key=lambda pair: pair[0]):
        if last is not None and place <= last:
            continue
        last = place
        before = image if image is not None else row.before
        after = None if row.op == "d" else row.after if row.after is not None else patched(before, row.patch, row.removed)
        if after is None and row.op != "d":
            continue  # nothing is known of the document, and the change does not tell
        op = "d" if after is None else "c" if before is None else "u"
        out.append((row.id, op, before, after, None, None, *place))
        image = after
    return out, last, image


def _complete(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The changes of one bucket in one micro-batch, each document's in order."""
    changes, out = defaultdict(list), []
    for rows in batches:
        for row in rows[RECORD.fieldNames()].itertuples(index=False, name=None):
            changes[row[0]].append(_Change(*row))
    documents = _unpacked(state.get[0]) if state.exists else {}
    for document, some in changes.items():
        *last, image = documents.get(document, (None,))
        rows, last, image = _completed(some, tuple(last) or None, image)
        out += rows
        if last is not None:
            documents[document] = (*last, image)
    state.update((_packed(documents),))
    *side, _ = key
    yield pd.DataFrame([(*side, *row) for row in out], columns=[*["side"][:len(side)], *RECORD.fieldNames()])


def with_images(changes: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Framed changes (see :mod:`tidelog.operators.change_events`) with the images before and after them.

    Where ``changes`` has a column ``side``, ids of different sides are different documents: a query may hold one such operator
    only, so two collections that meet in it go through together. State is spread by buckets of documents; what a task holds at
    a time is one bucket's images and its changes of one micro-batch. ``buckets`` stays as it is for the life of a checkpoint.
    """
    sides = [T.StructField("side", T.StringType())] if "side" in changes.columns else []
    keys = [*[f.name for f in sides], "bucket"]
    bucket = F.pmod(F.xxhash64("_id"), F.lit(buckets)).cast("int")
    return changes.withColumn("bucket", bucket).groupBy(*keys).applyInPandasWithState(
        _complete, T.StructType([*sides, *RECORD]), _STATE, "append", GroupStateTimeout.NoTimeout)
