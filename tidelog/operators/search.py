"""Search actions: one per document id, with the document as JSON.

``version`` orders the actions on one document. A search service that compares it
(external versioning, equal versions accepted) ignores an action that is older than
what it holds, so repeated and late deliveries do no harm.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.documents import document_id
from tidelog.functions.timeparts import TIME_FORMAT
from tidelog.operators.changelog import DELETE, latest_changes

ACTION_COLUMNS = ["_index", "_id", "action", "version", "doc"]


def document_version(seq: Column) -> Column:
    """Change time and rank in one number; snapshot rows are 1. In a keyed log the rank is
    the same for all changes, so of two in one millisecond the later request stands."""
    return F.greatest(seq["ms"], F.lit(0)) * 2 + seq["rank"]


def database_version(seq: Column) -> Column:
    """Cluster time of a document database in one number: 32 bits of seconds, 32 of the increment; snapshot rows are 0."""
    return F.shiftleft(F.floor(F.greatest(seq["ms"], F.lit(0)) / 1000), 32) + F.when(seq["ms"] > 0, seq["pos"]).otherwise(0)


def search_actions(rows: DataFrame, index: str, keys: list[str], fields: list[str],
                   version: Callable[[Column], Column] = document_version) -> DataFrame:
    """Turn keyed rows (one per key) into index and delete actions."""
    gone = F.col("row_kind") == DELETE
    options = {"ignoreNullFields": "false", "timestampNTZFormat": TIME_FORMAT}
    doc = F.to_json(F.struct(*fields), options)
    return rows.select(
        F.lit(index).alias("_index"),
        document_id(*[F.col(k) for k in keys]).alias("_id"),
        F.when(gone, "delete").otherwise("index").alias("action"),
        version(F.col("seq")).alias("version"),
        F.when(~gone, doc).alias("doc"),
    )


def documents(changes: DataFrame, index: str, fields: list[str],
              version: Callable[[Column], Column] = document_version) -> DataFrame:
    """Actions for one entity's changes, keyed by document id."""
    latest = latest_changes(changes, ["_id"]).withColumnRenamed("_id", "mongo_id")
    return search_actions(latest, index, ["mongo_id"], fields, version)
