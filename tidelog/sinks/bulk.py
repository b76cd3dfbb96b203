"""Search actions as bulk requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.schemas import table_schema


def bulk_lines(actions: DataFrame) -> DataFrame:
    """One text per action: the action line and, for an index action, the document line.

    The version is sent as an external one. The service then keeps the newest document,
    in whatever order requests arrive, and accepts an equal version.
    """
    return _lines(actions).select("value")


def _lines(actions: DataFrame) -> DataFrame:
    meta = F.struct("_index", "_id", "version", F.lit("external_gte").alias("version_type"))
    head = F.when(F.col("action") == "delete", F.to_json(F.struct(meta.alias("delete")))).otherwise(
        F.to_json(F.struct(meta.alias("index"))))
    return actions.where(F.col("_id").isNotNull()).select(
        "_index", "_id", "action", F.concat_ws("\n", head, F.col("doc")).alias("value"))


# A request is sent once it holds so many actions or bytes; what is left goes when the micro-batch ends.
FLUSH_ACTIONS, FLUSH_BYTES = 1, 1 << 20


def flushes(actions: DataFrame, max_actions: int = FLUSH_ACTIONS, max_bytes: int = FLUSH_BYTES, lanes: int = 64) -> DataFrame:
    """Which request each action goes with: ``_index, lane, request, _id, action, n_bytes, value``.

    A request ends with the action that fills it, so it has at most ``max_actions`` actions and at most ``max_bytes`` bytes
    before its last one. Actions are dealt to ``lanes`` by their id, and each lane is cut by running sums; lanes are
    sent side by side, so choose their number by the batch. An action counts with its line ends.
    """
    lane = F.conv(F.substring(F.md5("_id"), 1, 4), 16, 10).cast("int") % lanes
    rows = _lines(actions).withColumns({"lane": lane, "n_bytes": F.octet_length("value") + 1})
    order = Window.partitionBy("_index", "lane").orderBy("_id")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    full = rows.withColumns({
        "by_count": F.floor((F.row_number().over(order) - 1) / max_actions),
        "by_bytes": F.floor(F.coalesce(F.sum("n_bytes").over(before), F.lit(0)) / max_bytes)})
    # Both grow along a lane: a request is a pair of them.
    request = F.dense_rank().over(Window.partitionBy("_index", "lane").orderBy("by_count", "by_bytes"))
    return full.withColumn("request", request).select("_index", "lane", "request", "_id", "action", "n_bytes", "value")


def requests(actions: DataFrame, max_actions: int = FLUSH_ACTIONS, max_bytes: int = FLUSH_BYTES, lanes: int = 64) -> DataFrame:
    """The bodies to send: ``_index, lane, request, n_actions, n_bytes, body``, one row each. See :func:`flushes`."""
    parts = flushes(actions, max_actions, max_bytes, lanes).groupBy("_index", "lane", "request").agg(
        F.count("*").alias("n_actions"), F.sum("n_bytes").alias("n_bytes"),
        F.array_sort(F.collect_list(F.struct("_id", "value"))).alias("lines"))
    return parts.select("_index", "lane", "request", "n_actions", "n_bytes",
                        F.concat(F.array_join("lines.value", "\n"), F.lit("\n")).alias("body"))


def write_requests(actions: DataFrame, path: str, batch_id: int, max_actions: int = FLUSH_ACTIONS, max_bytes: int = FLUSH_BYTES,
                   lanes: int = 64) -> None:
    """Write a batch as request bodies, ready to be sent one by one; a replay replaces the batch's own folder."""
    requests(actions, max_actions, max_bytes, lanes).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_bulk(actions: DataFrame, path: str, batch_id: int, actions_per_file: int = 100_000) -> None:
    """Write a batch's requests as text files; a replay replaces the batch's own folder."""
    lines = bulk_lines(actions)
    lines.write.mode("overwrite").option("maxRecordsPerFile", actions_per_file).text(f"{path}/batch_id={batch_id}")


def by_operation(actions: DataFrame, fields: list[str], scratch: str) -> list[tuple[DataFrame, str]]:
    """A batch's rows per operation. The actions are computed once: written to ``scratch`` and read back."""
    actions.write.mode("overwrite").parquet(scratch)
    kept = actions.sparkSession.read.schema(actions.schema).parquet(scratch)
    doc = F.from_json("doc", table_schema(fields)).alias("doc")
    indexed = kept.where(F.col("action") == "index").select("_id", "version", doc).select("_id", "version", "doc.*")
    deleted = kept.where(F.col("action") == "delete").select("_id", "version")
    return [(indexed, "index"), (deleted, "delete")]


def write_service(actions: DataFrame, index: str, fields: list[str], nodes: str, scratch: str,
                  batch_bytes: str = "1mb", batch_entries: int = 1000) -> None:
    """Send a batch through the search service's Spark connector (its jar must be present).

    The connector takes one operation per write, so index and delete actions go apart. ``scratch`` is a
    folder that all executors share; it holds one batch at a time.
    """
    options = {
        "es.nodes": nodes, "es.mapping.id": "_id", "es.mapping.exclude": "_id,version",
        "es.mapping.version": "version", "es.mapping.version.type": "external_gte",
        "es.batch.size.bytes": batch_bytes, "es.batch.size.entries": str(batch_entries),
    }
    for rows, operation in by_operation(actions, fields, scratch):
        rows.write.format("org.elasticsearch.spark.sql").mode("append").options(
            **options, **{"es.write.operation": operation}).save(index)
