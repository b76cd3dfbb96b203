"""Keyed tables of a format that supports MERGE (its jar and catalog must be present)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidelog.operators.changelog import latest_changes


def merge_sql(table: str, source: str, columns: list[str], keys: list[str]) -> str:
    """Apply one batch: the newest change per key deletes, replaces or adds its row.

    The table keeps each row's ``seq``, and a change older than the row it meets does nothing. A repeated
    batch meets its own ``seq`` and changes nothing. A deleted row leaves no ``seq`` behind, so the batches of
    one log must come in the log's order, as a checkpoint hands them out.
    """
    match = " AND ".join(f"t.`{k}` <=> s.`{k}`" for k in keys)
    columns = ["seq", *columns]
    names = ", ".join(f"`{c}`" for c in columns)
    newer = "coalesce(s.seq >= t.seq, true)"
    return (
        f"MERGE INTO {table} AS t USING {source} AS s ON {match} "
        f"WHEN MATCHED AND {newer} AND s.row_kind = '-D' THEN DELETE "
        f"WHEN MATCHED AND {newer} THEN UPDATE SET {', '.join(f't.`{c}` = s.`{c}`' for c in columns)} "
        f"WHEN NOT MATCHED AND s.row_kind <> '-D' THEN INSERT ({names}) "
        f"VALUES ({', '.join(f's.`{c}`' for c in columns)})"
    )


def merge_batch(changes: DataFrame, table: str, columns: list[str], keys: list[str]) -> None:
    """MERGE a batch of changes into a catalog table made by ``create_keyed_tables``."""
    source = f"changes_of_{table.replace('.', '_')}"
    latest_changes(changes, keys).createOrReplaceTempView(source)
    changes.sparkSession.sql(merge_sql(table, source, columns, keys))
