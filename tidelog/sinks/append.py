"""Append tables, partitioned by day."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from tidelog.schemas import table_schema


def write_append(df: DataFrame, path: str, fmt: str = "parquet", rebalance: bool = False) -> None:
    """Append a batch; each task writes the days it holds.

    Change logs arrive roughly in time order, so a task holds few days. Where it holds many,
    ``rebalance`` brings the rows of a day together first; a large day still becomes several
    files, and small days share a task.
    """
    rows = df.hint("rebalance", "partition_date") if rebalance else df
    rows.write.format(fmt).mode("append").partitionBy("partition_date").save(path)


def append_stream(df: DataFrame, path: str, fmt: str = "parquet") -> DataStreamWriter:
    """Append a stream. The file sink records its commits, so each row appears once."""
    return df.writeStream.format(fmt).outputMode("append").partitionBy("partition_date").option("path", path)


def numbered_batch_writer(path: str, shape: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each batch to a folder of its own number.

    A batch that runs again replaces its own folder, so nothing is lost or doubled.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.mode("overwrite").partitionBy("partition_date").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_numbered(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Read what :func:`numbered_batch_writer` wrote."""
    return spark.read.schema(table_schema(columns)).parquet(path).select(*columns)
