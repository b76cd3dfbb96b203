"""Tables at rest, opened for ordinary Spark SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidelog.sinks.change_table import ChangeTable


def open_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Open a table directory. With a schema nothing is inferred or sampled."""
    reader = spark.read.format(fmt)
    if schema is not None and fmt == "parquet":
        reader = reader.schema(schema)
    return reader.load(path)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a batch write to ``path`` has ended."""
    return _exists(spark, f"{path}/_SUCCESS")


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def open_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table directory that another job may not have begun yet: absent means no rows."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return open_table(spark, path, schema)


def register_lake(spark: SparkSession, root: str, tables: dict[str, T.StructType | None],
                  fmt: str = "parquet", keyed: dict[str, ChangeTable] | None = None) -> list[str]:
    """Make lake tables visible to ``spark.sql`` as views; returns their names.

    ``tables`` maps directory names under ``root`` to schemas; a Parquet directory that nobody has begun yet is one without
    rows. ``keyed`` adds views over the current state of keyed tables. A view is SQL text that names folders, not a captured plan, so
    each query finds what is there when it runs.
    """
    names = []
    for name, schema in tables.items():
        path = f"{root.rstrip('/')}/{name}"
        if schema is not None and fmt == "parquet" and not _exists(spark, path):
            spark.createDataFrame([], schema).write.mode("append").parquet(path)
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {'*' if schema is None else _columns(schema)} FROM {fmt}.`{path}`")
        names.append(name)
    for name, table in (keyed or {}).items():
        table.create_view(name)
        names.append(name)
    return names


def _columns(schema: T.StructType) -> str:
    """Declared names and types; folder names are text until they are cast."""
    return ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
