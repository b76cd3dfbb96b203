"""Databases and tables in the session catalog (or any catalog configured for Spark)."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidelog.schemas import APPEND_TABLES, table_schema


# Plug-in classes of the table formats, and the SQL extensions they come with.
_PLUGINS = {
    "iceberg": ("org.apache.iceberg.spark.SparkCatalog", "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"),
    "delta": ("org.apache.spark.sql.delta.catalog.DeltaCatalog", "io.delta.sql.DeltaSparkSessionExtension"),
}
#: The catalog every session has.
SESSION_CATALOG = "spark_catalog"


@dataclass(frozen=True)
class LakeCatalog:
    """Where the lake's tables have their names: a format's catalog plug-in (its jar must be present), or the session's own.

    ``settings`` are the plug-in's, such as ``type="hive"``, ``uri`` and ``warehouse``. Give the catalogs to ``build_session``; then
    :meth:`use` makes one current, and table names without a catalog are looked up there.
    """

    name: str = SESSION_CATALOG
    fmt: str | None = None
    settings: dict[str, str] = field(default_factory=dict)

    def conf(self) -> dict[str, str]:
        """Settings of a session that has this catalog."""
        if self.fmt is None:
            if self.name != SESSION_CATALOG or self.settings:
                raise ValueError("only the session's own catalog needs no format, and it takes no settings")
            return {}
        plugin, extension = _PLUGINS[self.fmt]
        own = {f"spark.sql.catalog.{self.name}.{key}": value for key, value in self.settings.items()}
        return {f"spark.sql.catalog.{self.name}": plugin, "spark.sql.extensions": extension, **own}

    def use(self, spark: SparkSession, database: str = "iot_db", location: str | None = None) -> str:
        """Create the database if it is not there and make it current; returns its full name."""
        full = f"{self.name}.{database}"
        create_database(spark, full, location)
        spark.catalog.setCurrentCatalog(self.name)
        spark.catalog.setCurrentDatabase(database)
        return full


def merged_conf(catalogs: Collection[LakeCatalog]) -> dict[str, str]:
    """The settings of several catalogs in one session; SQL extensions add up."""
    conf: dict[str, str] = {}
    for catalog in catalogs:
        for key, value in catalog.conf().items():
            known = conf.get(key, "").split(",") if key == "spark.sql.extensions" else []
            conf[key] = ",".join(dict.fromkeys([*filter(None, known), value]))
    return conf


def create_database(spark: SparkSession, name: str = "iot_db", location: str | None = None) -> None:
    """Without a location its tables lie in the catalog's warehouse."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def create_table_sql(table: str, columns: list[str], path: str, fmt: str = "parquet") -> str:
    """DDL of a day-partitioned table at a given place."""
    body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table_schema(columns))
    return (f"CREATE TABLE IF NOT EXISTS {table} ({body}) USING {fmt} "
            f"PARTITIONED BY (partition_date) LOCATION '{path}'")


def create_append_tables(spark: SparkSession, root: str, database: str = "iot_db",
                         fmt: str = "parquet") -> list[str]:
    """Create the append tables; harmless when they exist. Returns their full names."""
    create_database(spark, database)
    names = []
    for name, columns in APPEND_TABLES.items():
        spark.sql(create_table_sql(f"{database}.{name}", columns, f"{root.rstrip('/')}/{name}", fmt))
        names.append(f"{database}.{name}")
    return names


def create_keyed_table_sql(table: str, columns: list[str], seq: T.StructType, fmt: str) -> str:
    """DDL of a keyed table that takes changes by MERGE: its columns and each row's place in the log."""
    fields = [T.StructField("seq", seq), *table_schema(columns)]
    body = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return f"CREATE TABLE IF NOT EXISTS {table} ({body}) USING {fmt} PARTITIONED BY (partition_date)"


def register_partitions(spark: SparkSession, table: str) -> None:
    """Let the catalog learn about day folders that were written by path.

    A folder written by a stream needs none of this: its own commit log lists its files,
    and the table is then not partitioned as far as the catalog is concerned.
    """
    if any(column.isPartition for column in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)
