"""Reports over lake tables, in ordinary Spark SQL.

Each report first writes the tables it reads, with the library's own sinks, below the
shared folder, and registers them as views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog import schemas
from tidelog.operators import enrich, tables
from tidelog.plans import views
from tidelog.session import fresh_dir
from tidelog.sinks.append import write_append
from tidelog.sinks.catalog import LakeCatalog, create_append_tables, register_partitions
from tidelog.sinks.change_table import ChangeTable, change_schema
from tidelog.sources.lake import register_lake

_BUILDERS = {
    "devices_raw": lambda spark, sf: tables.devices_raw(views.devices(spark, sf)),
    "sensor_readings_raw": lambda spark, sf: tables.readings_raw(views.readings(spark, sf)),
    "devices_readings": lambda spark, sf: tables.enriched_raw(
        enrich.enrich_append(views.devices(spark, sf), views.readings(spark, sf))),
}


def _lake(spark: SparkSession, sf_dir: str, *names: str) -> None:
    root = fresh_dir(spark, "lake")
    for name in names:
        write_append(_BUILDERS[name](spark, sf_dir), f"{root}/{name}")
    register_lake(spark, root, {n: schemas.table_schema(schemas.APPEND_TABLES[n]) for n in names})


PRUNE_SQL = """
SELECT partition_date, device_id, count(*) AS readings, max(sensor_value) AS highest
FROM sensor_readings_raw
WHERE partition_date BETWEEN '2024-01-05' AND '2024-01-07'
GROUP BY partition_date, device_id"""

TOP_SQL = """
SELECT device_id, device_name, count(*) AS readings,
       count(CASE WHEN severity = 'CRITICAL' THEN 1 END) AS critical_readings
FROM devices_readings
GROUP BY device_id, device_name
ORDER BY critical_readings DESC, readings DESC, device_id
LIMIT 10"""

# The ranking keeps one row per device in each input partition before the exchange.
LATEST_SQL = """
SELECT device_id, reading_id, sensor_value, reading_timestamp
FROM (SELECT *, row_number() OVER (PARTITION BY device_id
                                   ORDER BY reading_timestamp DESC, reading_id DESC) AS place
      FROM sensor_readings_raw) AS ranked
WHERE place = 1"""

# Distinct ids first, so that a hot device is one row by the time it is joined.
SILENT_SQL = """
SELECT d.device_id, d.device_name, d.status
FROM devices_raw AS d LEFT ANTI JOIN (SELECT DISTINCT device_id FROM sensor_readings_raw) AS s
  ON d.device_id = s.device_id"""


def lake_partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    _lake(spark, sf_dir, "sensor_readings_raw")
    return spark.sql(PRUNE_SQL)


def lake_top_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    _lake(spark, sf_dir, "devices_readings")
    return spark.sql(TOP_SQL)


def lake_latest_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    _lake(spark, sf_dir, "sensor_readings_raw")
    return spark.sql(LATEST_SQL)


def lake_silent_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    _lake(spark, sf_dir, "devices_raw", "sensor_readings_raw")
    return spark.sql(SILENT_SQL)


def lake_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyed table in three batches, two of them merged; its view is made before the last two come, and shows them.

    The batches interleave, so some changes arrive after newer ones.
    """
    columns, keys = schemas.KEYED_TABLES["iceberg_sensor_readings"]
    table = ChangeTable(spark, fresh_dir(spark, "keyed"), change_schema(schemas.table_schema(columns)), keys,
                        by_day=True)
    arrived = f"{table.path}/arrived"
    tables.readings_by_day(views.reading_changes(spark, sf_dir), views.fixed_now()).write.parquet(arrived)
    changes = spark.read.schema(table.schema).parquet(arrived)
    part = F.col("seq.pos") % 3
    table.write_batch(changes.where(part == 2), 0)
    register_lake(spark, table.path, {}, keyed={"iceberg_sensor_readings": table})
    table.write_batch(changes.where(part == 0), 1)
    table.compact()
    table.write_batch(changes.where(part == 1), 2)
    return spark.sql("SELECT * FROM iceberg_sensor_readings")


def lake_catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Database and tables made in the catalog in use, filled by path, and asked by their names alone."""
    root, before = fresh_dir(spark, "named"), spark.catalog.currentDatabase()
    name = f"iot_db_{root.rsplit('-', 1)[1]}"
    full = LakeCatalog().use(spark, name, f"{root}/database")
    try:
        create_append_tables(spark, root, full)
        write_append(_BUILDERS["sensor_readings_raw"](spark, sf_dir), f"{root}/sensor_readings_raw")
        register_partitions(spark, "sensor_readings_raw")
        return spark.sql(PRUNE_SQL.replace("sensor_readings_raw", f"{full}.sensor_readings_raw"))
    finally:
        spark.catalog.setCurrentDatabase(before)


LAKE_QUERIES = {
    query.__name__: query
    for query in (lake_partition_prune, lake_catalog_tables, lake_current_state, lake_top_devices, lake_latest_reading, lake_silent_devices)
}
