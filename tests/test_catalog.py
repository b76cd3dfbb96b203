"""Catalogs: their settings, and names looked up through the one in use."""

from __future__ import annotations

import pytest
from fixtures import SF

from tidelog import schemas
from tidelog.operators import tables
from tidelog.plans import views
from tidelog.sinks.append import write_append
from tidelog.sinks.catalog import SESSION_CATALOG, LakeCatalog, create_append_tables, merged_conf, register_partitions
from tidelog.streaming.upsert_lake import create_keyed_tables


def test_settings_of_plugged_in_catalogs():
    ice = LakeCatalog("ice", "iceberg", {"type": "hive", "uri": "thrift://metastore:9083", "warehouse": "s3a://lake"})
    delta = LakeCatalog("delta", "delta")
    conf = merged_conf([ice, delta, LakeCatalog()])
    assert conf["spark.sql.catalog.ice"].endswith("SparkCatalog") and conf["spark.sql.catalog.delta"].endswith("DeltaCatalog")
    assert conf["spark.sql.catalog.ice.uri"] == "thrift://metastore:9083" and conf["spark.sql.catalog.ice.type"] == "hive"
    assert len(conf["spark.sql.extensions"].split(",")) == 2
    assert merged_conf([ice, ice]) == ice.conf() and LakeCatalog().conf() == {}
    for wrong in (LakeCatalog("other"), LakeCatalog(settings={"a": "b"})):
        with pytest.raises(ValueError):
            wrong.conf()


def test_a_session_gets_its_catalogs(spark):
    from tidelog.session import build_session

    session = build_session(catalogs=[LakeCatalog("ice", "iceberg", {"type": "hadoop", "warehouse": "/tmp/nowhere"})])
    assert session.conf.get("spark.sql.catalog.ice.type") == "hadoop"
    for name in ("", ".type", ".warehouse"):
        session.conf.unset(f"spark.sql.catalog.ice{name}")


def test_names_are_looked_up_in_the_catalog_in_use(spark, tmp_path):
    before = spark.catalog.currentDatabase()
    try:
        full = LakeCatalog().use(spark, "named_db")
        assert full == f"{SESSION_CATALOG}.named_db"
        assert (spark.catalog.currentCatalog(), spark.catalog.currentDatabase()) == (SESSION_CATALOG, "named_db")
        assert SESSION_CATALOG in {c.name for c in spark.catalog.listCatalogs()} and "named_db" in {d.name for d in spark.catalog.listDatabases()}
        root = str(tmp_path / "lake")
        names = create_append_tables(spark, root, full)
        assert names == [f"{full}.{n}" for n in schemas.APPEND_TABLES]
        write_append(tables.readings_raw(views.readings(spark, SF)), f"{root}/sensor_readings_raw")
        register_partitions(spark, f"{full}.sensor_readings_raw")
        # By its own name, by database and with its catalog it is the same table.
        counts = {spark.table(n).count() for n in ("sensor_readings_raw", "named_db.sensor_readings_raw", f"{full}.sensor_readings_raw")}
        assert counts == {views.readings(spark, SF).count()}
        assert {t.name for t in spark.catalog.listTables()} >= set(schemas.APPEND_TABLES)
        keyed = create_keyed_tables(spark, full, fmt="parquet")
        assert [n.rsplit(".", 1)[1] for n in keyed] == list(schemas.KEYED_TABLES) and all(spark.catalog.tableExists(n) for n in keyed)
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql("DROP DATABASE IF EXISTS named_db CASCADE")
