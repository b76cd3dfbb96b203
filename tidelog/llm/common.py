"""What the operators share: tables, stored intermediate results, words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import fresh_dir

#: A word: a maximal run of bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark then deletes a query's shuffle files when it ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends here, it is computed
    once, and a lost executor costs no recomputation. Its shuffle files go with the write."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def doc_key(doc_id: Column, text: Column) -> Column:
    """A document's id; documents without one get a negative number made from their text."""
    return F.coalesce(
        doc_id.cast("long"), -1 - F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit((1 << 62) - 1)))
