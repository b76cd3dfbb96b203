"""Keyed tables on plain files: a folder per batch of changes, and the newest change per key of older batches.

A keyed table must apply updates and deletes, which Parquet files cannot do in place. Where a table format with MERGE is at
hand use :mod:`tidelog.sinks.merge`. Without one a batch only ever adds its own folder, and reading keeps the newest change per key::

    <path>/batches/batch_id=<n>/…            what batch n brought
    <path>/merged/<day or bucket>/upto=<n>/  newest change per key, of batches up to n
    <path>/_merged/<n>                       which ``upto`` counts for each day or bucket

* Writing a batch again replaces that batch's folder and nothing else, so a replay after
  a lost executor or driver changes nothing.
* A batch is written as it comes, without a shuffle.
* Merging rewrites the days or buckets that the batches since the last merge touch, no others.
* Reading lists the batches since the last merge and reads one small file, however old the table is.
* Merged folders keep deletes, so that a late older change cannot bring a row back.

Tables read by day are laid out by ``partition_date``; tables looked up by key are laid out
by a hash bucket once merged. Either way a reader opens only the folders it asks for.

A checkpoint and the table it fills belong together: starting a new checkpoint on an old
table would number batches from 0 again and replace the old ones.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.changelog import BEFORE_UPDATE, DELETE, latest_changes

SEQ = T.StructType([
    T.StructField("ms", T.LongType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("pos", T.LongType()),
    T.StructField("token", T.StringType()),
    T.StructField("ord", T.IntegerType()),
])


def change_schema(payload: T.StructType, seq: T.StructType = SEQ) -> T.StructType:
    return T.StructType([T.StructField("row_kind", T.StringType()), T.StructField("seq", seq), *payload.fields])


# Success markers are what readers go by, so a write asks for them whatever the cluster's setting.
_MARKED = ("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")


class ChangeTable:
    """A table keyed by ``keys``, laid out by day or by buckets of ``bucket_by``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str],
                 by_day: bool = False, bucket_by: list[str] | None = None, buckets: int = 64):
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, keys
        self.by_day, self.bucket_by, self.buckets = by_day, bucket_by or keys, buckets
        self.part = "partition_date" if by_day else "bucket"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def write_batch(self, changes: DataFrame, batch_id: int) -> None:
        rows = changes.where(F.col("row_kind") != BEFORE_UPDATE).select(*self.schema.fieldNames())
        writer = rows.write.mode("overwrite").option(*_MARKED)
        if self.by_day:
            writer = writer.partitionBy("partition_date")
        writer.parquet(self._batch_folder(batch_id))

    def batch(self, batch_id: int) -> DataFrame:
        """What a batch brought, read back: the batch is not computed a second time."""
        return self.spark.read.schema(self.schema).parquet(self._batch_folder(batch_id)).select(*self.schema.fieldNames())

    def changes(self, buckets: list[int] | None = None, before: int | None = None) -> DataFrame:
        """The newest change per key of merged batches, and all changes of later ones.

        With ``buckets``, only those folders of a bucketed table are read. ``before`` leaves
        out that batch and later ones.
        """
        upto, merged = self._merged()
        wanted = None if buckets is None else [f"bucket={b}" for b in buckets]
        folders = [f"{self.path}/merged/{part}/upto={n}" for part, n in merged.items() if wanted is None or part in wanted]
        later = self._read_batches(self._batches(upto, before))
        if buckets is not None:
            later = later.where(self.bucket().isin(buckets))
        return self._read_merged(folders, buckets).unionByName(later)

    def latest(self, buckets: list[int] | None = None, before: int | None = None) -> DataFrame:
        """Newest change per key, deletes included."""
        return latest_changes(self.changes(buckets, before), self.keys)

    def current(self, buckets: list[int] | None = None) -> DataFrame:
        """The table's rows. A filter on a key column, such as the day, reaches the files."""
        return self.latest(buckets).where(F.col("row_kind") != DELETE).drop("row_kind", "seq")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """Bucket numbers that occur in ``rows``: at most ``buckets`` values."""
        return [r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect()]

    def compact(self, before: int | None = None) -> int | None:
        """Merge the batches since the last merge (``before`` leaves out that one and later ones); returns the last of them, if any.

        What the merge before this one replaced is removed first, so a reader has the time between two merges to end.
        ``rebalance`` cuts a large day or bucket into several files and joins small ones, so a hot one does not become one task.
        """
        upto, merged = self._merged()
        batches = self._batches(upto, before)
        if not batches:
            return None
        self.expire()
        last = batches[-1]
        rows = self._read_batches(batches)
        rows = rows if self.by_day else rows.withColumn("bucket", self.bucket())
        # As many values as the batches have days, or as there are buckets.
        touched = [r[0] for r in rows.select(self.part).distinct().collect()]
        old = self._read_merged([f"{self.path}/merged/{self.part}={v}/upto={merged[f'{self.part}={v}']}" for v in touched
                                 if f"{self.part}={v}" in merged], None if self.by_day else touched)
        old = old if self.by_day else old.withColumn("bucket", self.bucket())
        rest = [] if self.by_day else ["bucket"]
        newest = latest_changes(rows.unionByName(old), [*self.keys, *rest]).withColumn("upto", F.lit(last))
        order = dict.fromkeys([self.part, *([] if self.by_day else self.bucket_by), *self.keys])
        newest.hint("rebalance", self.part).sortWithinPartitions(*order).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(self.part, "upto").parquet(f"{self.path}/merged")
        self._publish(last, {**merged, **{f"{self.part}={v}": last for v in touched}})
        return last

    def expire(self) -> None:
        """Remove what the last merge has replaced."""
        upto, merged = self._merged()
        if upto < 0:
            return
        for n in [n for n in self._numbers("batches", "batch_id=") if n <= upto]:
            self._remove(self._batch_folder(n))
        replaced = [n for n in self._numbers("_merged") if n < upto]
        for n in replaced:
            for part, was in self._manifest(n).items():
                if merged.get(part) != was:
                    self._remove(f"{self.path}/merged/{part}/upto={was}")
        for n in replaced:
            self._remove(f"{self.path}/_merged/{n}")

    def create_view(self, name: str) -> None:
        """A view whose text names the table's folders: whoever asks it sees the batches that are there at that moment.

        It reads what is merged and what is not, replaced folders too until they are removed; the newest change per key decides. A
        batch that is being committed may show in part; :meth:`current` waits for its end.
        """
        for folder in ("batches", "merged"):
            if not self._exists(f"{self.path}/{folder}"):  # an empty file tells the schema
                self.spark.createDataFrame([], self.schema).write.mode("append").parquet(f"{self.path}/{folder}")
        columns = [f"`{c}`" for c in self.schema.fieldNames()]
        keys = [f"`{k}`" for k in self.keys]
        body = ", ".join(columns)
        shown = ", ".join(c if c in keys else f"newest.{c}" for c in columns if c not in ("`row_kind`", "`seq`"))
        sources = " UNION ALL ".join(f"SELECT {body} FROM parquet.`{self.path}/{folder}`" for folder in ("batches", "merged"))
        self.spark.sql(
            f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {shown} FROM (SELECT {', '.join(keys)}, max(struct(seq, {body})) AS newest "
            f"FROM ({sources}) GROUP BY {', '.join(keys)}) WHERE newest.row_kind <> '{DELETE}'")

    def _read_batches(self, batches: list[int]) -> DataFrame:
        if not batches:
            return self._nothing()
        reader = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/batches")
        return reader.parquet(*map(self._batch_folder, batches)).select(*self.schema.fieldNames())

    def _read_merged(self, folders: list[str], buckets: list[int] | None) -> DataFrame:
        if not folders:
            return self._nothing()
        schema = self.schema if self.by_day else T.StructType([*self.schema.fields, T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/merged").parquet(*folders)
        return (rows if buckets is None else rows.where(F.col("bucket").isin(buckets))).select(*self.schema.fieldNames())

    def _nothing(self) -> DataFrame:
        """No rows, in a form that the optimizer drops from a union; a list's rows would be asked of Python, task by task."""
        return self.spark.range(1).where(F.lit(False)).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema])

    def _batch_folder(self, batch_id: int) -> str:
        return f"{self.path}/batches/batch_id={batch_id}"

    def _batches(self, upto: int, before: int | None) -> list[int]:
        """Complete batches after ``upto``, in order, from one listing. Only the last may be unfinished: it is being written."""
        numbers = sorted(n for n in self._numbers("batches", "batch_id=") if n > upto)
        if numbers and not self._exists(f"{self._batch_folder(numbers[-1])}/_SUCCESS"):
            numbers.pop()
        return [n for n in numbers if before is None or n < before]

    def _merged(self) -> tuple[int, dict[str, int]]:
        """The last merged batch (-1: none) and the ``upto`` that counts, by day or bucket."""
        upto = max(self._numbers("_merged"), default=-1)
        return upto, self._manifest(upto) if upto >= 0 else {}

    def _manifest(self, upto: int) -> dict[str, int]:
        return json.loads(self.spark.read.text(f"{self.path}/_merged/{upto}", wholetext=True).first()[0])

    def _publish(self, upto: int, merged: dict[str, int]) -> None:
        """Make a merge count: its list is written aside and renamed, so it is there as a whole or not at all."""
        fs, aside = self._file_system(f"{self.path}/_merging")
        out = fs.create(aside, True)
        out.write(bytearray(json.dumps(merged).encode()))
        out.close()
        _, target = self._file_system(f"{self.path}/_merged/{upto}")
        fs.mkdirs(target.getParent())
        fs.rename(aside, target)

    def _file_system(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path

    def _exists(self, path: str) -> bool:
        fs, where = self._file_system(path)
        return fs.exists(where)

    def _numbers(self, folder: str, prefix: str = "") -> list[int]:
        """The numbers in the names below a folder, from one listing."""
        fs, where = self._file_system(f"{self.path}/{folder}")
        if not fs.exists(where):
            return []
        names = [status.getPath().getName().removeprefix(prefix) for status in fs.listStatus(where)]
        return [int(n) for n in names if n.isdigit()]

    def _remove(self, folder: str) -> None:
        fs, path = self._file_system(folder)
        fs.delete(path, True)
