"""Places and running values within groups, spread over tasks whatever the size of a group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import stored


def _running(group: str, xors: list[str]):
    """Per partition of sorted rows: the partition, the row in it, and place and running XORs within the group so far."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, row, last, place, carried = TaskContext.get().partitionId(), 0, None, 0, [0] * len(xors)
        for batch in batches:
            n = len(batch)
            if not n:
                continue
            keys = batch[group].to_numpy()
            starts = np.r_[keys[0] != last, keys[1:] != keys[:-1]]
            at = np.arange(n)
            begun = np.maximum.accumulate(np.where(starts, at, -1))
            out = batch.copy()
            out["__part"], out["__row"] = part, row + at
            out["place"] = np.where(begun >= 0, at - begun, at + place)
            for i, name in enumerate(xors):
                total = np.bitwise_xor.accumulate(batch[name].to_numpy(dtype="int64"))
                before = np.where(begun > 0, total[np.maximum(begun - 1, 0)], 0)
                out[name] = total ^ np.where(begun >= 0, before, carried[i])
                carried[i] = int(out[name].iloc[-1])
            place, last, row = int(out["place"].iloc[-1]) + 1, keys[-1], row + n
            yield out

    return run


def partition_ends(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per partition: ``__part``, its number of rows, and ``columns`` of its first and last row."""
    of = F.struct(*columns)
    return rows.groupBy("__part").agg(
        F.count("*").alias("rows"), F.min_by(of, "__row").alias("head"), F.max_by(of, "__row").alias("tail"))


def placed(rows: DataFrame, group: str, order: list[Column], label: str, xors: tuple[str, ...] = (), drop: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with ``place``, the row's 0-based place in its group by ``order``; the columns ``xors`` become running XORs.

    Rows are range-sorted by (group, order) and numbered within each partition. A group that goes on over several
    partitions is then shifted by what came before; that takes one row per partition. So a group that holds a third of
    all rows is a third of all tasks. ``group`` is not null; ``drop`` names columns that only the order needs.
    """
    ordered = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order).drop(*drop)
    schema = T.StructType([*ordered.schema, T.StructField("__part", T.LongType()), T.StructField("__row", T.LongType()),
                           T.StructField("place", T.LongType())])
    numbered = stored(ordered.mapInPandas(_running(group, list(xors)), schema), label)
    ends = partition_ends(numbered, group, "place", *xors)
    nothing = [F.lit(0).cast("long").alias(c) for c in ("n", *xors)]
    pieces = ends.select("__part", F.col(f"head.{group}").alias(group), F.lit(True).alias("head"), *nothing).unionByName(
        ends.select("__part", F.col(f"tail.{group}").alias(group), F.lit(False).alias("head"),
                    (F.col("tail.place") + 1).alias("n"), *[F.col(f"tail.{c}").alias(c) for c in xors]))
    before = Window.partitionBy(group).orderBy("__part").rangeBetween(Window.unboundedPreceding, -1)
    shifts = pieces.select(
        "__part", group, "head", F.sum("n").over(before).alias("__n"),
        *[F.bit_xor(c).over(before).alias(f"__{c}") for c in xors]).where("head AND __n IS NOT NULL").drop("head")
    shifts = stored(shifts, f"{label}-shifts")
    out = numbered.join(shifts, ["__part", group], "left")
    zero = F.lit(0).cast("long")
    changed = {"place": F.col("place") + F.coalesce("__n", zero),
               **{c: F.col(c).bitwiseXOR(F.coalesce(f"__{c}", zero)) for c in xors}}
    return out.withColumns(changed).select(*ordered.columns, "place")
