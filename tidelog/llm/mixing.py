"""Mixing sources to target weights along a time-varying curriculum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import doc_key, stored, word_count

#: Weights by the source's place in code point order, and each one's share at the start and the end of training.
WEIGHTS = (1, 2, 3)
SCHEDULES = ((3, 1), (2, 2), (1, 3))


def source_targets(sizes: DataFrame, epochs: int = 3, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sizes(source, source_size)``, one row per source, plus ``place`` and ``target``.

    All sizes are shared out by weight; a target stops at ``epochs`` times its source, the excess
    goes to the others by weight. Sources ordered by (cap / weight) are full up to a point, so the
    common level follows from prefix sums. One row per source is all that meets in one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    fill = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    level = F.when(
        (F.col("total") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before")) <= F.col("ratio"),
        (F.col("total") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before")))
    return (
        sizes.withColumn("place", F.row_number().over(order) - 1)
        .withColumn("weight", weight.cast("long"))
        .withColumn("cap", epochs * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("cap_before", F.sum("cap").over(fill) - F.col("cap"))
        .withColumn("weight_before", F.sum("weight").over(fill) - F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("level", F.min_by(level, F.when(level.isNotNull(), F.struct("ratio", "place"))).over(everything))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")))
        .select("source", "source_size", "place", "target"))


def _time(done: Column, start: Column, end: Column) -> Column:
    """When a weight running evenly from ``start`` to ``end`` has brought the share ``done`` of its integral."""
    return F.when(start == end, done).otherwise(
        (F.sqrt(start * start + (end - start) * (end + start) * done) - start) / (end - start) + F.lit(0.0))


def row_names() -> tuple[Column, Column]:
    """``doc_key`` and ``row_hash`` of a document: equal for rows with the same id, text and source only."""
    text, source = F.coalesce(F.col("text"), F.lit("")), F.col("source")
    return (doc_key(F.col("doc_id"), F.col("text")).alias("doc_key"),
            F.xxhash64(text, source.isNull(), F.coalesce(source, F.lit("")), F.col("doc_id").isNull()).alias("row_hash"))


def curriculum_mix(docs: DataFrame, epochs: int = 3, weights: tuple[int, ...] = WEIGHTS,
                   schedules: tuple[tuple[int, int], ...] = SCHEDULES, digits: int = 3) -> DataFrame:
    """Where in training each document is read: ``doc_id, source, size, source_size, target, placements, doc_key, row_hash``.

    Within a source documents follow the MD5 of their id, epoch after epoch, until the source's target is used up;
    the last document may be read in part. A placement is (epoch, taken words, position in [0, 1)): the
    time at which the source's integrated weight schedule demands the document's first word.

    Running sums are taken in two levels, 16^``digits`` hash ranges per source and the rows of a range, so a
    source that owns a third of all rows is spread over all tasks.

    A null or empty text has size 0 and no placement, and so have all documents of a source without words. A null source is a source of its own, the last.
    Repeated rows count each. Documents without id are ordered by their text. An empty table gives no rows. ``doc_key`` and ``row_hash``
    (see ``row_names``) tell which row of ``docs`` is meant, also without id.
    """
    slim = stored(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                    F.md5(F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))).alias("key"), *row_names()),
        "sizes").withColumn("bucket", F.substring("key", 1, digits))
    buckets = slim.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    targets = source_targets(buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), epochs, weights)
    before = Window.partitionBy("source").orderBy("bucket")
    buckets = buckets.withColumn("offset", F.sum("bucket_size").over(before) - F.col("bucket_size"))
    shape = F.element_at(F.array(*[F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")) for a, b in schedules]),
                         (F.col("place") % len(schedules) + 1).cast("int"))
    plan = buckets.join(targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("source").alias("s"), F.col("bucket").alias("b"), "offset", "source_size", "target", shape.alias("shape"))
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size", "row_hash").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    placed = (
        slim.withColumn("inside", F.sum("size").over(within) - F.col("size"))
        .join(plan, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .withColumn("start", F.col("offset") + F.col("inside"))
        .withColumn("budget", F.floor("target")))

    def placement(epoch: Column) -> Column:
        first = epoch * F.col("source_size") + F.col("start")
        taken = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - first))
        return F.struct(epoch.alias("epoch"), taken.alias("taken"),
                        _time(F.try_divide(first, F.col("target")), F.col("shape.a"), F.col("shape.b")).alias("position"))

    every = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(epochs - 1).cast("long")), placement)
    return placed.select("doc_id", "source", "size", "source_size", "target",
                         F.when(F.col("target") > 0, F.filter(every, lambda p: p["taken"] > 0))
                         .otherwise(F.filter(every, lambda p: F.lit(False))).alias("placements"), "doc_key", "row_hash")


def read_by_mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the mix reads, one row each, range-sorted by the position they are first read at: all their columns, the words
    ``taken``, the ``first_position`` and all ``placements`` (see ``curriculum_mix``), since a row may be read once per epoch."""
    mixed = stored(curriculum_mix(docs).select(
        F.col("doc_key").alias("__key"), F.col("row_hash").alias("__row"),
        F.aggregate("placements", F.lit(0).cast("long"), lambda n, p: n + p["taken"]).alias("taken"),
        F.get("placements", F.lit(0))["position"].alias("first_position"), "placements"), "mix")
    named = docs.select("*", *[c.alias(n) for c, n in zip(row_names(), ("__key", "__row"))])
    repeated = stored(mixed.groupBy("__key", "__row").count().where("count > 1").select("__key", "__row"), "repeated")
    ids = ["__key", "__row"]
    out = named.join(mixed.where("taken > 0").join(repeated, ids, "left_anti"), ids)
    if not repeated.isEmpty():
        # Repeated rows are alike to the mix: any numbering gives each its own placement.
        numbered = [
            rows.join(repeated, ids, "left_semi").withColumn("__n", F.row_number().over(Window.partitionBy(*ids).orderBy(F.col(by).asc_nulls_last())))
            for rows, by in ((named, "__row"), (mixed, "first_position"))]
        out = out.unionByName(numbered[0].join(numbered[1].where("taken > 0"), [*ids, "__n"]).drop("__n"))
    return out.drop(*ids).orderBy("first_position", "doc_id")


def by_position(mixed: DataFrame) -> DataFrame:
    """One row per document, range-sorted by its first position; documents that are not read come last."""
    return mixed.select(
        "doc_id", "size", "source_size", "target",
        F.aggregate("placements", F.lit(0).cast("long"), lambda n, p: n + p["taken"]).alias("taken"),
        F.get("placements", F.lit(0))["position"].alias("first_position"),
    ).orderBy(F.col("first_position").asc_nulls_last(), "doc_id")


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per reading of a document, range-sorted by training position."""
    return mixed.select("doc_id", "source", F.explode("placements").alias("p")).select(
        "doc_id", "source", "p.epoch", "p.taken", "p.position").orderBy("position", "source", "doc_id")


#: Rows of ``by_position(curriculum_mix(documents))``; ``{docs}`` is the input.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), text, '')) AS key
  FROM {docs}),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM d GROUP BY source),
c AS (SELECT *, place % 3 + 1 AS weight, 3 * source_size AS cap, (3 * source_size) / (place % 3 + 1) AS ratio FROM s),
f AS (
  SELECT *, sum(cap) OVER o - cap AS cap_before, sum(weight) OVER o - weight AS weight_before,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight
  FROM c WINDOW o AS (ORDER BY ratio, place ROWS UNBOUNDED PRECEDING)),
l AS (
  SELECT CAST(total - cap_before AS DOUBLE) / CAST(all_weight - weight_before AS DOUBLE) AS level
  FROM f WHERE CAST(total - cap_before AS DOUBLE) / CAST(all_weight - weight_before AS DOUBLE) <= ratio
  ORDER BY ratio, place LIMIT 1),
t AS (
  SELECT source AS s, source_size, least(CAST(cap AS DOUBLE), level * CAST(weight AS DOUBLE)) AS target,
         CAST(3 - place % 3 AS DOUBLE) AS a, CAST(1 + place % 3 AS DOUBLE) AS b
  FROM f, l),
p AS (
  SELECT doc_id, source, size,
         CAST(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS start
  FROM d),
e AS (
  SELECT *, CAST(floor(target) AS BIGINT) AS budget, CAST(start AS DOUBLE) / target AS done
  FROM p JOIN t ON source IS NOT DISTINCT FROM s)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(greatest(0, least(size, budget - start)) + greatest(0, least(size, budget - source_size - start))
            + greatest(0, least(size, budget - 2 * source_size - start)) AS BIGINT) AS taken,
       CASE WHEN greatest(0, least(size, budget - start)) > 0 THEN
         CASE WHEN a = b THEN done ELSE (sqrt(a * a + (b - a) * (b + a) * done) - a) / (b - a) + CAST(0 AS DOUBLE) END END AS first_position
FROM e
"""
