"""Chat formatting: logged snapshots collapse into the conversations they grew into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored


def _turn_hash(seed: int) -> Column:
    """Of a turn and its place, so that the exclusive or over a prefix depends on the order."""
    return F.xxhash64(F.lit(seed), "rank", F.col("role").isNull(), F.coalesce("role", F.lit("")),
                      F.col("text").isNull(), F.coalesce("text", F.lit("")))


def ranked_turns(turns: DataFrame, piece_turns: int = 256) -> DataFrame:
    """Turns with their ``rank`` in the conversation (by turn, role, text; nulls first) and the rolling hashes ``p1, p2``
    of the prefix that ends there.

    All turns are range-sorted, equal ones told apart by a number, so a conversation that owns a third of all rows fills a third of
    the partitions, whatever its turn numbers. What it has in one partition is a piece; ranks add up over pieces, and rolling hashes over
    pieces of ``piece_turns`` ranks."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "tie")]
    base = turns.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("tie"))
    base = stored(base.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv_id", "role", "text", F.spark_partition_id().alias("piece"), F.monotonically_increasing_id().alias("row")), "sorted-turns")
    inside = Window.partitionBy("conv_id", "piece").orderBy("row")
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = base.groupBy("conv_id", "piece").count().select(
        F.col("conv_id").alias("c"), F.col("piece").alias("q"),
        F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("offset"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("piece") == F.col("q"))
    ranked = base.withColumn("rn", F.row_number().over(inside)).join(pieces, same).select(
        "conv_id", "role", "text", (F.col("offset") + F.col("rn")).alias("rank"))
    ranked = stored(
        ranked.withColumns({"h1": _turn_hash(1), "h2": _turn_hash(2)}).withColumn(
            "piece", F.floor((F.col("rank") - 1) / piece_turns)), "turns")
    rolling = Window.partitionBy("conv_id", "piece").orderBy("rank").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    xors = ranked.groupBy("conv_id", "piece").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2")).select(
        F.col("conv_id").alias("c"), F.col("piece").alias("q"),
        F.coalesce(F.bit_xor("x1").over(earlier), F.lit(0)).alias("o1"),
        F.coalesce(F.bit_xor("x2").over(earlier), F.lit(0)).alias("o2"))
    return (
        ranked.withColumns({"r1": F.bit_xor("h1").over(rolling), "r2": F.bit_xor("h2").over(rolling)})
        .join(xors, same)
        .select("conv_id", "rank", "piece", "role", "text", F.col("r1").bitwiseXOR(F.col("o1")).alias("p1"),
                F.col("r2").bitwiseXOR(F.col("o2")).alias("p2")))


def render(role: Column, text: Column) -> Column:
    """One turn between markers. A marker inside a role or text is broken up, so turns can't be forged."""
    def plain(value: Column) -> Column:
        return F.replace(F.coalesce(value, F.lit("")), F.lit("<|"), F.lit("<\\|"))
    return F.concat(F.lit("<|start|>"), plain(role), F.lit("\n"), plain(text), F.lit("<|end|>\n"))


def format_conversations(turns: DataFrame, piece_turns: int = 256) -> DataFrame:
    """Maximal conversations, rendered: ``conv_id, n_turns, n_copies, part, text``.

    A conversation whose turns begin a longer one is a snapshot of that and goes; of equal ones the
    smallest id stays and ``n_copies`` counts them. The text comes in parts of ``piece_turns`` turns (part 0, 1, …), whose
    concatenation is the conversation; no task holds more of one.

    Rows with a null conv_id form one conversation with a null id. Null turn numbers come first; equal
    ones are ordered by role, then text; repeated rows are turns of their own. A null role or text
    differs from an empty one when conversations are compared, and renders as empty. An empty table gives no rows.
    """
    ranked = stored(ranked_turns(turns, piece_turns), "prefixes")
    whole = ranked.groupBy("conv_id").agg(F.max("rank").alias("n_turns"), F.max_by(F.struct("p1", "p2"), "rank").alias("p"))
    whole = stored(whole.select("conv_id", "n_turns", "p.p1", "p.p2"), "whole")
    classes = whole.groupBy("n_turns", "p1", "p2").agg(F.min("conv_id").alias("keep"), F.count("*").alias("n_copies"))
    mine = F.col("conv_id").eqNullSafe(F.col("c"))
    proper = (
        ranked.select("conv_id", "rank", "p1", "p2")
        .join(whole.select(F.col("conv_id").alias("c"), "n_turns"), mine).where("rank < n_turns")
        .select(F.col("rank").alias("n_turns"), "p1", "p2").distinct())
    kept = classes.join(proper, ["n_turns", "p1", "p2"], "left_anti").select(F.col("keep").alias("c"), "n_turns", "n_copies")
    pieces = ranked.join(kept, mine).groupBy("conv_id", "n_turns", "n_copies", "piece").agg(
        F.array_sort(F.collect_list(F.struct("rank", render(F.col("role"), F.col("text")).alias("turn")))).alias("turns"))
    return pieces.select("conv_id", "n_turns", "n_copies", F.col("piece").alias("part"),
                         F.array_join(F.col("turns.turn"), "").alias("text"))


CHAT_SQL = r"""
WITH r AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS rank
  FROM conversations),
h AS (SELECT *, CASE WHEN role IS NULL THEN 'n' ELSE md5(role) END || CASE WHEN text IS NULL THEN 'n' ELSE md5(text) END AS h FROM r),
p AS (SELECT *, md5(string_agg(h, ',') OVER (PARTITION BY conv_id ORDER BY rank ROWS UNBOUNDED PRECEDING)) AS p FROM h),
w AS (SELECT conv_id, max(rank) AS n_turns, arg_max(p, rank) AS p FROM p GROUP BY conv_id),
k AS (SELECT n_turns, p, min(conv_id) AS conv_id, count(*) AS n_copies FROM w GROUP BY n_turns, p),
q AS (SELECT DISTINCT p.rank, p.p FROM p JOIN w ON p.conv_id IS NOT DISTINCT FROM w.conv_id WHERE p.rank < w.n_turns),
m AS (SELECT k.* FROM k LEFT JOIN q ON k.n_turns = q.rank AND k.p = q.p WHERE q.p IS NULL)
SELECT m.conv_id, m.n_turns, m.n_copies, CAST((r.rank - 1) // 256 AS BIGINT) AS part,
       string_agg('<|start|>' || replace(coalesce(role, ''), '<|', '<\|') || chr(10)
                  || replace(coalesce(text, ''), '<|', '<\|') || '<|end|>' || chr(10), '' ORDER BY rank) AS text
FROM m JOIN r ON m.conv_id IS NOT DISTINCT FROM r.conv_id
GROUP BY m.conv_id, m.n_turns, m.n_copies, (r.rank - 1) // 256
"""
