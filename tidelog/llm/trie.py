"""The prefix trie of conversations, read off the sorted sequences by range-minimum queries."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored
from tidelog.llm.ordered import partition_ends, placed

#: Shared heads have fewer turns than this.
_HEADS = 9


def head_length(conv_id: Column) -> Column:
    """How many turns a conversation takes over from the first of its five."""
    return F.crc32(conv_id.cast("string").cast("binary")) % _HEADS


def _identity(a: str, b: str) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), a, b), F.xxhash64(F.lit(2), b, a)


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns ``(conv_id, pos, a, b, n_bytes)`` of the rebuilt conversations, and ``(conv_id, n_turns)`` of each of them.

    ``a`` and ``b`` name a turn's role and text by 128 bits of hashes; texts are not carried on. Turns are ordered by turn
    (null first), then role and text. Rows without conv_id belong to no conversation. A head has a few turns at most,
    so the join with it multiplies nothing.
    """
    own = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    a, b = _identity("role", "text")
    own = own.select("*", a.alias("a"), b.alias("b"), F.octet_length("text").cast("long").alias("n_bytes"))
    own = stored(placed(own, "conv_id", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], "turns", drop=("turn", "role", "text")), "own-turns")
    ids = stored(own.groupBy("conv_id").agg(F.count("*").alias("n")), "conversations")
    heads = ids.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    info = ids.withColumns({"h": head_length(F.col("conv_id")), "base": F.col("conv_id") - F.col("conv_id") % 5}).join(heads, "base", "left")
    info = stored(info.withColumn("head", F.least("h", F.coalesce("n_base", F.lit(0)))), "heads")
    columns = ["conv_id", "pos", "a", "b", "n_bytes"]
    shared = info.select("conv_id", "base", "h").join(
        own.where(F.col("place") < _HEADS).withColumnRenamed("conv_id", "base").withColumnRenamed("place", "pos"), "base").where("pos < h")
    rest = own.join(info.select("conv_id", "h", "head"), "conv_id").where("place >= h").withColumn("pos", F.col("place") - F.col("h") + F.col("head"))
    lengths = info.select("conv_id", (F.col("head") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("n_turns"))
    return shared.select(*columns).unionByName(rest.select(*columns)), lengths


def _alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted prefixes with whether a neighbour in the partition is the same."""
    part, row, held, as_before = TaskContext.get().partitionId(), 0, None, False

    def flagged(rows: pd.DataFrame, shared: np.ndarray) -> pd.DataFrame:
        return rows.assign(shared=shared, __part=part, __row=row + np.arange(len(rows)))

    for batch in batches:
        if not len(batch):
            continue
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        same = np.logical_and.reduce([rows[c].to_numpy()[1:] == rows[c].to_numpy()[:-1] for c in ("p", "q", "pos")])
        before = np.r_[as_before, same]
        if len(rows) > 1:
            yield flagged(rows.iloc[:-1], before[:-1] | same)
        held, as_before, row = rows.iloc[-1:], bool(before[-1]), row + len(rows) - 1
    if held is not None:
        yield flagged(held, np.array([as_before]))


def named_prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with ``p`` and ``q``, 128 bits that name the prefix ending here, and whether it is ``shared``.

    The names are running XORs of the turns' hashes mixed with their position. Equal prefixes are neighbours once sorted; those of a
    very common one are told apart by their conversation, so they may fill many partitions, whose ends are compared at last.
    """
    p, q = F.xxhash64("pos", "a", "b"), F.xxhash64(F.lit(3), "b", "pos", "a")
    named = stored(placed(turns.select("*", p.alias("p"), q.alias("q")), "conv_id", [F.col("pos")], "prefixes", xors=("p", "q")).drop("place"), "named")
    order = ["p", "q", "pos", "conv_id"]
    ordered = named.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema) + ", shared boolean, __part long, __row long"
    found = stored(ordered.mapInPandas(_alike, schema), "alike")
    ends = partition_ends(found, "p", "q", "pos")
    by_part = Window.orderBy("__part")  # one row per partition
    ends = ends.select("__part", "rows", (F.lag("tail").over(by_part) == F.col("head")).alias("goes_on"),
                       (F.lead("head").over(by_part) == F.col("tail")).alias("goes_further"))
    ends = stored(ends, "prefix-parts")
    first, last = F.col("__row") == 0, F.col("__row") == F.col("rows") - 1
    shared = F.col("shared") | (first & F.coalesce("goes_on", F.lit(False))) | (last & F.coalesce("goes_further", F.lit(False)))
    return stored(found.join(ends, "__part").select(*named.columns, shared.alias("shared")), "flagged")


def _common(path: np.ndarray, other: np.ndarray) -> int:
    m = min(len(path), len(other))
    differ = np.flatnonzero(path[:m] != other[:m])
    return int(differ[0] if len(differ) else m) // 2


def _adjacent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted sequences with the turns each has in common with the one before (-1: unknown) and after it."""
    part, row, held = TaskContext.get().partitionId(), 0, None
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        paths = rows["path"].to_numpy()
        between = [_common(x, y) for x, y in zip(paths, paths[1:])]
        rows["lcp"] = [-1 if held is None else held_lcp, *between]
        rows["after"] = [*between, -1]
        rows["__part"], rows["__row"] = part, row + np.arange(len(rows))
        yield rows.iloc[:-1]
        held, held_lcp, row = rows.iloc[-1:][batch.columns], rows["lcp"].iloc[-1], row + len(rows) - 1
        last = rows.iloc[-1:]
    if held is not None:
        yield last


def sorted_sequences(sequences: DataFrame) -> DataFrame:
    """Distinct sequences in lexicographic order: ``at`` (0, 1, …), ``lcp`` with the one before, ``after`` with the next; -1 at both ends."""
    ordered = sequences.repartitionByRange("path").sortWithinPartitions("path")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema) + ", lcp long, after long, __part long, __row long"
    found = stored(ordered.mapInPandas(_adjacent, schema), "sequences")
    by_part = Window.orderBy("__part")
    common = F.array_position(F.zip_with("x", "y", lambda x, y: x.eqNullSafe(y)), False)
    common = F.floor(F.when(common > 0, common - 1).otherwise(F.size("x")) / 2)
    ends = partition_ends(found, "path").select(  # one row per partition
        "__part", "rows", F.col("head.path").alias("head"), F.col("tail.path").alias("tail"))
    ends = ends.select("__part", "rows", (F.sum("rows").over(by_part) - F.col("rows")).alias("offset"), F.lag("tail").over(by_part).alias("x"), F.col("head").alias("y"))
    ends = ends.withColumn("edge", F.when(F.col("x").isNotNull(), common).otherwise(-1))
    ends = stored(ends.select("__part", "rows", "offset", "edge", F.coalesce(F.lead("edge").over(by_part), F.lit(-1)).alias("edge_after")), "sequence-parts")
    return found.join(ends, "__part").select(
        *sequences.columns, (F.col("offset") + F.col("__row")).alias("at"),
        F.when(F.col("__row") == 0, F.col("edge")).otherwise(F.col("lcp")).cast("long").alias("lcp"),
        F.when(F.col("__row") == F.col("rows") - 1, F.col("edge_after")).otherwise(F.col("after")).cast("long").alias("after"))


class RangeMin:
    """Sparse table: minima of all spans whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels, width = [values], 1
        while 2 * width <= len(values):
            self.levels.append(np.minimum(self.levels[-1][:-width], self.levels[-1][width:]))
            width *= 2
        self.n = len(values)

    def least(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Minima of [left, right]."""
        power = np.int64(np.log2(right - left + 1))
        out = np.empty(len(left), self.levels[0].dtype)
        for k in np.unique(power):
            own = power == k
            out[own] = np.minimum(self.levels[k][left[own]], self.levels[k][right[own] - (1 << k) + 1])
        return out

    def reach_right(self, at: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """The greatest r with all values of (at, r] at ``floor`` or more: a binary search per entry."""
        r = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            ok = (r + (1 << k) < self.n) & (level[np.minimum(r + 1, len(level) - 1)] >= floor)
            r = np.where(ok, r + (1 << k), r)
        return r

    def reach_left(self, at: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """The least l with all values of (l, at] at ``floor`` or more: a binary search per entry."""
        left = at.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            ok = (left - (1 << k) >= 0) & (self.levels[k][np.maximum(left - (1 << k) + 1, 0)] >= floor)
            left = np.where(ok, left - (1 << k), left)
        return left


_PIECE = ("block long, depth long, open boolean, own boolean, left long, right long, least long, n_convs long, n_children long, n_leaves long, "
          "weighted long, fresh long, before long, rest long, p long, q long, is_end boolean, parent_least long, parent_block long")


def _pieces(floors: list[int]):
    """Of a block of sorted sequences: each prefix that starts there (``own``) or goes on there, with its member interval.

    Prefixes that go on beyond the block (``open``) are pieces; ``block`` is the one that the prefix starts in, found by a
    binary search over the blocks' least common prefixes (``floors``).
    """
    over = RangeMin(np.array(floors, dtype="int64"))

    def started(block: int, depth: np.ndarray) -> np.ndarray:
        """Where the prefix of ``depth`` starts that reaches into ``block`` from its left."""
        return over.reach_left(np.full(len(depth), block - 1, dtype="int64"), depth)

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block = int(key[0])
        rows = rows.sort_values("at")
        lcp, after, n, least, tails, at, p, q = (rows[c].to_numpy(dtype="int64") for c in ("lcp", "after", "n", "least", "tails", "at", "p", "q"))
        m = len(rows)
        sums = [np.concatenate(([0], np.cumsum(np.asarray(x, dtype="int64")))) for x in rows["bytes"]]
        length = np.array([len(s) - 1 for s in sums])
        total = np.array([s[-1] for s in sums])
        flat, offset = np.concatenate(sums), np.cumsum([0, *[len(s) for s in sums]])[:-1]

        def upto(i, depth):  # bytes of the turns before the one at ``depth``
            return flat[offset[i] + np.maximum(depth - 1, 0)]

        table, leasts = RangeMin(lcp), RangeMin(least)
        first = lcp + 1
        if block:
            first[0] = 0
        count = length - first + 1
        i = np.repeat(np.arange(m), count)
        depth = first[i] + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
        own = depth > lcp[i]
        left, right = table.reach_left(i, depth), table.reach_right(i, depth)
        opens = (right == m - 1) & (after[-1] >= depth)
        order = np.sort(lcp * (m + 1) + np.arange(m))  # places by (lcp, place)
        begun = np.searchsorted(order, depth * (m + 1) + right, "right") - np.searchsorted(order, depth * (m + 1) + left + own, "left")
        ends_here = length[i] == depth
        children = begun + np.where(own, np.where(ends_here, tails[i], 1), 0)
        leaf = np.where(tails > 0, tails, after < length)
        sum_n, sum_leaf, sum_bytes, sum_fresh = (np.concatenate(([0], np.cumsum(x))) for x in (n, leaf, n * total, total - upto(np.arange(m), first.clip(0))))
        if block:  # what is fresh in the first row starts after the turns it shares
            sum_fresh[1:] += total[0] - upto(np.array([0]), lcp[:1] + 1)[0] - sum_fresh[1]
        up = np.maximum(depth - 1, 0)
        up_left, up_right = table.reach_left(i, up), table.reach_right(i, up)
        up_behind = (up_left == 0) & (lcp[0] >= up)
        up_open = up_behind | ((up_right == m - 1) & (after[-1] >= up))
        up_block = np.where(up_behind, started(block, up) if block else 0, block)
        root = depth == 0
        return pd.DataFrame({
            "block": np.where(own, block, started(block, depth) if block else 0), "depth": depth, "open": opens | ~own, "own": own,
            "left": at[left], "right": at[right], "least": leasts.least(left, right),
            "n_convs": sum_n[right + 1] - sum_n[left], "n_children": children, "n_leaves": sum_leaf[right + 1] - sum_leaf[left],
            "weighted": sum_bytes[right + 1] - sum_bytes[left], "fresh": sum_fresh[right + 1] - sum_fresh[left + own],
            "before": np.where(own, upto(i, depth), 0), "rest": np.where(own, total[i] - upto(i, depth), 0), "p": p[i], "q": q[i],
            "is_end": own & ends_here,
            "parent_least": pd.array(np.where(root | up_open, -1, leasts.least(up_left, up_right)), dtype="Int64").copy(),
            "parent_block": np.where(root, -2, np.where(up_open, up_block, -1))})

    return run


def shared_nodes(sequences: DataFrame, block_rows: int = 4096) -> DataFrame:
    """The nodes of the trie of ``sequences(path, bytes, n, least, tails, p, q)``, with their member intervals.

    Sequences are sorted, and common prefixes of neighbours computed. Each block of the order builds a sparse table of them,
    in which every prefix searches its left and right extent independently. What crosses blocks is
    put together from pieces. A block has ``block_rows`` sequences, or the square root of their number if that is more: so both a
    block and the list of blocks' minima, the one thing that passes the driver, stay at the square root.
    """
    ranked = stored(sorted_sequences(sequences), "ranked")
    rows = max(block_rows, math.isqrt(ranked.count()) + 1)
    blocked = ranked.withColumn("block", F.floor(F.col("at") / rows))
    floors = [r["floor"] for r in blocked.groupBy("block").agg(F.min("lcp").alias("floor")).orderBy("block").collect()]
    pieces = stored(blocked.drop("path").groupBy("block").applyInPandas(_pieces(floors), _PIECE), "pieces")

    def only_own(name: str) -> Column:
        return F.max(F.when(F.col("own"), F.col(name))).alias(name)

    joined = pieces.where("open").groupBy("block", "depth").agg(
        F.min("left").alias("left"), F.max("right").alias("right"), F.min("least").alias("least"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "weighted", "fresh")],
        *[only_own(c) for c in ("before", "rest", "p", "q", "is_end", "parent_least", "parent_block")])
    joined = stored(joined, "joined-pieces")
    nodes = pieces.where("NOT open").drop("open", "own").unionByName(joined)
    parents = joined.select(F.col("block").alias("parent_block"), (F.col("depth") + 1).alias("depth"), F.col("least").alias("open_least"))
    # Parents that lie in one block are known there; the others are the few pieced together.
    return nodes.join(parents, ["parent_block", "depth"], "left").select(
        "depth", "left", "right", F.col("least").alias("conv_id"),
        F.when(F.col("parent_block") == -2, None).otherwise(F.coalesce("open_least", "parent_least")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves",
        (F.col("weighted") - F.col("n_convs") * F.col("before") - F.col("fresh") - F.col("rest")).alias("saved_tokens"), "p", "q", "is_end")


def _chunks(size: int):
    """Sorted (p, q, conv_id) to texts of at most ``size`` ids of one group."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not len(batch):
                continue
            p, q, ids = (batch[c].to_numpy() for c in ("p", "q", "conv_id"))
            at = np.arange(len(batch))
            begun = np.maximum.accumulate(np.where(np.r_[True, (p[1:] != p[:-1]) | (q[1:] != q[:-1])], at, 0))
            cuts = np.flatnonzero((at - begun) % size == 0)
            out = [(int(p[a]), int(q[a]), part, row + k, ",".join(map(str, ids[a:b]))) for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(batch)]))]
            row += len(out)
            yield pd.DataFrame(out, columns=["p", "q", "part", "row", "ids"])

    return run


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted chunks to one SHA-256 per group; a group of any length passes as a stream."""
    key, digest = None, None
    for batch in batches:
        out = []
        for p, q, ids in zip(batch["p"], batch["q"], batch["ids"]):
            if (p, q) != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (p, q), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if out:
            yield pd.DataFrame(out, columns=["p", "q", "ends"])
    if key is not None:
        yield pd.DataFrame([(*key, digest.hexdigest())], columns=["p", "q", "ends"])


def id_digests(members: DataFrame, size: int = 10_000) -> DataFrame:
    """SHA-256 of each group's ids, ascending and comma-joined: ``members(p, q, conv_id)`` to ``(p, q, ends)``.

    A digest is sequential by nature, so one task takes a group's ids as a stream of texts made elsewhere; it holds one text at a time.
    """
    keys = ["p", "q"]
    texts = members.repartitionByRange(*keys, "conv_id").sortWithinPartitions(*keys, "conv_id").mapInPandas(
        _chunks(size), "p long, q long, part long, row long, ids string")
    texts = stored(texts, "id-texts")
    return texts.repartition(*keys).sortWithinPartitions(*keys, "part", "row").mapInPandas(_digests, "p long, q long, ends string")


def prefix_trie(conversations: DataFrame, block_rows: int = 4096) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, from the empty one.

    Columns: ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256`` (see the query's contract), and ``left, right``: the member interval in the order of distinct sequences (null
    for prefixes of one conversation alone).

    Only prefixes that more than one conversation has enter the sorted sequences, 16 bytes a turn; the rest of a conversation, however
    long, is one chain of rows and never gathered. So what one task holds is the shared part of a conversation.

    ``%`` of a negative conv_id is SQL's, with its sign. Null roles and texts are empty. Rows without conv_id belong to no conversation; equal or null turn numbers are ordered by
    role and text. Repeated rows are turns of their own. An empty table gives no rows, not even a root. Other columns are ignored.
    """
    conversations = conversations.select("conv_id", "turn", "role", "text")
    turns, lengths = rebuilt_turns(conversations)
    turns = named_prefixes(turns)
    gathered = turns.where("shared").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "a", "b", "n_bytes", "p", "q"))).alias("s"))
    none = F.array().cast("array<bigint>")
    zero = F.lit(0).cast("long")
    last = F.element_at("s", -1)
    convs = lengths.join(gathered, "conv_id", "left").select(
        "conv_id", "n_turns", F.coalesce(F.flatten(F.transform("s", lambda t: F.array(t["a"], t["b"]))), none).alias("path"),
        F.coalesce(F.transform("s", lambda t: t["n_bytes"]), none).alias("bytes"), F.coalesce(F.size("s"), zero).alias("n_shared"),
        F.coalesce(F.when(F.col("s").isNotNull(), last["p"]), zero).alias("p"), F.coalesce(F.when(F.col("s").isNotNull(), last["q"]), zero).alias("q"))
    convs = convs.withColumn("n_shared", F.greatest("n_shared", zero))
    convs = stored(convs, "shared-parts")
    sequences = convs.groupBy("path", "bytes", "p", "q").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), F.count_if(F.col("n_turns") > F.col("n_shared")).alias("tails"))
    nodes = stored(shared_nodes(sequences, block_rows), "shared-nodes")

    digests = stored(id_digests(convs.where("n_turns = n_shared").select("p", "q", "conv_id")), "digests")
    nothing = hashlib.sha256().hexdigest()
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "left", "right"]
    ends = nodes.where("is_end")
    at_ends = ends.join(digests, ["p", "q"], "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(nothing)))
    inside = nodes.where("NOT is_end").withColumn("ends_sha256", F.lit(nothing))

    # The rest of each conversation: a chain below the end of its shared part.
    above = convs.where("n_turns > n_shared").join(ends.select("p", "q", F.col("conv_id").alias("above")), ["p", "q"])
    alone = turns.where("NOT shared").select("conv_id", "pos").join(above.select("conv_id", "n_turns", "n_shared", "above"), "conv_id")
    final = F.col("pos") + 1 == F.col("n_turns")
    one = F.lit(1).cast("long")
    chain = alone.select(
        "conv_id", (F.col("pos") + 1).alias("depth"),
        F.when(F.col("pos") == F.col("n_shared"), F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        one.alias("n_convs"), F.when(final, zero).otherwise(one).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(final, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(F.lit(nothing)).alias("ends_sha256"),
        F.lit(None).cast("long").alias("left"), F.lit(None).cast("long").alias("right"))
    return at_ends.select(*result).unionByName(inside.select(*result)).unionByName(chain)


#: CRC-32 of a number's decimal text.
CRC32_SQL = """xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(string_split(CAST({x} AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295::BIGINT)"""

#: The rows of the query: prefixes named by the digests of their turns, grouped, and each node's sums handed to the prefixes of its least member.
TRIE_SQL = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS spot,
         md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS name, strlen(coalesce(text, '')) AS n_bytes
  FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT DISTINCT conv_id, """ + CRC32_SQL.format(x="conv_id") + """ % 9 AS h, conv_id - conv_id % 5 AS base FROM t),
b AS (SELECT i.conv_id, t.spot AS pos, name, n_bytes FROM i JOIN t ON t.conv_id = i.base AND t.spot < i.h),
k AS (SELECT conv_id, count(*) AS head FROM b GROUP BY conv_id),
u AS (
  SELECT * FROM b
  UNION ALL
  SELECT i.conv_id, spot - h + coalesce(head, 0), name, n_bytes FROM i JOIN t USING (conv_id) LEFT JOIN k USING (conv_id) WHERE spot >= h),
p AS (
  SELECT conv_id, pos + 1 AS depth, n_bytes, string_agg(name, '') OVER (PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS path FROM u
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM i),
n AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(n_bytes) AS n_bytes FROM p GROUP BY path, depth),
c AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
e AS (SELECT path, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
      FROM (SELECT conv_id, max_by(path, depth) AS path FROM p GROUP BY conv_id) GROUP BY path),
s AS (
  SELECT p.path, sum((n.n_convs - 1) * n.n_bytes) AS saved_tokens, count(*) FILTER (WHERE c.path IS NULL) AS n_leaves
  FROM n LEFT JOIN c USING (path) JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.path)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends, sha256('')) AS ends_sha256
FROM n JOIN s USING (path) LEFT JOIN c USING (path) LEFT JOIN e USING (path)
LEFT JOIN n AS m ON n.depth > 0 AND m.path = left(n.path, 32 * (n.depth - 1))
"""
