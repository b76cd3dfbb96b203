"""Benchmark decontamination: SimHash windows of item size, Hamming blocks, exact shingle similarity. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import doc_key, stored

SHINGLE = 5


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: Column, n: int) -> Column:
    """Hashes of every run of ``n`` words, repeats included; none if there are fewer words."""
    count = F.size(words) - n + 1
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))


def _simhash(hashes: Column) -> Column:
    """A bit is set if it is in over half the hashes."""
    def bit(b: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0), lambda n, h: n + F.call_function("getbit", h, b))
        return F.when(2 * ones > F.size(hashes), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("long"), lambda fp, b: fp.bitwiseOR(bit(b)))


def _blocks(fp: Column, radius: int) -> Column:
    """``radius + 1`` pieces of a fingerprint: two fingerprints within ``radius`` agree in one piece at least."""
    edges = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"))
                     for i, (a, b) in enumerate(zip(edges, edges[1:]))])


def _shared(a: Column, b: Column) -> Column:
    """The sum over shingles of the lesser of both multiplicities."""
    def times(values: Column, x: Column) -> Column:
        return F.size(F.filter(values, lambda y: y == x))
    common = F.array_intersect(a, b)
    # Where one side has no shingle twice, as is usual, each common one counts once.
    once = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(once, F.size(common)).otherwise(F.aggregate(common, F.lit(0), lambda n, x: n + F.least(times(a, x), times(b, x))))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """(item_id, n_words, n, hashes, fp): n is the shingle size, 5 or all words of a shorter item. Wordless items go: they match nothing."""
    items = benchmark.select("item_id", _words(F.col("text")).alias("w")).withColumn("n_words", F.size("w")).where("n_words > 0")
    sizes = [_shingles(F.col("w"), n) for n in range(1, SHINGLE + 1)]
    n = F.least(F.col("n_words"), F.lit(SHINGLE))
    hashes = reduce(lambda other, k: F.when(n == k, sizes[k - 1]).otherwise(other), range(1, SHINGLE), sizes[-1])
    return items.select("item_id", "n_words", n.alias("n"), hashes.alias("hashes")).withColumn("fp", _simhash(F.col("hashes")))


def item_windows(docs: DataFrame, items: DataFrame, sent: int = 200_000) -> DataFrame:
    """(key, item_id, n_words, window): item-sized windows of the documents, as shingle hashes, at every place where one lines up with an item.

    A window that shares no shingle with an item has similarity 0, so windows are laid where a shingle of the text is one of an
    item's, with the same offset; of hits in a row with one offset the first lays the window. The items' shingles are sent
    to all tasks in portions of at most ``sent`` rows, one pass over the documents each.
    """
    entries = items.select("item_id", "n_words", "n", "hashes", F.posexplode("hashes").alias("at", "hash")).select(
        "item_id", "n_words", "n", "at", "hash", F.when(F.col("at") > 0, F.get("hashes", F.col("at") - 1)).alias("previous"))
    entries = stored(entries, "benchmark-shingles")
    sizes = [(r["n"], r["rows"]) for r in entries.groupBy("n").agg(F.count("*").alias("rows")).collect()]  # 5 rows at most
    parts = []
    for n, rows in sizes:
        hashed = docs.select("key", _words(F.col("text")).alias("w")).select("key", _shingles(F.col("w"), n).alias("hashes"))
        portions = -(-rows // sent)
        for portion in range(portions):
            some = entries.where((F.col("n") == n) & (F.pmod(F.col("hash"), F.lit(portions)) == portion)).drop("n")
            # Outer: else a filter on the array is derived and computed, words and all, below the scan.
            hits = hashed.select("key", "hashes", F.posexplode_outer("hashes").alias("place", "hash")).join(F.broadcast(some), "hash")
            hits = hits.where(F.col("previous").isNull() | (F.col("place") == 0) | (F.get("hashes", F.col("place") - 1) != F.col("previous")))
            first = F.greatest(F.lit(0), F.col("place") - F.col("at"))
            end = F.least(F.size("hashes"), F.col("place") - F.col("at") + F.col("n_words") - n + 1)
            parts.append(hits.select("key", "item_id", "n_words", F.slice("hashes", first + 1, end - first).alias("window")))
    if not parts:
        return docs.select("key", F.lit(None).cast("long").alias("item_id"), F.lit(0).alias("n_words"), F.array().cast("array<bigint>").alias("window")).where("false")
    return reduce(DataFrame.unionByName, parts)


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, radius: int = 23) -> DataFrame:
    """Pairs ``key, item_id, similarity``: a window of the document is at least ``least`` similar to the benchmark item.

    Similarity is that of the multisets of 5-word shingles: the sum of lesser by the sum of greater multiplicities. Words are
    runs of letters and digits in lower case, so punctuation and layout don't matter. Windows find items of their size by SimHash blocks alone: two fingerprints share
    one of ``radius + 1`` blocks if they differ in up to ``radius`` bits, and at a similarity of 0.8 they differ in 10 on average, in over 23 less than once in
    100,000 times. What is found is verified exactly, and counts where the window lines up with the item. Equal windows are looked up once, however many documents
    hold them.

    Null and empty texts and items match nothing. Documents without id have a negative key made from their text; repeated rows
    give one pair. Empty tables give no rows.
    """
    mine = docs.select(doc_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    items = stored(benchmark_items(benchmark.where("item_id IS NOT NULL")), "items")
    windows = item_windows(mine, items).withColumn("digest", F.xxhash64("window", F.size("window")))
    windows = stored(windows, "windows")
    each = windows.groupBy("n_words", "digest").agg(F.first("window").alias("window"))
    each = stored(each.withColumn("fp", _simhash(F.col("window"))), "distinct-windows")
    by_block = each.select("n_words", "digest", "fp", F.explode(_blocks(F.col("fp"), radius)).alias("b")).select(
        "n_words", "digest", "fp", "b.block", "b.value")
    of_items = items.select("n_words", "item_id", F.col("fp").alias("item_fp"), F.explode(_blocks(F.col("fp"), radius)).alias("b")).select(
        "n_words", "item_id", "item_fp", "b.block", "b.value")
    near = by_block.join(of_items, ["n_words", "block", "value"]).where(
        F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius).select("n_words", "item_id", "digest").distinct()
    shared = _shared(F.col("window"), F.col("hashes"))
    alike = (
        near.join(each, ["n_words", "digest"]).join(items.select("item_id", "hashes"), "item_id")
        .select("item_id", "digest", shared.alias("shared"), (F.size("window") + F.size("hashes")).alias("both"))
        .select("item_id", "digest", (F.col("shared") / (F.col("both") - F.col("shared"))).alias("similarity"))
        .where(F.col("similarity") >= least))
    return windows.select("key", "item_id", "digest").join(alike, ["item_id", "digest"]).groupBy("key", "item_id").agg(
        F.max("similarity").alias("similarity"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.8) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    found = stored(contaminated(docs, benchmark, least).select(F.col("key").alias("__key")).distinct(), "contaminated")
    mine = docs.withColumn("__key", doc_key(F.col("doc_id"), F.col("text")))
    return mine.join(found, "__key", "left_anti").select(*[f"`{c}`" for c in docs.columns])


#: Rows of ``contaminated`` for items of five words or more; ``{docs}`` is the input.
DECONTAMINATE_SQL = r"""
WITH b AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark),
d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM {docs}),
bs AS (
  SELECT item_id, len(w) AS n_words, k, array_to_string(w[k + 1:k + 5], ' ') AS s
  FROM b, LATERAL (SELECT unnest(range(0, len(w) - 4)) AS k) WHERE len(w) >= 5),
ds AS (
  SELECT doc_id, len(w) - 4 AS n, p, array_to_string(w[p + 1:p + 5], ' ') AS s
  FROM d, LATERAL (SELECT unnest(range(0, len(w) - 4)) AS p) WHERE len(w) >= 5),
h AS (
  SELECT DISTINCT doc_id, item_id, n_words, n, p - k AS start FROM ds JOIN bs USING (s)),
wn AS (
  SELECT h.doc_id, h.item_id, h.start, ds.s, count(*) AS c
  FROM h JOIN ds ON h.doc_id = ds.doc_id AND ds.p >= h.start AND ds.p < h.start + h.n_words - 4
  GROUP BY ALL),
t AS (SELECT doc_id, item_id, start, sum(c) AS n FROM wn GROUP BY ALL),
bc AS (SELECT item_id, s, count(*) AS c FROM bs GROUP BY ALL),
bt AS (SELECT item_id, count(*) AS n FROM bs GROUP BY ALL),
m AS (
  SELECT wn.doc_id, wn.item_id, wn.start, sum(least(wn.c, bc.c)) AS shared
  FROM wn JOIN bc ON wn.item_id = bc.item_id AND wn.s = bc.s GROUP BY ALL)
SELECT m.doc_id, m.item_id, max(CAST(m.shared AS DOUBLE) / CAST(t.n + bt.n - m.shared AS DOUBLE)) AS similarity
FROM m JOIN t ON m.doc_id = t.doc_id AND m.item_id = t.item_id AND m.start = t.start JOIN bt ON bt.item_id = m.item_id
WHERE CAST(m.shared AS DOUBLE) / CAST(t.n + bt.n - m.shared AS DOUBLE) >= 0.8
GROUP BY m.doc_id, m.item_id
"""
