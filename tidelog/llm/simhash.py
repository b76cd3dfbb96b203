"""SimHash near-duplicates, found through one-wildcard segment variants."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored
from tidelog.llm.graph import connected_components

BITS = 64


def fingerprint(text: str | None, words: int = 3) -> int:
    """The SimHash of a text, as a signed 64-bit number; without any word 0."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(found) - words + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist())), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def _fingerprints(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch.drop(columns="text")
            out["fp"] = [fingerprint(t, words) for t in batch["text"]]
            yield out

    return run


def row_names(docs: DataFrame) -> list[Column]:
    """128 bits that name a row by all its columns, ``__r1`` and ``__r2``: equal for equal rows only."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    nulls = [c.isNull() for c in columns]
    return [F.xxhash64(F.lit(1), *nulls, *columns).alias("__r1"), F.xxhash64(F.lit(2), *columns[::-1], *nulls).alias("__r2")]


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, __r1, __r2, fp) per row: its id, null where it has none, its name (see ``row_names``) and its fingerprint."""
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_names(docs), "text")
    # Arrow turns null ids into floats; the flag keeps them whole.
    slim = slim.select(F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("unnamed"), "__r1", "__r2", "text")
    found = slim.mapInPandas(_fingerprints(words), "doc_id long, unnamed boolean, __r1 long, __r2 long, fp long")
    return found.select(F.when(~F.col("unnamed"), F.col("doc_id")).alias("doc_id"), "__r1", "__r2", "fp")


def _segments(distance: int) -> list[tuple[int, int, bool]]:
    """(shift, width, wildcard) per segment.

    With ``distance // 2 + 1`` segments one of them differs by at most one bit. The first such segment finds the pair: those
    before it use up two bits each, so the last may need no wildcard.
    """
    n = distance // 2 + 1
    edges = [BITS * i // n for i in range(n + 1)]
    return [(edges[i], edges[i + 1] - edges[i], distance - 2 * i >= 1) for i in range(n)]


def _cut(value: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(value, shift).bitwiseAND(F.lit((1 << width) - 1 if width < BITS else -1))


def _variants(distance: int) -> Column:
    """Index entries of ``fp``: per segment its value with one bit wiped out, for each bit."""
    keys = []
    for s, (shift, width, wildcard) in enumerate(_segments(distance)):
        value = _cut(F.col("fp"), shift, width)
        for bit in range(width if wildcard else 1):
            wiped = value.bitwiseAND(F.lit(~(1 << bit) if bit < BITS - 1 else (1 << bit) - 1)) if wildcard else value
            keys.append(F.struct(F.lit((s << 8) + bit).alias("slot"), wiped.alias("value")))
    return F.array(*keys)


def _is_first(differ: Column, slot: Column, distance: int) -> Column:
    """Whether ``slot`` is the one entry under which a pair counts, of the many that it may share."""
    found = F.lit(None)
    for s, (shift, width, wildcard) in reversed(list(enumerate(_segments(distance)))):
        part = _cut(differ, shift, width)
        bit = (F.when(part == 0, F.lit(0)).when(part == -(1 << 63), F.lit(63)).otherwise(F.bit_count(part - 1)) if wildcard else F.lit(0))
        found = F.when(F.bit_count(part) <= int(wildcard), F.lit(s << 8) + bit).otherwise(found)
    return slot == found


def fingerprint_links(fps: DataFrame, distance: int = 2, crowd: int = 4096) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct ``fp`` that differ in at most ``distance`` bits.

    Entries that nobody shares go first, by a count. Members of an entry with more than ``crowd`` fingerprints are not
    paired with each other there: each looks up all values within ``distance`` instead, a fixed number of equality
    lookups per member, so that no entry costs the square of its members. Both ways find every pair.
    """
    index = fps.select("fp", F.explode(_variants(distance)).alias("k")).select("fp", "k.slot", "k.value")
    counts = index.groupBy("slot", "value").agg(
        F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("n > 1")
    counts = stored(counts, "shared-entries")
    near = (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance) & _is_first(
        F.col("a").bitwiseXOR(F.col("b")), F.col("slot"), distance)
    two = counts.where("n = 2").select("slot", F.col("lo").alias("a"), F.col("hi").alias("b")).where(near).select("a", "b")
    several = counts.where(f"n > 2 AND n <= {crowd}").select("slot", "value").hint("shuffle_hash")
    some = stored(index.join(several, ["slot", "value"], "left_semi"), "entries")
    left, right = some.withColumnRenamed("fp", "a"), some.withColumnRenamed("fp", "b")
    paired = left.join(right, ["slot", "value"]).where(F.col("a") < F.col("b")).where(near).select("a", "b")
    links = two.unionByName(paired)
    if not counts.where(f"n > {crowd}").isEmpty():
        members = index.join(counts.where(f"n > {crowd}").select("slot", "value"), ["slot", "value"], "left_semi").select("fp").distinct()
        ball = members.select("fp", F.col("fp").alias("b"))
        for _ in range(distance):
            flips = F.array(F.lit(0).cast("long"), *[F.lit(-(1 << 63) if i == 63 else 1 << i).cast("long") for i in range(BITS)])
            ball = ball.select("fp", F.explode(F.transform(flips, lambda f: F.col("b").bitwiseXOR(f))).alias("b")).distinct()
        looked = ball.where("fp <> b").join(fps.select(F.col("fp").alias("b")), "b", "left_semi")
        links = links.unionByName(looked.select(F.least("fp", "b").alias("a"), F.greatest("fp", "b").alias("b")))
    return links


def _in_components(docs: DataFrame, distance: int, words: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of all rows, and each distinct fingerprint's component, named by its least fingerprint."""
    prints = stored(fingerprints(docs, words), "fingerprints")
    distinct = stored(prints.select("fp").distinct(), "distinct-fingerprints")
    found = stored(connected_components(fingerprint_links(distinct, distance)), "linked-fingerprints")
    return prints, found.select(F.col("id").alias("fp"), F.col("component").alias("group"))


def simhash_components(docs: DataFrame, distance: int = 2, words: int = 3) -> DataFrame:
    """One row per document: ``doc_id, fp, component``, the least id that it reaches over links.

    A null text counts as empty; texts without a word have fingerprint 0 and link like any other. A document without id keeps a
    null id; it links others and has their component, which is null where no document of the component has an id. Repeated rows
    give a row each. An empty table gives no rows.
    """
    prints, linked = _in_components(docs, distance, words)
    # Least id per fingerprint first, so that no copy enters the joins.
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("lead")).join(linked, "fp", "left").withColumn("group", F.coalesce("group", "fp"))
    classes = stored(classes, "fingerprint-classes")
    least = classes.groupBy("group").agg(F.min("lead").alias("component"))
    named = stored(classes.join(least, "group").select("fp", "component"), "named")
    return prints.join(named, "fp").select("doc_id", "fp", "component")


def keep_one_per_component(docs: DataFrame, distance: int = 2, words: int = 3) -> DataFrame:
    """One document of each component, with all its columns: that with the least id (rows with an id first), of several rows under it
    the one with the least fingerprint and name.

    Nulls, texts without words and empty tables: see ``simhash_components``. Documents are told apart by all their columns. What goes is
    found without the texts, and leaves them by an anti join; only rows that occur more than once meet again.
    """
    prints, linked = _in_components(docs, distance, words)
    rows = prints.groupBy("fp", "__r1", "__r2").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    rows = stored(rows.join(linked, "fp", "left").withColumn("group", F.coalesce("group", "fp")), "rows")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "fp", "__r1", "__r2")
    first = rows.groupBy("group").agg(F.min_by(F.struct("__r1", "__r2", "copies"), order).alias("kept"))
    first = stored(first.select("kept.*"), "kept-rows")
    names = ["__r1", "__r2"]
    gone = stored(rows.select(*names).join(first, names, "left_anti"), "gone-rows")
    again = stored(first.where("copies > 1").select(*names), "repeated-rows")
    mine = docs.select("*", *row_names(docs))
    # Both sides grow with the documents, so the plan is one that holds at every size: names are hashed, texts not sorted.
    kept = mine.join(gone.unionByName(again).hint("shuffle_hash"), names, "left_anti")
    once = mine.join(again, names, "left_semi").dropDuplicates(names)
    return kept.unionByName(once).select(*[f"`{c}`" for c in docs.columns])
