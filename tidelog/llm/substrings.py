"""Repeated substrings across documents: suffixes sorted in two stages at the places where a repeat can start."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored

LENGTH = 400
GRAM = 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """The least or greatest of every ``width`` neighbours, by doubling."""
    n, step = len(x) - width + 1, 1
    while 2 * step <= width:
        x = best(x[:-step], x[step:])
        step *= 2
    return best(x[:n], x[width - step:width - step + n])


def anchors(data: bytes, length: int = LENGTH) -> np.ndarray:
    """Positions whose 32 bytes have the least hash within some ``length`` bytes: equal strings of that length have equal anchors."""
    if len(data) < length:
        return np.zeros(0, np.int64)
    x, step, factor = np.frombuffer(data, np.uint8).astype(np.uint64), 1, 0x9E3779B97F4A7C15
    while step < GRAM:  # hashes of 2, 4, … 32 bytes
        x = x[:-step] * np.uint64(factor) + x[step:]
        factor, step = factor * factor % (1 << 64), 2 * step
    x = _mixed(x)
    width = length - GRAM + 1
    least = _sliding(x, width, np.minimum)
    padded = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    return np.flatnonzero(_sliding(padded, width, np.maximum) == x)


def _context(data: bytes, at: int, length: int) -> tuple[int, int]:
    """How far left and right of an anchor the strings of ``length`` that hold it reach."""
    return min(at, length - GRAM), min(length, len(data) - at)


def _common_prefixes(right: np.ndarray) -> np.ndarray:
    """Of each row with the row before it; 0 for the first."""
    out = np.zeros(len(right), np.int16)
    for at in range(1, len(right), 4096):
        differ = right[at:at + 4096] != right[at - 1:at - 1 + len(right[at:at + 4096])]
        out[at:at + 4096] = np.where(differ.any(1), differ.argmax(1), right.shape[1])
    return out


def _range_minima(values: np.ndarray) -> list[np.ndarray]:
    tables, step = [values], 1
    while 2 * step <= len(values):
        last = tables[-1]
        tables.append(np.minimum(last[:len(last) - step], last[step:]))
        step *= 2
    return tables


def repeated_starts(contexts: list[tuple[int, int, bytes]], length: int = LENGTH) -> list[list[int]]:
    """``contexts`` (group, bytes left of the anchor, data): per context the starts, counted from the anchor, of strings of ``length``
    that another context of its group has at the same start.

    Two-stage sorting: only the suffixes that start at an anchor are sorted directly. Those one byte further left follow from them by one stable pass
    over the buckets of their first byte, those two bytes left from these, and so on; suffixes that no other one agrees
    with up to its anchor are left behind. The common prefix of neighbours is what they share before the anchor plus a range minimum
    over the common prefixes of the suffixes sorted directly.
    """
    m = len(contexts)
    found: list[list[int]] = [[] for _ in contexts]
    if m < 2:
        return found
    first: dict[int, int] = {}
    group = np.array([first.setdefault(c[0], len(first)) for c in contexts])
    lo = np.array([c[1] for c in contexts])
    hi = np.array([len(c[2]) - c[1] for c in contexts])
    right = np.frombuffer(b"".join(c[2][c[1]:].ljust(length, b"\0") for c in contexts), np.uint8).reshape(m, length)
    left = np.ascontiguousarray(np.frombuffer(b"".join(c[2][:c[1]].rjust(length, b"\0") for c in contexts), np.uint8).reshape(m, length).T[::-1])
    rows = [r.tobytes() for r in right]
    order = np.array(sorted(range(m), key=lambda i: (group[i], rows[i])))
    rank = np.empty(m, np.int64)
    rank[order] = np.arange(m)
    minima = _range_minima(_common_prefixes(right[order]))
    label = group.copy()  # contexts with one label agree from the start to the anchor
    logs = np.zeros(m + 1, np.int64)
    logs[2:] = np.floor(np.log2(np.arange(2, m + 1))).astype(np.int64)
    for k in range(length - GRAM + 1):
        if k:
            order = order[lo[order] >= k]
            order = order[np.argsort(left[k - 1][order], kind="stable")]
            order = order[np.argsort(group[order].astype(np.uint16) if len(first) < 1 << 16 else group[order], kind="stable")]
        if len(order) < 2:
            break
        own = label[order] if not k else label[order] * 256 + left[k - 1][order]
        new = np.r_[True, own[1:] != own[:-1]]
        named = np.cumsum(new) - 1
        label[order] = named
        keep = np.bincount(named)[named] > 1
        order, new, named = order[keep], new[keep], named[keep]
        if len(order) < 2:
            break
        a, b = rank[order[:-1]] + 1, rank[order[1:]]
        joined = np.zeros(len(order), bool)
        same = np.flatnonzero(~new[1:])
        span = logs[b[same] - a[same] + 1]
        low = np.empty(len(same), np.int16)
        for size in np.unique(span):
            at = span == size
            table = minima[size]
            low[at] = np.minimum(table[a[same[at]]], table[b[same[at]] - (1 << int(size)) + 1])
        joined[same + 1] = low >= length - k
        run = np.cumsum(~joined) - 1
        able = hi[order] >= length - k
        hit = able & (np.bincount(run, able)[run] > 1)
        for i in order[hit].tolist():
            found[i].append(-k)
    return found


def _ranges(starts: list[int]) -> list[dict]:
    out: list[dict] = []
    for s in sorted(set(starts)):
        if out and out[-1]["b"] == s - 1:
            out[-1]["b"] = s
        else:
            out.append({"a": s, "b": s})
    return out


_RANGES = "array<struct<a:int, b:int>>"


def _bytes_of(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def removed_spans(docs: DataFrame, length: int = LENGTH, batch: int = 1 << 23, crowd: int = 60_000) -> DataFrame:
    """``digest, spans``: per text with any, the byte spans covered by a string of ``length`` bytes that also starts elsewhere.

    Anchors are bytes picked by content (one in about 170), so two equal strings have the same ones. Every anchor is keyed by its 32 bytes and by its
    context, all that strings holding it can reach: in a context that occurs twice every string is repeated, and
    one whose 32 bytes occur once has no repeated string. What is left, different contexts around equal bytes, goes to suffix sorting, a batch of whole
    groups at a time. Groups of more than ``crowd`` contexts, which might not fit a task, count the hashes of their strings instead.
    """
    mine = docs.select(F.coalesce("doc_id", F.lit(-1)).cast("long").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            out: list[tuple] = []
            for doc, text in zip(frame["doc"], frame["text"]):
                data = _bytes_of(text)
                spots = anchors(data, length).tolist()
                digest = hashlib.md5(data).digest() if spots else b""
                for p in spots:
                    left, right = _context(data, p, length)
                    both = xxhash.xxh3_128_intdigest(data[p - left:p + right], left)
                    out.append((doc, digest, p, xxhash.xxh3_64_intdigest(data[p:p + GRAM]) - (1 << 63), (both >> 64) - (1 << 63),
                                (both & ((1 << 64) - 1)) - (1 << 63), left, right))
                if len(out) > 20_000:
                    yield pd.DataFrame(out, columns=columns)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=columns)

    columns = ["doc", "digest", "at", "gram", "c1", "c2", "lo", "hi"]
    spots = mine.mapInPandas(find, "doc long, digest binary, at int, gram long, c1 long, c2 long, lo int, hi int")
    spots = stored(spots, "anchors")
    context = ["c1", "c2"]
    contexts = stored(spots.groupBy(*context).agg(
        F.count("*").alias("n"), F.first("gram").alias("gram"), F.first("lo").alias("lo"), F.first("hi").alias("hi"), F.min(F.struct("digest", "doc", "at")).alias("where")), "contexts")
    groups = stored(contexts.groupBy("gram").agg(F.count("*").alias("members")).where("members > 1"), "groups")
    whole = contexts.where(F.col("n") > 1).where(F.col("hi") + F.col("lo") >= length).select(
        *context, F.array(F.struct((-F.col("lo")).alias("a"), (F.col("hi") - length).alias("b"))).cast(_RANGES).alias("ranges"))
    open_ones = contexts.where(F.col("lo") + F.col("hi") >= length).join(groups, "gram")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["gram", "c1", "c2", "n", "members", "lo", "data"]
        for frame in batches:
            out, held = [], 0
            for text, wants in zip(frame["text"], frame["list"]):
                data = _bytes_of(text)
                for w in wants:
                    left, right = _context(data, w["at"], length)
                    out.append((w["gram"], w["c1"], w["c2"], w["n"], w["members"], left, data[w["at"] - left:w["at"] + right]))
                    held += left + right
                if held > 1 << 23:
                    yield pd.DataFrame(out, columns=names)
                    out, held = [], 0
            if out:
                yield pd.DataFrame(out, columns=names)

    keyed = mine.select("doc", "text", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"))

    def cuts(some: DataFrame) -> DataFrame:
        """The bytes of contexts, from one document that holds them."""
        wanted = some.groupBy("where.digest", "where.doc").agg(
            F.collect_list(F.struct(F.col("where.at").alias("at"), "gram", "c1", "c2", "n", "members")).alias("list"))
        return keyed.join(wanted, ["digest", "doc"]).select("text", "list").mapInPandas(
            cut, "gram long, c1 long, c2 long, n long, members long, lo int, data binary")

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        size = 0

        def done() -> pd.DataFrame:
            once = list({(r[1], r[2]): r for r in rows}.values())  # repeated rows of the table bring a context again
            starts = repeated_starts([(r[0], r[3], r[4]) for r in once], length)
            kept = [(r[1], r[2], _ranges(s)) for r, s in zip(once, starts) if s and r[5] == 1]
            return pd.DataFrame(kept, columns=[*context, "ranges"])

        for frame in batches:
            for row in zip(frame["gram"], frame["c1"], frame["c2"], frame["lo"], frame["data"], frame["n"]):
                if size > batch and row[0] != rows[-1][0]:
                    yield done()
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
        if rows:
            yield done()

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for c1, c2, lo, data in zip(frame["c1"], frame["c2"], frame["lo"], frame["data"]):
                starts = range(-lo, len(data) - length + 1 - lo)
                hashes = [xxhash.xxh3_128_intdigest(data[s + lo:s + lo + length], s + length) for s in starts]
                yield pd.DataFrame({"c1": c1, "c2": c2, "start": np.array(starts, np.int32), "h1": [(h >> 64) - (1 << 63) for h in hashes],
                                    "h2": [(h & ((1 << 64) - 1)) - (1 << 63) for h in hashes]})

    small = cuts(open_ones.where(F.col("members") <= crowd)).repartition("gram").sortWithinPartitions("gram")
    arrays = stored(small.mapInPandas(sort, f"c1 long, c2 long, ranges {_RANGES}"), "sorted")
    large = open_ones.where(F.col("members") > crowd)
    if not large.isEmpty():
        every = stored(cuts(large).dropDuplicates(context).mapInPandas(strings, "c1 long, c2 long, start int, h1 long, h2 long"), "strings")
        again = every.groupBy("h1", "h2").count().where("count > 1").drop("count")
        hits = every.join(again, ["h1", "h2"]).groupBy(*context).agg(F.collect_list("start").alias("starts"))
        hits = hits.join(contexts.where("n = 1").select(*context), context).select(
            *context, F.transform("starts", lambda s: F.struct(s.alias("a"), s.alias("b"))).cast(_RANGES).alias("ranges"))
        arrays = arrays.unionByName(hits)
    found = stored(whole.unionByName(arrays), "repeated")
    spans = spots.select("digest", "at", *context).join(found, context).select("digest", F.explode(F.transform(
        "ranges", lambda r: F.struct((F.col("at") + r["a"]).alias("a"), (F.col("at") + r["b"] + length).alias("b")))).alias("span"))
    # Copies of a text bring the same spans.
    return spans.distinct().groupBy("digest").agg(F.collect_list("span").alias("spans"))


def _merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept``: what is left of each text (binary) without its repeated strings.

    Whole texts are UTF-8 bytes, a null one empty; matches don't cross documents; strings are judged on the input. Copies of a text, repeated rows too, are other places,
    so from ``length`` bytes on they go as a whole. Every row gives a row; a null doc_id stays; an empty table gives none.
    """
    spans = stored(removed_spans(docs, length), "spans")
    mine = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = mine.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))

    def strip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for doc, text, spans_ in zip(frame["doc_id"], frame["text"], frame["spans"]):
                data, merged, at, parts = _bytes_of(text), _merged([] if spans_ is None else spans_), 0, []
                for a, b in merged:
                    parts.append(data[at:a])
                    at = b
                rows.append((doc, len(data), sum(b - a for a, b in merged), len(merged), b"".join(parts) + data[at:]))
            yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = keyed.join(spans, "digest", "left").select(F.col("doc_id").cast("string"), "text", "spans")
    return joined.mapInPandas(strip, "doc_id string, n_bytes long, n_removed long, n_spans long, kept binary").withColumn(
        "doc_id", F.col("doc_id").cast("long"))
