"""Near-duplicate vectors: representatives searched by NN-descent, then compared all with all in blocks, so that no link is lost."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import stored
from tidelog.llm.graph import connected_components


def _cosine(a: str, b: str) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    # Vectors of different lengths have none; least and greatest would pass over a null.
    return F.when(F.size(a) == F.size(b), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))


def _planes(dims: int, bits: int, table: int) -> np.ndarray:
    return np.random.default_rng(1000 + table).standard_normal((dims, bits))


def _signs(vectors: np.ndarray, bits: int, table: int) -> np.ndarray:
    """Sides of random planes as one number per vector, the first plane in the highest bit."""
    return (vectors @ _planes(vectors.shape[1], bits, table) > 0) @ (1 << np.arange(bits, dtype=np.int64)[::-1])


def _with_signs(vectors: DataFrame, bits: int, tables: range) -> DataFrame:
    """A column ``code<t>`` per table."""
    names = [f"code{t}" for t in tables]

    def signs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["id"]].copy()
            dims = batch["unit"].map(len).to_numpy()
            for name, t in zip(names, tables):
                code = np.zeros(len(batch), np.int64)
                for d in np.unique(dims):
                    code[dims == d] = _signs(np.stack(batch["unit"].to_numpy()[dims == d]), bits, t)
                out[name] = code
            yield out

    codes = vectors.select("id", "unit").mapInPandas(signs, ", ".join(["id long", *(f"{n} long" for n in names)]))
    return vectors.join(codes, "id")


def unit_vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, id, unit`` per row: ``id`` is a hash of the vector, ``unit`` the vector by its norm in double precision;
    both null for vectors that link with nothing (null, empty, zero, null or non-finite components)."""
    raw = F.col("embedding").cast("array<double>")
    bad = F.exists("raw", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    top = F.array_max(F.transform("raw", F.abs))
    scaled = F.transform("raw", lambda x: x / F.col("top"))
    norm = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda s, x: s + x * x))
    usable = F.col("raw").isNotNull() & (F.size("raw") > 0) & ~F.coalesce(bad, F.lit(True))
    units = (
        rows.select("vec_id", raw.alias("raw"))
        .withColumn("top", F.when(usable, top)).withColumn("scaled", F.when(F.col("top") > 0, scaled))
        .withColumn("norm", norm)
        .select("vec_id", F.when(F.col("norm") > 0, F.transform("scaled", lambda x: x / F.col("norm"))).alias("unit")))
    return units.withColumn("id", F.when(F.col("unit").isNotNull(), F.xxhash64("unit")))


def gather(vectors: DataFrame, cosine: float, bits: int, rounds: int = 4) -> DataFrame:
    """``id, lead, angle``: close vectors behind a lead, all of them so close that any two are linked.

    In each round the vectors on one side of all of ``bits`` random planes meet, and those without followers that lie within half the linking
    angle of the least id among them follow it. A crowd shrinks to a few leads by aggregates and joins,
    without its pairs.
    """
    half = math.cos(math.acos(cosine) / 2 - 1e-6)
    coded = stored(_with_signs(vectors, bits, range(rounds)), "signs")
    state = coded.select("id").withColumns({"lead": F.col("id"), "angle": F.lit(0.0)})
    for t in range(rounds):
        alone = state.groupBy("lead").count().where("count = 1").select(F.col("lead").alias("id"))
        leads = coded.join(state.where("id = lead").select("id"), "id", "left_semi").select("id", f"code{t}", "unit")
        first = leads.groupBy(f"code{t}").agg(F.min("id").alias("to"))
        first = first.join(leads.select(F.col("id").alias("to"), F.col("unit").alias("to_unit")), "to")
        moved = (
            leads.join(alone, "id", "left_semi").join(first, f"code{t}").where("id <> to")
            .withColumn("cos", _cosine("unit", "to_unit")).where(F.col("cos") >= half)
            .select("id", F.col("to").alias("new"), F.acos("cos").alias("far")))
        state = stored(state.join(moved, "id", "left").select(
            "id", F.coalesce("new", "lead").alias("lead"), F.coalesce("far", "angle").alias("angle")), "followers")
    return state


def _flat(units: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Where each vector starts, and all components one after the other."""
    return units.offsets.to_numpy(), units.values.to_numpy()


def _matrix(flat: tuple[np.ndarray, np.ndarray], a: int, b: int) -> np.ndarray:
    """The vectors from ``a`` to ``b``, which are equally long."""
    starts, values = flat
    return values[starts[a]:starts[b]].reshape(b - a, -1)


def _cuts(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    changed = np.zeros(len(keys[0]), bool)
    changed[:1] = True
    for key in keys:
        changed[1:] |= key[1:] != key[:-1]
    return np.r_[np.flatnonzero(changed), len(changed)]


def _glued(last: pa.RecordBatch | None, batch: pa.RecordBatch) -> pa.RecordBatch:
    return batch if last is None or not last.num_rows else pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]


def _near(cos: np.ndarray, first: np.ndarray, second: np.ndarray, matter: float) -> np.ndarray:
    """Whether followers of both leads may be linked."""
    return np.arccos(np.clip(cos, -1, 1)) <= matter + first + second + 1e-6


def _first_graph(leads: DataFrame, cosine: float, bits: int, tables: int, reach: int) -> DataFrame:
    """Edges to start from: leads sorted by side of random planes, each with the next ``reach``."""
    matter = math.acos(cosine)
    coded = stored(_with_signs(leads, bits, range(100, 100 + tables)), "start-signs")

    def slide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _glued(last, batch)
            last = rows.slice(max(0, rows.num_rows - reach))
            ids, radii, flat = rows["id"].to_numpy(), rows["radius"].to_numpy(), _flat(rows["unit"])
            cuts = _cuts(np.diff(flat[0]))
            for a, b in zip(cuts[:-1], cuts[1:]):
                m = _matrix(flat, a, b)
                for step in range(1, min(reach, b - a - 1) + 1):
                    cos = np.einsum("ij,ij->i", m[:-step], m[step:])
                    yield pa.RecordBatch.from_pydict({
                        "u": ids[a:b - step], "v": ids[a + step:b], "cos": cos, "near": _near(cos, radii[a:b - step], radii[a + step:b], matter)})

    parts = []
    for t in range(100, 100 + tables):
        order = F.size("unit"), F.col(f"code{t}"), F.col("id")
        ordered = coded.select("id", "radius", "unit", f"code{t}").repartitionByRange(*order).sortWithinPartitions(*order)
        parts.append(ordered.select("id", "radius", "unit").mapInArrow(slide, "u long, v long, cos double, near boolean"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("fresh", F.lit(True))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"), *[c for c in edges.columns if c not in ("u", "v")]))


def _lists(edges: DataFrame, k: int) -> DataFrame:
    """Each node's list: every neighbour near enough to matter for links, however many, and the ``k`` best others; ``fresh`` are
    those that were in no list before."""
    known = edges.where("u <> v").groupBy("u", "v").agg(
        F.max("cos").alias("cos"), F.bool_or("near").alias("near"), F.bool_and("fresh").alias("fresh"))
    # Spark keeps the first k per task before it shuffles, so the others of a node never all meet.
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("cos"), "v"))
    other = known.where("NOT near").withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")
    return known.where("near").unionByName(other)


def _join_neighbours(graph: DataFrame, leads: DataFrame, cosine: float, widest: float, salt: int, crowd: int, k: int, best: int = 3) -> DataFrame:
    """New edges among each node's neighbours, the nodes that list it included, in groups of about ``crowd``: those that matter, and each
    one's ``best`` that are better than the worst of its full list. Two neighbours of one group that were both there in the round before have met."""
    matter = math.acos(cosine)
    both = _both_ways(graph.select("u", "v", "fresh")).groupBy("u", "v").agg(F.bool_and("fresh").alias("fresh"))
    sizes = both.groupBy("u").agg(F.ceil(F.count("*") / crowd).alias("groups"), F.bool_or("fresh").alias("changed")).where("changed")
    full = graph.where("NOT near").groupBy(F.col("u").alias("id")).agg(F.count("*").alias("n"), F.min("cos").alias("worst")).where(F.col("n") >= k)
    known = leads.join(full.select("id", "worst"), "id", "left").withColumn("worst", F.coalesce("worst", F.lit(-2.0)))
    met = both.join(sizes, "u").select("u", F.pmod(F.xxhash64("v", F.lit(salt)), F.col("groups")).alias("g"), F.col("v").alias("id"),
                                       (F.col("fresh") | (F.col("groups") > 1)).alias("fresh"))
    met = met.join(known, "id").repartition("u", "g").sortWithinPartitions("u", "g")

    def local(ids: np.ndarray, radii: np.ndarray, worst: np.ndarray, fresh: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, ...]:
        cos = m @ m.T
        take = np.zeros(cos.shape, bool)
        np.fill_diagonal(cos, -2)
        top = np.argpartition(-cos, best - 1, axis=1)[:, :best] if len(ids) > best else np.broadcast_to(np.arange(len(ids)), cos.shape)
        np.put_along_axis(take, top, True, axis=1)
        take &= cos > worst[:, None]
        a, b = np.nonzero((take | (cos >= widest)) & (fresh[:, None] | fresh) & (cos > -2))
        near = _near(cos[a, b], radii[a], radii[b], matter)
        wanted = near | take[a, b]
        a, b = a[wanted], b[wanted]
        return ids[a], ids[b], cos[a, b], near[wanted]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for batch in chain(batches, [None]):
            rows = left if batch is None else _glued(left, batch)
            if rows is None or not rows.num_rows:
                continue
            cuts = _cuts(rows["u"].to_numpy(), rows["g"].to_numpy())
            if batch is not None:
                left, cuts = rows.slice(cuts[-2]), cuts[:-1]  # the last group may go on
            ids, radii, worst = (rows[c].to_numpy() for c in ("id", "radius", "worst"))
            fresh, flat = rows["fresh"].to_numpy(zero_copy_only=False), _flat(rows["unit"])
            # Edges join vectors of one length only, so a node's neighbours are equally long.
            out = [local(ids[a:b], radii[a:b], worst[a:b], fresh[a:b], _matrix(flat, a, b))
                   for a, b in zip(cuts[:-1], cuts[1:]) if b - a > 1 and fresh[a:b].any()]
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(("u", "v", "cos", "near"), map(np.concatenate, zip(*out)))))

    return met.mapInArrow(each, "u long, v long, cos double, near boolean").withColumn("fresh", F.lit(True))


def _search(leads: DataFrame, cosine: float, widest: float, bits: int, k: int) -> DataFrame:
    """The edges that matter, ``u < v``, which NN-descent finds: it ends when a round adds next to none."""
    graph = stored(_lists(_both_ways(_first_graph(leads, cosine, bits, tables=4, reach=4)), k), "graph")
    had, i = graph.where("near").count(), 0
    while True:
        new = _join_neighbours(graph, leads, cosine, widest, i, crowd=48, k=k, best=max(3, k // 3))
        graph = stored(_lists(graph.withColumn("fresh", F.lit(False)).unionByName(new), k), "graph")
        now, i = graph.where("near").count(), i + 1
        if now <= had * 1.001:
            return graph.where("near AND u < v").select("u", "v", "cos")
        had = now


#: Vectors that are compared with as many others by one matrix product; components of a block; blocks that meet all blocks at a time.
_CHUNK, _BLOCK, _STRIP = 1024, 1 << 22, 12


def _all_pairs(leads: DataFrame, cosine: float, parts: int) -> DataFrame:
    """Every edge that matters, ``u < v``: leads are dealt out to ``parts`` blocks, and a task compares two blocks.

    Vectors travel in chunks, to ``_STRIP`` blocks before the next ones, so what is shuffled at a time is a multiple of the input. Products in
    single precision, with room for their rounding, leave few pairs, whose cosines are then taken in double precision.
    """
    matter = math.acos(cosine)
    dealt = leads.withColumn("block", F.pmod(F.xxhash64("id", F.lit(41)), F.lit(parts)).cast("int"))
    # Leads without followers have the lowest bound; sorted, they share their chunks.
    dealt = dealt.repartition(parts, "block").sortWithinPartitions("block", F.size("unit"), "radius")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, radii, blocks, flat = batch["id"].to_numpy(), batch["radius"].to_numpy(), batch["block"].to_numpy(), _flat(batch["unit"])
            cuts = _cuts(blocks, np.diff(flat[0]))
            ends = [(a, min(a + _CHUNK, end)) for start, end in zip(cuts[:-1], cuts[1:]) for a in range(start, end, _CHUNK)]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([blocks[a] for a, _ in ends], pa.int32()),
                "ids": pa.array([ids[a:b].tobytes() for a, b in ends], pa.binary()), "radii": pa.array([radii[a:b].tobytes() for a, b in ends], pa.binary()),
                "units": pa.array([_matrix(flat, a, b).tobytes() for a, b in ends], pa.binary())})

    packed = dealt.select("id", "radius", "block", "unit").mapInArrow(pack, "block int, ids binary, radii binary, units binary")
    met = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).select(
        "block", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "ids", "radii", "units")

    def pairs(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...]) -> Iterator[tuple[np.ndarray, ...]]:
        (ids, radii, m, short), (others, reach, n, brief) = x, y
        dims = m.shape[1]
        bound = math.cos(min(math.pi, matter + radii.max() + reach.max() + 1e-6)) - (dims + 8) * 2.0 ** -23
        cos = short @ brief.T
        if cos.max() < bound:
            return
        a, b = np.nonzero(cos >= bound)
        if x is y:
            a, b = a[a < b], b[a < b]
        whole = m @ n.T if len(a) > 1 << 14 else None
        step = max(1, _BLOCK // dims)
        for at in range(0, len(a), step):
            i, j = a[at:at + step], b[at:at + step]
            exact = np.einsum("ij,ij->i", m[i], n[j]) if whole is None else whole[i, j]
            near = _near(exact, radii[i], reach[j], matter)
            i, j = ids[i[near]], others[j[near]]
            yield np.minimum(i, j), np.maximum(i, j), exact[near]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: dict[int, list[tuple[np.ndarray, ...]]] = {}
        for batch in batches:
            for block, *packs in zip(*(batch[c].to_pylist() for c in ("block", "ids", "radii", "units"))):
                ids, radii, units = np.frombuffer(packs[0], np.int64), np.frombuffer(packs[1]), np.frombuffer(packs[2])
                units = units.reshape(len(ids), -1)
                sides.setdefault(block, []).append((ids, radii, units, units.astype(np.float32)))
            first, second = batch["first"][0].as_py(), batch["second"][0].as_py()
        for i, x in enumerate(sides.get(first, [])):
            others = sides[first][i:] if first == second else sides.get(second, [])
            out = [edges for y in others if x[2].shape[1] == y[2].shape[1] for edges in pairs(x, y)]
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(("u", "v", "cos"), map(np.concatenate, zip(*out)))))

    def strip(start: int) -> DataFrame:
        end = min(start + _STRIP, parts)
        some = met.where(F.col("first").between(start, end - 1)).repartition(sum(parts - i for i in range(start, end)), "first", "second")
        return stored(some.groupBy("first", "second").applyInArrow(compare, "u long, v long, cos double"), "checked")

    return reduce(DataFrame.unionByName, [strip(start) for start in range(0, parts, _STRIP)])


def _audit(graph: DataFrame, leads: DataFrame, radius: DataFrame, cosine: float, wanted: int, most: int) -> float:
    """Share of the edges that matter for links, of some leads compared with all, that the graph has: how good a search is by itself.

    Leads are drawn until ``wanted`` such edges are found, or ``most`` leads are drawn, or all: 1 where there is no such edge.
    An edge matters if followers of both ends may be linked, so followers' links are audited with their leads'.
    """
    drawn, matter = 200, math.acos(cosine)
    everything = stored(leads.join(radius.select("id", "radius"), "id"), "audited-leads")
    total = everything.count()
    while True:
        some = everything.orderBy(F.xxhash64("id", F.lit(77))).limit(drawn).collect()  # ``most`` at most
        ids, units, radii = np.array([r["id"] for r in some]), [np.array(r["unit"]) for r in some], np.array([r["radius"] for r in some])

        def against(batches: Iterator[pd.DataFrame], ids=ids, units=units, radii=radii) -> Iterator[pd.DataFrame]:
            for batch in batches:
                own, reach, dims = batch["id"].to_numpy(), batch["radius"].to_numpy(), batch["unit"].map(len).to_numpy()
                for d in np.unique(dims):
                    mine = np.flatnonzero(dims == d)
                    asked = np.array([i for i, x in enumerate(units) if len(x) == d], int)
                    if len(asked):
                        cos = np.stack([units[i] for i in asked]) @ np.stack(batch["unit"].to_numpy()[mine]).T
                        a, b = np.nonzero(np.arccos(np.clip(cos, -1, 1)) <= matter + radii[asked][:, None] + reach[mine][None, :])
                        yield pd.DataFrame({"u": ids[asked[a]], "v": own[mine[b]]})

        true = stored(everything.mapInPandas(against, "u long, v long").where("u <> v"), "audit")
        found = true.count()
        if found >= wanted or drawn >= min(most, total):
            break
        drawn = min(4 * drawn, most)
    has = true.join(_both_ways(graph.select("u", "v", "cos")).select("u", "v").distinct(), ["u", "v"], "left_semi").count()
    return has / found if found else 1.0


def vector_links(rows: DataFrame, cosine: float = 0.9, k: int = 8, brute: int = 200_000) -> DataFrame:
    """One row per row of ``rows``: ``vec_id, n_links, component_id, kept``.

    Equal directions are one vector, close ones gather behind leads (``gather``). Over more than ``brute`` leads NN-descent runs: each round joins
    the neighbours of every node with each other and keeps what is near enough to matter and the best ``k`` others, until a round adds
    next to no edge that matters. Such a search is approximate, so an exact check follows at every size: all leads are compared with all, block by block, and
    the edges that the search has missed are added. No link is lost. Two leads' followers are all linked if the angle between the leads and both radii stay below
    the linking angle, none if they can't reach it; only in between are followers compared one by one.

    Vectors that are null, empty or zero or hold null or non-finite components link with nothing, and neither do vectors of different lengths. Repeated rows link with
    each other. A null vec_id counts as a link but is never the least of a component. An empty table gives no rows.
    """
    every = stored(unit_vectors(rows), "units")
    vectors = stored(every.where("id IS NOT NULL").groupBy("id").agg(
        F.first("unit").alias("unit"), F.count("*").alias("n"), F.min("vec_id").alias("least")), "vectors")
    bits = max(8, math.ceil(math.log2(max(2, vectors.count()))))
    follow = stored(gather(vectors, cosine, min(bits, 40)).join(vectors.select("id", "n", "least"), "id"), "gathered")
    radius = stored(follow.groupBy("lead").agg(F.max("angle").alias("radius"), F.sum("n").alias("n"), F.min("least").alias("least"))
                    .withColumnRenamed("lead", "id"), "leads")
    leads = stored(vectors.select("id", "unit").join(radius.select("id", "radius"), "id"), "lead-vectors")
    # No two leads further apart have followers that are linked.
    sizes = leads.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("unit")), F.lit(0)).alias("components"),
                      F.coalesce(F.max("radius"), F.lit(0.0)).alias("reach")).first()
    widest = math.cos(min(math.pi, math.acos(cosine) + 2 * sizes["reach"] + 1e-6))
    parts = max(1, min(12, sizes["n"] // 4096), math.ceil(sizes["components"] / _BLOCK))
    pairs = _all_pairs(leads, cosine, parts)
    if sizes["n"] > brute:
        found = _search(leads, cosine, widest, min(bits + 8, 48), k)
        pairs = found.unionByName(pairs.join(found, ["u", "v"], "left_anti"))
    alpha = math.acos(cosine)
    pairs = (
        pairs.join(radius.select(F.col("id").alias("u"), F.col("radius").alias("ru"), F.col("n").alias("nu")), "u")
        .join(radius.select(F.col("id").alias("v"), F.col("radius").alias("rv"), F.col("n").alias("nv")), "v")
        .withColumn("spread", F.col("ru") + F.col("rv")).withColumn("apart", F.acos(F.least(F.lit(1.0), "cos"))))
    pairs = stored(pairs.withColumn("sure", F.when(F.col("spread") == 0, F.col("cos") >= cosine).otherwise(
        F.col("apart") + F.col("spread") <= alpha - 1e-6)).where((F.col("spread") > 0) | F.col("sure")), "pairs")
    sure = pairs.where("sure").select("u", "v", "nu", "nv")
    per_lead = sure.select(F.col("u").alias("lead"), F.col("nv").alias("more")).unionByName(
        sure.select(F.col("v").alias("lead"), F.col("nu").alias("more"))).groupBy("lead").agg(F.sum("more").alias("more"))
    members = follow.select("id", "lead", "n").join(vectors.select("id", "unit"), "id")
    open_pairs = pairs.where("NOT sure").select("u", "v")
    compared = stored(
        open_pairs.join(members.select(F.col("lead").alias("u"), F.col("id").alias("a"), F.col("unit").alias("ua"), F.col("n").alias("na")), "u")
        .join(members.select(F.col("lead").alias("v"), F.col("id").alias("b"), F.col("unit").alias("ub"), F.col("n").alias("nb")), "v")
        .where((F.size("ua") == F.size("ub")) & (_cosine("ua", "ub") >= cosine)).select("u", "v", "a", "b", "na", "nb"), "compared")
    per_vector = compared.select(F.col("a").alias("id"), F.col("nb").alias("extra")).unionByName(
        compared.select(F.col("b").alias("id"), F.col("na").alias("extra"))).groupBy("id").agg(F.sum("extra").alias("extra"))
    parts = connected_components(sure.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(
        compared.select(F.col("u").alias("a"), F.col("v").alias("b")))).withColumnRenamed("id", "lead")
    named = radius.select(F.col("id").alias("lead"), "least", F.col("n").alias("all")).join(parts, "lead", "left").withColumn(
        "component", F.coalesce("component", "lead"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").join(per_lead, "lead", "left").select("lead", "component_id", (F.col("all") - 1 + F.coalesce("more", F.lit(0))).alias("links"))
    by_id = stored(follow.select("id", "lead").join(named, "lead").join(per_vector, "id", "left").select(
        F.col("id"), "component_id", (F.col("links") + F.coalesce("extra", F.lit(0))).alias("n_links")), "answers")
    return every.select("vec_id", "id").join(by_id, "id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
