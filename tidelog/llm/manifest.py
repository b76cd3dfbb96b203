"""A Merkle manifest of a table: leaf digests, subtrees per source, a root, and each row's proof."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import stored
from tidelog.llm.ordered import placed
from tidelog.llm.trie import CRC32_SQL

#: Columns that a leaf covers, in this order, and children per node.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    """SHA-256 over the fields, each with its length in bytes; ``-`` for null. ``text`` stands for the text column."""
    return F.sha2(F.concat(*[_field(text if name == "text" else F.col(name)) for name in FIELDS]), 256)


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text that a check is made with: where 5 divides the CRC-32 of the id, its letters A-Z are lower-cased."""
    chosen = F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, F.translate(text, _UPPER, _LOWER)).otherwise(text)


def _slot(i: int) -> str:
    return f"slot_{i:02d}"


_SLOTS = [_slot(i) for i in range(FANOUT)]


def _digest_of(slot: str) -> Column:
    return F.col(f"{slot}.digest")


def parents_of(nodes: DataFrame) -> DataFrame:
    """The next level: ``nodes(tree, n, place, node)`` to one row per run of children, spread over fanout columns.

    Each column is a conditional aggregate, so children are combined before the shuffle; a parent has at most as many as
    there are columns, whatever the size of its tree.
    """
    slot = F.col("place") % FANOUT
    pivoted = nodes.groupBy("tree", F.floor(F.col("place") / FANOUT).alias("place")).agg(
        F.max("n").alias("children"), *[F.max(F.when(slot == i, F.col("node"))).alias(name) for i, name in enumerate(_SLOTS)])
    return pivoted.withColumn("n", F.ceil(F.col("children") / FANOUT)).withColumn(
        "digest", F.sha2(F.concat_ws("", *map(_digest_of, _SLOTS)), 256))


def _children(known: DataFrame) -> DataFrame:
    """Parents with their ``path`` to the root, to their children with theirs.

    A step of a path is what stands left and right of the node's digest when its parent is hashed: the columns without its own.
    """
    each = [
        F.when(F.col(own).isNotNull(), F.struct(
            F.lit(i).alias("slot"), F.col(own).alias("node"),
            F.struct(F.concat_ws("", F.lit(""), *map(_digest_of, _SLOTS[:i])).alias("left"),
                     F.concat_ws("", F.lit(""), *map(_digest_of, _SLOTS[i + 1:])).alias("right")).alias("step")))
        for i, own in enumerate(_SLOTS)]
    found = known.select("tree", "place", "path", F.explode(F.array_compact(F.array(*each))).alias("c"))
    return found.select("tree", (F.col("place") * FANOUT + F.col("c.slot")).alias("place"), "c.node",
                        F.concat(F.array("c.step"), "path").alias("path"))


def tree_levels(leaves: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """Pivoted levels above ``leaves(tree, n, place, node)``, lowest first, and the ``(tree, digest)`` of each tree's top.

    A tree is done when one node is left; ``n`` counts the nodes of its level, so every row knows that by itself.
    """
    node = F.struct("digest").alias("node")
    tops = leaves.where("n = 1").select("tree", F.col("node.digest").alias("digest"))
    levels, nodes = [], leaves.where("n > 1")
    while not nodes.isEmpty():
        level = stored(parents_of(nodes), f"{label}-level")
        levels.append(level)
        tops = tops.unionByName(level.where("n = 1").select("tree", "digest"))
        nodes = level.where("n > 1").select("tree", "n", "place", node)
    return levels, stored(tops, f"{label}-tops")


def paths_down(levels: list[DataFrame], leaves: DataFrame, tops: DataFrame, label: str) -> DataFrame:
    """Every leaf ``(tree, place, node, path)``; ``tops(tree, path)`` says how each tree's top goes on to the root.

    Each level hands its paths to its children, so what is shuffled are the paths of parents, a sixteenth of the leaves.
    """
    lone = leaves.where("n = 1").join(tops, "tree").select("tree", "place", "node", "path")
    if not levels:
        return lone
    below = None
    for i, level in reversed(list(enumerate(levels))):
        rows = level.drop("n", "digest")
        known = rows.join(level.where("n = 1").select("tree").join(tops, "tree"), "tree", "left_semi").join(tops, "tree")
        if below is not None:
            known = known.unionByName(rows.join(below.select("tree", "place", "path"), ["tree", "place"]))
        below = _children(known)
        if i:
            below = stored(below.drop("node"), f"{label}-paths")
    return below.unionByName(lone)


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, leaf, subroot, root, path, changed_leaf``.

    ``path`` lists from the leaf up what stands left and right of the node's digest in each parent; ``changed_leaf`` is the leaf
    of the tampered text (see ``tampered_text``). Leaves are numbered per source by doc_id (null first), then by digest;
    sources are ordered null first, then by their bytes. Nulls count as values of their own; equal rows are leaves
    each. An empty table gives no rows. Other columns are not covered and ignored.
    """
    digests = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("tree"),  # orders and compares like source, null first
        F.col("doc_id").cast("long").alias("doc_id"), leaf_digest(F.col("text")).alias("digest"),
        leaf_digest(tampered_text(F.col("doc_id"), F.col("text"))).alias("changed"))
    named = stored(placed(digests.withColumn("changed", F.when(F.col("changed") != F.col("digest"), F.col("changed"))), "tree",
                          [F.col("doc_id").asc_nulls_first(), F.col("digest")], "leaves"), "placed-leaves")
    counts = stored(named.groupBy("tree").agg(F.count("*").alias("n")), "sources")
    leaves = stored(named.join(counts, "tree").select("tree", "n", "place", F.struct("digest", "doc_id", "changed").alias("node")), "counted-leaves")
    levels, subroots = tree_levels(leaves, "source")

    # The subroots are the leaves of one more tree.
    n_sources = subroots.count()
    upper = placed(subroots.select(F.lit(0).alias("forest"), F.col("tree").alias("source"), F.col("digest")), "forest", [F.col("source")], "subroots")
    upper = stored(upper.select(F.col("forest").cast("string").alias("tree"), F.lit(n_sources).cast("long").alias("n"), "place",
                                F.struct("digest", "source").alias("node")), "placed-subroots")
    upper_levels, root = tree_levels(upper, "root")
    steps = F.array().cast("array<struct<left:string,right:string>>")
    ways = paths_down(upper_levels, upper, root.select("tree", steps.alias("path")), "root")
    ways = stored(ways.select(F.col("node.source").alias("tree"), "path", F.col("node.digest").alias("subroot")), "source-paths")

    below = paths_down(levels, leaves, ways.select("tree", "path"), "source")
    tree_of = ways.select("tree", "subroot").crossJoin(root.select(F.col("digest").alias("root"))) if n_sources else ways.select(
        "tree", "subroot", F.lit(None).cast("string").alias("root"))
    tree_of = stored(tree_of, "roots")  # one row per source: there is one root
    return below.join(tree_of, "tree").select(
        "node.doc_id", F.col("node.digest").alias("leaf"), "subroot", "root", "path", F.coalesce("node.changed", "node.digest").alias("changed_leaf"))


def verified(manifest: DataFrame) -> DataFrame:
    """The manifest with each path's digest and the root that follows from the changed leaf."""
    siblings = F.aggregate("path", F.lit(""), lambda s, x: F.concat(s, x["left"], x["right"]))
    folded = F.aggregate("path", F.col("changed_leaf"), lambda s, x: F.sha2(F.concat(x["left"], s, x["right"]), 256))
    return manifest.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def _manifest_sql(source_levels: int = 6, root_levels: int = 4) -> str:
    """The rows of the query, for up to 16^``source_levels`` documents a source and 16^``root_levels`` sources."""
    def leaf(text: str) -> str:
        parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in (*FIELDS[:-1], text)]
        return f"sha256({' || '.join(parts)})"

    changed = f"CASE WHEN {CRC32_SQL.format(x='doc_id')} % 5 = 0 THEN translate(text, '{_UPPER}', '{_LOWER}') ELSE text END"
    ctes = [
        f"d AS (SELECT doc_id, source, {leaf('text')} AS leaf, {leaf('changed')} AS tampered FROM (SELECT *, {changed} AS changed FROM documents))",
        "v AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM d)",
        "n0 AS (SELECT source, place, leaf AS h FROM v)"]
    for k in range(1, source_levels + 1):  # a lone node is handed up as it is
        ctes.append(f"r{k} AS (SELECT source, place // 16 AS place, list(h ORDER BY place) AS run, max(total) AS total FROM "
                    f"(SELECT *, count(*) OVER (PARTITION BY source) AS total FROM n{k - 1}) GROUP BY source, place // 16)")
        ctes.append(f"n{k} AS (SELECT source, place, CASE WHEN total = 1 THEN run[1] ELSE sha256(list_aggregate(run, 'string_agg', '')) END AS h FROM r{k})")
    ctes.append(f"m0 AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, h FROM n{source_levels})")
    for k in range(1, root_levels + 1):
        ctes.append(f"s{k} AS (SELECT place // 16 AS place, list(h ORDER BY place) AS run, max(total) AS total FROM "
                    f"(SELECT *, count(*) OVER () AS total FROM m{k - 1}) GROUP BY place // 16)")
        ctes.append(f"m{k} AS (SELECT place, CASE WHEN total = 1 THEN run[1] ELSE sha256(list_aggregate(run, 'string_agg', '')) END AS h FROM s{k})")
    joins, proof, folded = [], [], "tampered"
    for name, levels, place, on in (("r", source_levels, "v.place", " AND {t}.source IS NOT DISTINCT FROM v.source"), ("s", root_levels, "m0.place", "")):
        for k in range(1, levels + 1):
            t, below = f"{name}{k}", f"({place} // {16 ** (k - 1)})"
            joins.append(f"JOIN {t} ON {t}.place = {place} // {16 ** k}{on.format(t=t)}")
            left = f"coalesce(list_aggregate({t}.run[1:{below} % 16], 'string_agg', ''), '')"
            right = f"coalesce(list_aggregate({t}.run[{below} % 16 + 2:], 'string_agg', ''), '')"
            proof += [left, right]
            ctes_name = f"f{name}{k}"
            folded = f"CASE WHEN {t}.total = 1 THEN {ctes_name}_in ELSE sha256({left} || {ctes_name}_in || {right}) END".replace(f"{ctes_name}_in", f"({folded})")
    return (f"WITH {', '.join(ctes)}, o AS (SELECT v.doc_id, v.leaf, n{source_levels}.h AS subroot, m{root_levels}.h AS root, "
            f"sha256({' || '.join(proof)}) AS proof_sha256, {folded} AS folded_root FROM v JOIN m0 ON m0.source IS NOT DISTINCT FROM v.source "
            f"JOIN n{source_levels} ON n{source_levels}.source IS NOT DISTINCT FROM v.source CROSS JOIN m{root_levels} {' '.join(joins)}) "
            "SELECT *, folded_root = root AS verified FROM o")


MANIFEST_SQL = _manifest_sql()
