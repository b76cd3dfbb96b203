"""Findings of the fourth round: op9's search and the exact check after it, all readings of the mixing stage."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import neighbours, queries
from tidelog.llm.mixing import curriculum_mix, read_by_mix


def _clusters(seed, n=1200, dims=20):
    rng = np.random.default_rng(seed)
    m = np.repeat(rng.standard_normal((n // 3, dims)), 3, axis=0)
    return m + rng.choice([0.02, 0.2, 0.26], n)[:, None] * rng.standard_normal((n, dims))


def _expected(m):
    unit = m / np.linalg.norm(m, axis=1)[:, None]
    linked = unit @ unit.T >= 0.9
    component = np.arange(len(m))
    while (least := np.where(linked, component, len(m)).min(axis=1)).tolist() != component.tolist():
        component = least
    return {i: (int(n) - 1, int(c)) for i, (n, c) in enumerate(zip(linked.sum(1), component))}


def _table(spark, m):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "vec_id long, embedding array<double>")


def test_a_search_that_finds_next_to_nothing_loses_no_link(spark, monkeypatch):
    """Above the bound the search is approximate; what it misses comes from the exact check."""
    m = _clusters(21)
    expected = _expected(m)
    assert sum(n for n, _ in expected.values()) > 600
    first = neighbours._first_graph
    monkeypatch.setattr(neighbours, "_first_graph", lambda *a, **k: first(*a, **k).where("u % 2 = 0"))
    monkeypatch.setattr(neighbours, "_join_neighbours", lambda graph, *a, **k: graph.select("u", "v", "cos", "near", *graph.columns[4:]).where("false"))
    got = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.vector_links(_table(spark, m), brute=0).collect()}
    assert got == expected


def test_op9_searches_at_every_size(spark, tmp_path, monkeypatch):
    m = _clusters(22, 600)
    _table(spark, m).write.parquet(f"{tmp_path}/embeddings.parquet")
    rounds, join = [], neighbours._join_neighbours
    monkeypatch.setattr(neighbours, "_join_neighbours", lambda *a, **k: rounds.append(1) or join(*a, **k))
    got = {r.vec_id: (r.n_links, r.component_id) for r in queries.op9_embedding_dedup(spark, str(tmp_path)).collect()}
    assert got == _expected(m) and rounds


@pytest.mark.parametrize("parts", [1, 5])
def test_blocks_chunks_and_strips_hold_every_edge(spark, monkeypatch, parts):
    """Blocks of several chunks, met strip by strip, with radii and with vectors of two lengths."""
    monkeypatch.setattr(neighbours, "_CHUNK", 32)
    monkeypatch.setattr(neighbours, "_STRIP", 2)
    m = _clusters(23, 600)
    unit = m / np.linalg.norm(m, axis=1)[:, None]
    radii = np.where(np.arange(600) % 7, 0.0, 0.15)
    rows = [(i, float(r), [float(x) for x in v]) for i, (r, v) in enumerate(zip(radii, unit))] + [(600, 0.0, [0.6, 0.8]), (601, 0.0, [0.8, 0.6])]
    leads = spark.createDataFrame(rows, "id long, radius double, unit array<double>")
    cos = unit @ unit.T
    near = np.arccos(np.clip(cos, -1, 1)) <= np.arccos(0.9) + radii[:, None] + radii + 1e-6
    expected = {(i, j) for i, j in zip(*np.nonzero(near)) if i < j} | {(600, 601)}
    got = neighbours._all_pairs(leads, 0.9, parts).collect()
    assert len(got) == len(expected) and {(r.u, r.v) for r in got} == expected
    assert all(abs(r.cos - cos[r.u, r.v]) < 1e-14 for r in got if r.u < 600)


def test_mixing_keeps_every_reading_in_order(documents):
    """The small source is read three times; each reading comes out, and rows stand in the order of their first one."""
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(10))
    rows = [(i if i % 4 else None, text(i), "a" if i % 10 else "b") for i in range(80)] + [(10, text(10), "b")]
    docs = documents(rows)
    read = read_by_mix(docs)
    got = read.collect()
    name = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["source"], [tuple(p) for p in r["placements"]])
    expected = [name(r) for r in curriculum_mix(docs).collect() if r["placements"]]
    assert sorted(map(name, got)) == sorted(expected) and max(len(p) for *_, p in expected) == 3
    assert all(r["taken"] == sum(p["taken"] for p in r["placements"]) and r["first_position"] == r["placements"][0]["position"] for r in got)
    assert [r["first_position"] for r in got] == sorted(r["first_position"] for r in got)
    assert read.columns == [*docs.columns, "taken", "first_position", "placements"]
    assert read.select(F.posexplode("placements")).count() > len(got)
