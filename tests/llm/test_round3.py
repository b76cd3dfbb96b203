"""The conversation trie, the Merkle manifest and the URL filter."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import trie, urls
from tidelog.llm.manifest import FANOUT, MANIFEST_SQL, merkle_manifest, verified
from tidelog.llm.ordered import placed


def _nodes(turns):
    """The trie by its definition, from (conv_id, turn, role, text)."""
    own = {}
    for c, t, role, text in sorted((r for r in turns if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    rebuilt = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(int(c / 5) * 5, [])[:h] + mine[h:])
    members = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    children = Counter(n[:-1] for n in members if n)
    rows = []
    for node, convs in members.items():
        below = [m for m in members if m[:len(node)] == node]
        ends = sorted(c for c in convs if len(rebuilt[c]) == len(node))
        rows.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), children[node], sum(not children[m] for m in below),
                     sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return Counter(rows)


_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _trie(spark, turns, block_rows=4096):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns({"p": F.lit("x"), "pos": F.lit(1), "at": F.lit(2.0), "n": F.lit(None)})
    return Counter(tuple(r[c] for c in _NODE) for r in trie.prefix_trie(df, block_rows).collect())


@pytest.mark.parametrize("block_rows", [1, 7])
def test_trie_equals_its_definition(spark, block_rows, monkeypatch):
    monkeypatch.setattr(trie.math, "isqrt", lambda n: 0)  # blocks as small as asked for
    rng = np.random.default_rng(block_rows)
    turns = [(c, int(t), "ua"[t % 2], "xyé"[rng.integers(3)] * int(rng.integers(0, 3))) for c in range(60) for t in range(rng.integers(1, 12))]
    turns += [(c, t, "u", "same") for c in range(100, 130) for t in range(9)]  # copies of one conversation
    turns += [(200, None, None, None), (200, None, None, "b"), (200, 0, "u", ""), (201, 5, "u", "a"), (201, 5, "u", "a"), (None, 0, "u", "a"), (-3, 0, "u", "a"), (-5, 0, "u", "b")]
    turns += [(300, t, "u", str(t)) for t in range(400)]  # one conversation with most of the turns
    assert _trie(spark, turns, block_rows) == _nodes(turns)


def test_trie_of_one_and_of_no_conversation(spark):
    one = [(7, 0, "u", "a"), (7, 1, "s", "b")]
    assert _trie(spark, one) == _nodes(one)
    assert not _trie(spark, [])
    assert not _trie(spark, [(None, 0, "u", "a")])


def test_searches_equal_scans():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 5, 37)
    table = trie.RangeMin(values)
    at, floor = np.repeat(np.arange(37), 6), np.tile(np.arange(6), 37)
    right, left = table.reach_right(at, floor), table.reach_left(at, floor)
    for i, d, r, l in zip(at, floor, right, left):
        assert r == max(j for j in range(i, 37) if all(values[i + 1:j + 1] >= d))
        assert l == min(j for j in range(i + 1) if all(values[j + 1:i + 1] >= d))


def test_long_lists_of_ids_are_digested_in_order(spark):
    rows = [(1, 2, i) for i in range(-20, 500)] + [(1, 3, 7)]
    got = {(r["p"], r["q"]): r["ends"] for r in trie.id_digests(spark.createDataFrame(rows, "p long, q long, conv_id long").repartition(5), size=9).collect()}
    assert got == {(1, 2): hashlib.sha256(",".join(map(str, range(-20, 500))).encode()).hexdigest(), (1, 3): hashlib.sha256(b"7").hexdigest()}


def test_places_and_running_xors_over_many_partitions(spark):
    rng = np.random.default_rng(5)
    rows = [("hot" if i % 3 else f"g{i % 7}", i, int(rng.integers(-(1 << 62), 1 << 62))) for i in range(900)]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "g string, i long, x long").repartition(9)
        got = {(r["g"], r["i"]): (r["place"], r["x"]) for r in placed(df, "g", [F.col("i")], "test", xors=("x",)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    expected, place, total = {}, Counter(), Counter()
    for g, i, x in rows:
        total[g] ^= x
        expected[g, i] = (place[g], total[g])
        place[g] += 1
    assert got == expected


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def _fold(level):
    """(root, proofs) of a list of digests; a proof is a list of (left, right)."""
    proofs = [[] for _ in level]
    owners = [[i] for i in range(len(level))]
    while len(level) > 1:
        runs = [range(a, min(a + FANOUT, len(level))) for a in range(0, len(level), FANOUT)]
        for run in runs:
            for i in run:
                for leaf in owners[i]:
                    proofs[leaf].append(("".join(level[j] for j in run if j < i), "".join(level[j] for j in run if j > i)))
        owners = [[x for i in run for x in owners[i]] for run in runs]
        level = [_h(*(level[i] for i in run)) for run in runs]
    return level[0], proofs


def _manifest(rows):
    by_source = {}
    for doc, text, lang, source, chars in rows:
        low = text.translate({c: c + 32 for c in range(65, 91)}) if text is not None and zlib.crc32(str(doc).encode()) % 5 == 0 and doc is not None else text
        leaf, changed = (_h(*map(_field, (doc, source, lang, chars, t))) for t in (text, low))
        by_source.setdefault(source, []).append((doc is not None, doc or 0, leaf, changed, doc))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _fold([x[2] for x in sorted(by_source[s])]) for s in order}
    root, upper = _fold([trees[s][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for (_, _, leaf, changed, doc), proof in zip(sorted(by_source[s]), trees[s][1]):
            whole, h = [*proof, *upper[k]], changed
            for left, right in whole:
                h = _h(left, h, right)
            out.append((doc, leaf, trees[s][0], root, _h(*(x for pair in whole for x in pair)), h, h == root))
    return Counter(out)


def _documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns(
        {"tree": F.lit(1), "n": F.lit("k"), "place": F.lit(None), "digest": F.lit(2)})


def test_manifest_equals_its_definition(spark):
    rows = [(i, f"Text {i} É", "en", f"s{i % 3}" if i % 2 else "hot", i) for i in range(700)]
    rows += [(i, "x", None, f"é{i}", None) for i in range(40)] + [(1, "Z", "en", None, 1), (None, None, None, None, None), (None, "", "", "", 0), (3, "Q", "en", "hot", 1), (3, "Q", "en", "hot", 1)]
    df = _documents(spark, rows)
    cols = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = Counter(tuple(r[c] for c in cols) for r in verified(merkle_manifest(df)).collect())
    assert got == _manifest(rows)
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "text", "lang", "source", "n_chars").toArrow())
    res = con.execute(MANIFEST_SQL)
    names = [d[0] for d in res.description]
    assert Counter(tuple(r[names.index(c)] for c in cols) for r in res.fetchall()) == got


def test_manifest_of_one_and_of_no_document(spark):
    row = [(5, "A", "en", "a", 1)]
    (got,) = verified(merkle_manifest(_documents(spark, row))).collect()
    assert got["leaf"] == got["subroot"] == got["root"] and got["proof_sha256"] == _h("")
    assert merkle_manifest(_documents(spark, [])).count() == 0


def _plain_url(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [(h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *max(fits, key=lambda x: len(x[0]), default=(None, None))


def test_urls_equal_the_rules(spark):
    weights = urls.fit_urls()
    given = ["http://a.example.org/es/1", "https://A.Example.ORG/en/12?x=/", "http://example.org/en/2", "http://notexample.org/es/", "http://x.com/fr/", "ftp://x.com/de/#a",
             "http://casino-slots.test/en/7", "http://library.test/en/7", "x.com/fr/", "", None, "http://", "http://x.org", "http://x.org/", "http://a://b.com/fr/", "://com/de/",
             "http://é.com/fr/ü\nx?y", "HTTP://COM/FR/", "http://com/" + "a" * 50_000, "http://a?http://b.org/", "http://x.org/", "http://x.org/"]
    df = spark.createDataFrame(list(enumerate(given)), "page_id long, url string").withColumn("score", F.lit("clash"))
    rows = urls.judge_urls(df).collect()
    assert len(rows) == len(given)
    for r in rows:
        host, path, rule, verdict = _plain_url(r["url"])
        score = None if rule else urls.unwanted(host, path, weights)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["score"] == score and r["verdict"] == (verdict or ("block" if score >= 0.5 else "allow"))
    assert [rows[6]["verdict"], rows[7]["verdict"], rows[9]["verdict"], rows[10]["verdict"]] == ["block", "allow", "allow", "allow"]
    assert urls.judge_urls(df.limit(0)).count() == 0


def test_url_model_on_labelled_addresses_it_has_not_seen(monkeypatch):
    unwanted, wanted = urls.UNWANTED, urls.WANTED
    right = []
    for fold in range(6):
        monkeypatch.setattr(urls, "UNWANTED", [u for i, u in enumerate(unwanted) if i % 6 != fold])
        monkeypatch.setattr(urls, "WANTED", [u for i, u in enumerate(wanted) if i % 6 != fold])
        weights = urls.fit_urls.__wrapped__()
        for table, label in ((unwanted, True), (wanted, False)):
            for u in table[fold::6]:
                host, _, path = u.partition("/")
                right.append((label, (urls.unwanted(host.removesuffix(".test") + ".com", f"/{path}", weights) >= 0.5) == label))
    assert np.mean([ok for label, ok in right if not label]) > 0.9 and np.mean([ok for label, ok in right if label]) > 0.6


def test_vectors_up_to_a_bound_are_compared_block_by_block(spark, monkeypatch):
    """1,600 vectors in several blocks: links and components are those of brute force, without a round of NN-descent; above the bound that runs."""
    import numpy as np

    from tidelog.llm import neighbours

    rng = np.random.default_rng(11)
    centres = rng.standard_normal((400, 12))
    m = np.repeat(centres, 4, axis=0) + 0.22 * rng.standard_normal((1600, 12))
    data = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(1600, [1.0, 2.0])], "vec_id long, embedding array<double>")
    unit = m / np.linalg.norm(m, axis=1)[:, None]
    expected = {i: int(n) - 1 for i, n in enumerate((unit @ unit.T >= 0.9).sum(1))} | {1600: 0}
    assert sum(expected.values()) > 1000
    rounds, join = [], neighbours._join_neighbours
    monkeypatch.setattr(neighbours, "_join_neighbours", lambda *a, **k: rounds.append(1) or join(*a, **k))
    assert {r.vec_id: r.n_links for r in neighbours.vector_links(data).collect()} == expected and not rounds
    got = {r.vec_id: r.n_links for r in neighbours.vector_links(data, brute=0).collect()}
    assert rounds and all(got[i] <= n for i, n in expected.items()) and sum(got.values()) >= 0.9 * sum(expected.values())
