"""Operators against brute force on small tables, and on nulls, repeats and empty tables."""

import hashlib
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidelog.llm import licenses, mixing, pages, secrets, substrings, toxicity
from tidelog.llm.chat import format_conversations
from tidelog.llm.decontaminate import DECONTAMINATE_SQL, contaminated, drop_contaminated
from tidelog.llm.graph import connected_components
from tidelog.llm.mixing import MIX_SQL
from tidelog.llm.neighbours import vector_links
from tidelog.llm.queries import ORACLE, QUERIES
from tidelog.llm.simhash import fingerprint, fingerprint_links, keep_one_per_component, simhash_components

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(tuple(r[n] for n in names) for r in df.collect()) == Counter(map(tuple, result.fetchall()))


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (9, 8), (8, 7), (7, 1), (20, 21), (21, 22), (22, 20), (5, 5)], "a long, b long")
    got = {r["id"]: r["component"] for r in connected_components(links).collect()}
    assert got == {**dict.fromkeys((1, 2, 3, 7, 8, 9), 1), **dict.fromkeys((20, 21, 22), 20)}


def _plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprint_is_the_majority_of_shingle_hashes():
    for text in (None, "", "a", "A b", "a B c", "the cat sat on the mat the cat sat on", "É x y z w"):
        assert fingerprint(text) % (1 << 64) == _plain_fingerprint(text)


@pytest.mark.parametrize("crowd", [2, 4096])
@pytest.mark.parametrize("distance", [1, 2, 3])
def test_fingerprint_links_equal_all_pairs(spark, crowd, distance):
    if crowd == 2 and distance == 3:
        pytest.skip("the look-up of 43,745 values per member is slow on one machine")
    rng = np.random.default_rng(1)
    values = {int(x) for x in rng.integers(-(1 << 63), (1 << 63) - 1, 12)}
    for x in list(values):
        for _ in range(4):
            y = x
            for b in rng.integers(0, 64, rng.integers(1, 5)):
                y ^= 1 << int(b)
            values.add((y + (1 << 63)) % (1 << 64) - (1 << 63))
    got = {tuple(r) for r in fingerprint_links(spark.createDataFrame([(v,) for v in values], "fp long"), distance, crowd).collect()}
    assert got == {(a, b) for a in values for b in values if a < b and ((a ^ b) % (1 << 64)).bit_count() <= distance}


def test_simhash_on_odd_rows(spark, odd):
    rows = simhash_components(odd).collect()
    assert len(rows) == odd.count()
    kept = keep_one_per_component(odd)
    assert kept.columns == odd.columns
    # The texts are three: without words, the sentence and the long one; of each the row with the least id stays.
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4]
    assert {(r["doc_id"], r["component"]) for r in rows} == {(1, 1), (2, 1), (5, 1), (None, 1), (3, 3), (None, 3), (4, 4)}
    nameless = odd.where("doc_id IS NULL")
    assert {(r["doc_id"], r["component"]) for r in simhash_components(nameless).collect()} == {(None, None)}
    assert keep_one_per_component(nameless).count() == 2
    assert simhash_components(odd.limit(0)).count() == keep_one_per_component(odd.limit(0)).count() == 0


def test_mixing_on_odd_rows(odd):
    rows = mixing.by_position(mixing.curriculum_mix(odd)).collect()
    assert len(rows) == odd.count()
    assert all(r["taken"] <= 3 * r["size"] for r in rows)
    by_source = {r["target"]: 0 for r in rows}
    for r in rows:
        by_source[r["target"]] += r["taken"]
    assert all(abs(taken - target) < 1 for target, taken in by_source.items())
    assert mixing.curriculum_mix(odd.limit(0)).count() == 0


def test_training_order_is_sorted(odd):
    positions = [r["position"] for r in mixing.training_order(mixing.curriculum_mix(odd)).collect()]
    assert positions == sorted(positions) and 0 <= positions[0] and positions[-1] < 1


def test_chat_keeps_maximal_conversations(spark):
    turns = [(1, 0, "u", "a"), (1, 1, "s", "b"), (2, 0, "u", "a"), (3, 5, "u", "a"), (3, 6, "s", "b"), (3, 9, "u", "<|start|>"),
             (4, 0, "u", "a"), (4, 1, "s", "x"), (5, 0, "u", "a"), (5, 1, "s", "x"), (6, None, None, None), (None, 0, "u", "")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = {r["conv_id"]: r for r in format_conversations(df).collect()}
    assert set(rows) == {3, 4, 6, None} and rows[4]["n_copies"] == 2
    assert rows[3]["text"].endswith("<|start|>u\n<\\|start|><|end|>\n")
    parts = [r for r in format_conversations(df, piece_turns=1).collect() if r["conv_id"] == 3]
    assert "".join(r["text"] for r in sorted(parts, key=lambda r: r["part"])) == rows[3]["text"]
    assert format_conversations(df.limit(0)).count() == 0


def test_decontamination(spark, odd, documents):
    item = " ".join(f"x{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item), (2, "one two three"), (3, None), (None, item)], "item_id long, text string")
    docs = documents([(10, f"start {item.upper()} end", "a"), (11, item.replace("x3 ", "y "), "a"), (12, "nothing here", "a"), (13, "so: One, two three!", "a"),
                      (14, item.replace("x19", "y"), "a")]).unionByName(odd)
    got = {(r["key"], r["item_id"]): r["similarity"] for r in contaminated(docs, bench).collect() if r["key"] >= 0}
    assert got == {(10, 1): 1.0, (13, 2): 1.0, (14, 1): 15 / 17, (3, 2): 1.0}
    again = spark.createDataFrame([(1, "a b c d e " * 6)], "item_id long, text string")  # shingles that repeat on both sides
    rows = contaminated(documents([(1, "x y " + "a b c d e " * 6 + "z", "a"), (2, "a b c d e " * 3, "a"), (3, "a b c d e " * 7, "a")]), again).collect()
    assert {r["key"]: r["similarity"] for r in rows} == {1: 1.0, 3: 1.0}
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and {11, 12, 4} <= {r["doc_id"] for r in kept.collect()}
    assert contaminated(docs, bench.limit(0)).count() == contaminated(docs.limit(0), bench).count() == 0


def test_toxicity_learns_gapped_words(spark, odd):
    rng = np.random.default_rng(2)
    plain = [f"{a}{b}" for a in ("ba", "ce", "di", "fo", "gu") for b in ("lan", "mer", "nis", "pot")]
    bad = ["grumblork", "snazzfit"]
    texts, labels = [], []
    for i in range(240):
        words = [plain[k] for k in rng.integers(0, len(plain), 20)]
        if i % 3 == 0:
            words[5], words[12] = bad[i % 2], bad[(i // 3) % 2]
        texts.append(" ".join(words) + ".")
        labels.append(int(i % 3 == 0))
    model = toxicity.fit(texts, labels)
    scores = model.scores([" ".join(plain) + " g-r-u-m-b-l-o-r-k snazzfit", " ".join(plain), "", None], {})
    assert scores[0] > 0.5 > scores[1] and scores[2] == scores[3] < 0.5
    gapped = model.word_scores(["grumbxlork", "grumblrk", "grumblorkk", "snazfit", "snazzxfit"])
    assert gapped.min() > model.word_scores(plain).max()
    assert toxicity.score_toxicity(odd, model).count() == odd.count()
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit_on(odd, empty) is None
    assert {r["__toxicity"] for r in toxicity.score_toxicity(odd, None).collect()} == {0.0}


def test_string_kernel_equals_a_plain_sum():
    def plain(a, b, decay=0.6):
        def parts(w):
            w, found = f"^{w}$", Counter()
            for p in combinations(range(len(w)), 3):
                if p[-1] - p[0] < toxicity.SPAN:
                    found["".join(w[i] for i in p)] += decay ** (p[-1] - p[0] + 1)
            return found
        x, y = parts(a), parts(b)
        return sum(x[k] * y[k] for k in x) / np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))

    words = ["grumblork", "grum", "a", "gr\u00fcmbl", "banana", "anab", "x" * 24]
    kernel = toxicity.WordKernel(words[:5], power=2)
    expected = [[plain(w, m) ** 2 for m in words[:5]] for w in words]
    assert np.allclose(kernel.apply(words), expected, atol=1e-5)


@pytest.mark.parametrize("texts, labels", [
    ([], []), (["", None], [0, 1]), (["a b", "c d"], [0, 1]), (["abc def", "abc def"] * 4, [0, 1] * 4), (["abc def"] * 3, [1] * 3), (["...", "!!"] * 5, [0, 1] * 5)])
def test_unusable_labels_give_no_model(texts, labels):
    with pytest.warns(UserWarning, match="every score is 0"):
        assert toxicity.fit(texts, labels) is None


def test_a_repeated_id_gives_the_same_model(spark, documents):
    rows = [(i, f"plain words {'grumblork' if i % 2 else 'nice'} number {i}", "a") for i in range(1, 60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, toxic int")
    twice = rows + [(i, "other text", "a") for i in range(1, 60)]
    models = [toxicity.fit_on(documents(order).repartition(n), labels) for order, n in ((twice, 3), (twice[::-1], 5))]
    assert (models[0] is None and models[1] is None) or np.array_equal(models[0].table, models[1].table)


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    scored = QUERIES["op1_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id")
    rows = scored.where("held_out").select("toxic", "predicted").collect()
    assert sum(r["toxic"] == r["predicted"] for r in rows) / len(rows) > 0.97


def test_secrets(documents, odd):
    secret = hashlib.sha1(b"x").hexdigest()
    docs = documents([(1, f'so token = "{secret}" and', "a"), (2, f"see commit {secret} there", "a")]).unionByName(odd)
    got = {r["doc_id"]: r["is_secret"] for r in secrets.scan_secrets(docs).collect()}
    assert got[1] and not got[2]
    clean = secrets.redact_secrets(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert clean.where(F.col("text").contains("[secret]")).select("text", "n_chars").collect() == [('so token = "[secret]" and', 25)]
    rows, labels = secrets.labelled_findings(400, seed=123)
    forest = secrets.fit_forest()
    assert np.mean([(forest.score(secrets.features(*r)) >= 0.5) == y for r, y in zip(rows, labels)]) > 0.95


def test_pages(spark):
    w, tr = pages.fit_crf()
    other = pages.labelled_pages(80, seed=5)
    right = [a == b for blocks, labels in other for a, b in zip(pages.viterbi(pages.block_features(blocks), w, tr), labels)]
    assert np.mean(right) > 0.97
    html = ("<html><head><title>t</title></head><body><nav><a href=x>menu</a></nav><article><h1>A &amp; B</h1><p>First\n  line.<br>More.<p>Second one here."
            "<script>var t='</p>'</script></article><!-- no --><footer>&copy; us</footer>")
    df = spark.createDataFrame([(1, "u", html), (2, None, None), (None, "v", ""), (1, "u", html)], "page_id long, url string, html string")
    rows = pages.extract_main_text(df).collect()
    assert [r["text"] for r in rows if r["page_id"] == 1] == ["A & B\nFirst line. More.\nSecond one here."] * 2
    assert [r["n_chars"] for r in rows if r["page_id"] != 1] == [0, 0]


def _all_best(words, grams, m, least, own):
    best = 0.0
    for i in range(len(words)):
        for j in range(i + 2, len(words) + 1):
            here = Counter(zip(words[i:j], words[i + 1:j]))
            n = j - i - 1
            if not own or own & set(here):
                best = max(best, 2 * sum((here & grams).values()) / (m + n))
    return best if best >= least else None


def test_licenses_equal_all_windows(documents, odd):
    index = licenses.TemplateIndex(licenses.TEMPLATES, 0.8)
    texts = ["x y Released under the MIT License. z", "RELEASED!! UNDER!! THE!! MIT!!", "Licensed under the Apache License, version two", "Licensed | under | CC | BY-NC | 4.0 | and | on", ""]
    for text in texts:
        words = licenses.normalised(text)
        expected = {n: b for n, g in index.bigrams.items() if (b := _all_best(words, g, sum(g.values()), 0.8, index.own[n]))}
        got = {}
        for name, dice, _, _ in index.windows(text):
            got[name] = max(got.get(name, 0), dice)
        assert got == expected
    for text, license in (
            ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0"), ("the GNU Lesser General Public License, version 2.1", "LGPL-2.1"),
            ("GNU Affero General Public License v3", "AGPL-3.0"), ("# SPDX-License-Identifier: BSD-2-Clause", "BSD-2-Clause"), ("Licensed under CC BY 4.0", "CC-BY-4.0"),
            ("Licensed under CC BY-SA 4.0", "CC-BY-SA-4.0"), ("Creative Commons Attribution-NoDerivatives 3.0 Unported", "CC-BY-ND-3.0"),
            (licenses.TEMPLATES["GPL-2.0-header"], "GPL-2.0"), (licenses.TEMPLATES["BSD-2-Clause"], "BSD-2-Clause"), (licenses.TEMPLATES["0BSD"], "0BSD"),
            (licenses.TEMPLATES["ISC"], "ISC"), ("CC0 1.0 Universal Public Domain Dedication", "CC0-1.0"), ("licensed under the terms of the state", None),
            ("SPDX-License-Identifier: NoSuch-1.0", None)):
        assert [licenses.license_of(m[0]) for m in index.matches(text)] == ([license] if license else []), text
    assert licenses.scan_licenses(odd.limit(0)).count() == 0
    full = documents([(1, "Copyright us\n\n" + licenses.TEMPLATES["MIT"], "a")]).unionByName(odd)
    assert [(r["doc_id"], r["license"], r["dice"]) for r in licenses.scan_licenses(full).collect()] == [(1, "MIT", 1.0)]


@pytest.mark.parametrize("crowd", [1, 60_000])
def test_repeats_equal_brute_force(documents, crowd, monkeypatch):
    rng = np.random.default_rng(4)
    def word():
        return "".join(chr(97 + c) for c in rng.integers(0, 6, rng.integers(1, 9)))
    def prose(n):
        return " ".join(word() for _ in range(n))
    shared, copy = prose(150), prose(200)
    texts = [prose(50) + shared + prose(90), prose(80) + shared[:600] + "é" + prose(20), copy, copy, copy[:300] + "X" + copy[301:], "ab " * 400, "ba " * 300, "", None,
             prose(300), shared[5:405], shared[5:404]]
    docs = documents([(i, t, "a") for i, t in enumerate(texts)])
    original = substrings.removed_spans
    monkeypatch.setattr(substrings, "removed_spans", lambda d, n: original(d, n, crowd=crowd))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in substrings.remove_repeats(docs).collect()}
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i:i + 400] for d in data for i in range(len(d) - 399))
    for i, d in enumerate(data):
        covered = np.zeros(len(d) + 1, bool)
        for k in range(len(d) - 399):
            if counts[d[k:k + 400]] > 1:
                covered[k:k + 400] = True
        spans = int((covered[:-1] & ~np.r_[False, covered[:-2]][:len(d)]).sum()) if len(d) else 0
        assert got[i] == (len(d), int(covered.sum()), spans, bytes(b for b, c in zip(d, covered) if not c)), i


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [v for _ in range(60) for c in [rng.standard_normal(16)] for v in [c + rng.standard_normal(16) * s for s in rng.choice([0.02, 0.15, 0.3], rng.integers(1, 6))]]
    rows += [rows[0], rows[0] * 2]
    data = [(i, [float(x) for x in v]) for i, v in enumerate(rows)] + [(900, None), (901, [0.0] * 16), (902, [float("nan")] * 16), (903, [])]
    got = {r["vec_id"]: r for r in vector_links(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()}
    unit = np.stack(rows) / np.linalg.norm(np.stack(rows), axis=1)[:, None]
    linked = unit @ unit.T >= 0.9
    assert len(got) == len(data)
    true = linked.sum(1) - 1
    assert sum(got[i]["n_links"] for i in range(len(rows))) >= 0.98 * true.sum() and all(got[i]["n_links"] <= true[i] for i in range(len(rows)))
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in (900, 901, 902, 903))


def test_pipeline_stages_equal_plain_versions(spark):
    """Each stage on what the stage before it kept, against a plain version of its own."""
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM read_parquet('{SF}/benchmark.parquet')")

    def rows(df):
        return Counter(tuple(r[c] for c in columns) for r in df.collect())

    def toxicity_plain(given):
        model = toxicity.fit_on(docs, spark.read.parquet(f"{SF}/labels.parquet"))
        return Counter({r: n for r, n in given.items() if model.scores([r[1]], {})[0] < 0.5})

    def near_plain(given):
        fps = {r: _plain_fingerprint(r[1]) for r in given}
        left, kept = set(given), Counter()
        while left:
            group, front = set(), {min(left)}
            while front:
                group |= front
                front = {r for r in left - group for g in front if (fps[r] ^ fps[g]).bit_count() <= 2}
            left -= group
            kept[min(group)] = 1
        return kept

    def benchmark_plain(given):
        con.register("docs", docs.select("doc_id", "text").toArrow())
        found = {r[0] for r in con.execute(DECONTAMINATE_SQL.replace("{docs}", "docs")).fetchall()}
        return Counter({r: n for r, n in given.items() if r[0] not in found})

    def secrets_plain(given):
        forest, out = secrets.fit_forest(), Counter()
        for r, n in given.items():
            text = r[1]
            for a, size, _, score in sorted(secrets.findings(text, forest), reverse=True):
                if score >= 0.5:
                    text = text[:a] + "[secret]" + text[a + size:]
            out[(r[0], text, *r[2:4], len(text))] += n
        return out

    plain = [toxicity_plain, near_plain, benchmark_plain, secrets_plain]
    for (name, stage), expected in zip(corpus_pipeline.STAGES, plain):
        after = stage(spark, docs, SF)
        assert after.columns == columns, name
        assert rows(after) == expected(rows(docs)), name
        docs = after
    con.register("docs", docs.toArrow())
    taken = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, taken FROM ({MIX_SQL.format(docs='docs')}) WHERE taken > 0").fetchall()}
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.columns[:len(columns)] == columns
    assert {r["doc_id"]: r["taken"] for r in last.collect()} == taken
    assert rows(last) == Counter({r: n for r, n in rows(docs).items() if r[0] in taken})


def test_pipeline_stages_on_odd_rows(spark, odd):
    import corpus_pipeline
    for docs in (odd, odd.limit(0)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            assert docs.columns[:len(columns)] == columns, name
        docs.collect()
