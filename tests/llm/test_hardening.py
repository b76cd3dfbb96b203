"""Cases the third review found missing: pages of one block, key formats, hot conversations, audits, odd tables."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import neighbours, pages, secrets
from tidelog.llm.chat import format_conversations, ranked_turns
from tidelog.llm.neighbours import vector_links
from tidelog.llm.substrings import remove_repeats

SF = "/root/testdata/sf0.01"
LINE = "A whole article stands here, with more than ten words in its only line"


@pytest.mark.parametrize("page", [LINE, f"{LINE}.", f"<p>{LINE}.", f"<p>{LINE}</p>", f"<div>{LINE}.", f"<html><body><div><p>{LINE}.</p></div></body></html>", f"<h1>{LINE}</h1>"])
def test_a_page_of_one_block_is_its_article(page):
    w, tr = pages.fit_crf()
    assert pages.main_text(page, w, tr).rstrip(".") == LINE


def test_a_page_of_menus_alone_has_no_article():
    w, tr = pages.fit_crf()
    page = "<html><body><nav><ul><li><a href=/a>One</a></li><li><a href=/b>Two words</a></li></ul></nav><footer>&copy; us</footer></body></html>"
    assert pages.main_text(page, w, tr) == ""


def test_pages_of_odd_tables(spark):
    long = "<article>" + f"<p>{LINE}.</p>" * 5000 + "</article>"
    df = spark.createDataFrame([(1, "u", long), (None, None, LINE), (2, "v", None)], "page_id long, url string, html string").withColumns(
        {"text": F.lit("clash"), "n_chars": F.lit(None)})
    rows = {r["page_id"]: r for r in pages.extract_main_text(df).collect()}
    assert rows[1]["text"] == "\n".join([f"{LINE}."] * 5000) and rows[None]["text"] == LINE and rows[2]["n_chars"] == 0
    assert pages.extract_main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("text, found", [
    ("use ghq_16C7e42F292c6912E7710c838347Ae178B4a now", ["ghq_16C7e42F292c6912E7710c838347Ae178B4a"]),
    ("key is zk_live_4eC39HqLyjWDarjtT1zdp7dc here", ["zk_live_4eC39HqLyjWDarjtT1zdp7dc"]),
    ("cookie eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9P end",
     ["eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9P"]),
    ("db at postgres://app:Tr0ubad4ur@db.example.com/x", ["Tr0ubad4ur"]),
    ("see https://example.com:8080/path and mail me@example.com", []),
    ("call module.submodule.function_name_of_it here", []),
    ("", []), (None, []), ("x" * 300_000, [])])
def test_key_formats(text, found):
    assert [c for _, _, c, score in secrets.findings(text, secrets.fit_forest()) if score >= 0.5] == found


def test_training_knows_no_word_of_the_tests():
    rows, labels = secrets.labelled_findings()
    values = " ".join(r[0].lower() for r, y in zip(rows, labels) if y)
    assert not [w for w in ("hunter", "summer", "winter", "dragon", "qwerty", "letmein", "password1") if w in values]


def test_secrets_of_an_empty_table(odd):
    assert secrets.scan_secrets(odd.limit(0)).count() == secrets.redact_secrets(odd.limit(0)).count() == 0


def test_a_conversation_without_turn_numbers_is_spread(spark):
    """All turns of one conversation, without numbers and mostly alike: it is in every partition, and its ranks are 1, 2, ..."""
    rows = [(None, None, "u", "same")] * 300 + [(None, None, "u", f"t{i:03d}") for i in range(60)] + [(1, 0, "u", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    df = df.withColumns({"piece": F.lit("x"), "rank": F.lit(1), "row": F.lit(2), "tie": F.lit(3)})
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ranked = ranked_turns(df, piece_turns=50).where("conv_id IS NULL").collect()
        assert sorted(r["rank"] for r in ranked) == list(range(1, 361))
        assert [r["text"] for r in sorted(ranked, key=lambda r: r["rank"])] == ["same"] * 300 + [f"t{i:03d}" for i in range(60)]
        laid = df.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("tie"))
        order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "tie")]
        sizes = [r["count"] for r in laid.repartitionByRange(*order).groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 200
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    parts = [r for r in format_conversations(df, piece_turns=50).collect() if r["conv_id"] is None]
    assert sorted(r["part"] for r in parts) == list(range(8)) and parts[0]["n_turns"] == 360


def test_repeats_on_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in remove_repeats(docs).collect()}
    data = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    counts = Counter(hash(d[i:i + 400]) for d in data.values() for i in range(len(d) - 399))
    for doc, d in data.items():
        covered = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - 399):
            if counts[hash(d[i:i + 400])] > 1:
                covered[i:i + 400] = True
        starts = covered[:-1] & ~np.r_[False, covered[:-2]][:len(d)] if len(d) else np.zeros(0, bool)
        assert got[doc] == (len(d), int(covered.sum()), int(starts.sum()), bytes(b for b, c in zip(d, covered) if not c)), doc


def test_repeats_of_odd_tables(odd):
    rows = remove_repeats(odd.withColumns({"n_bytes": F.lit("x"), "kept": F.lit(1), "gram": F.lit(2)})).collect()
    assert len(rows) == odd.count() and all(r["n_removed"] == 0 for r in rows)
    assert remove_repeats(odd.limit(0)).count() == 0


def test_planted_clusters(spark):
    """Ten thousand vectors in clusters of every width, linked and nearly linked: next to all links are found, and none that is not."""
    rng = np.random.default_rng(12)
    rows = []
    while len(rows) < 10_000:
        centre = rng.standard_normal(24)
        rows += [centre + rng.standard_normal(24) * s for s in rng.choice([0.05, 0.2, 0.3, 0.4], rng.integers(1, 12))]
    rows = np.stack(rows[:10_000])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>").repartition(8)
    got = {r["vec_id"]: r["n_links"] for r in vector_links(df).collect()}
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    true = np.zeros(len(rows), int)
    for a in range(0, len(rows), 1000):
        true[a:a + 1000] = (unit[a:a + 1000] @ unit.T >= 0.9).sum(1) - 1
    assert true.sum() > 5000 and all(got[i] <= true[i] for i in got)
    assert sum(got.values()) >= 0.98 * true.sum()


def test_vectors_of_odd_tables(spark):
    rows = [(None, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [2.0, 0.0]), (2, [0.0, 1.0]), (1, [0.0, float("inf")]), (7, [1.0]), (8, [1.0]), (9, [None, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit("x"), "unit": F.lit(1), "lead": F.lit(2), "n": F.lit(3)})
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in vector_links(df).collect()), key=str)
    assert got == sorted([(None, 2, 3, False), (3, 2, 3, True), (3, 2, 3, True), (2, 0, 2, True), (1, 0, 1, True), (7, 1, 7, True), (8, 1, 7, False),
                          (9, 0, 9, True)], key=str)
    assert vector_links(df.limit(0)).count() == 0


def test_the_audit_sees_what_is_missing(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 16))
    units = np.repeat(centres, 5, axis=0) + rng.standard_normal((200, 16)) * 0.1
    units /= np.linalg.norm(units, axis=1)[:, None]
    leads = spark.createDataFrame([(i, u.tolist()) for i, u in enumerate(units)], "id long, unit array<double>")
    radius = spark.createDataFrame([(i, 0.0) for i in range(200)], "id long, radius double")
    pairs = [(i, j, float(units[i] @ units[j])) for i in range(200) for j in range(200) if i < j and units[i] @ units[j] >= 0.9]
    whole, half = (spark.createDataFrame(p, "u long, v long, cos double") for p in (pairs, pairs[::2]))
    assert neighbours._audit(whole, leads, radius, 0.9, 100, 200) == 1.0
    assert 0.3 < neighbours._audit(half, leads, radius, 0.9, 100, 200) < 0.7
