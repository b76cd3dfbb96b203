"""One test per finding of the second review."""

from itertools import combinations

import pytest

from tidelog.llm import pages, secrets, toxicity
from tidelog.llm.mixing import curriculum_mix, read_by_mix
from tidelog.llm.simhash import fingerprint, keep_one_per_component, simhash_components

SF = "/root/testdata/sf0.01"


def _plain_components(fps, distance=2):
    """The representative index of each fingerprint's component, by all pairs of the distinct ones."""
    values = sorted(set(fps))
    group = {v: v for v in values}

    def top(v):
        while group[v] != v:
            v = group[v]
        return v
    for a, b in combinations(values, 2):
        if ((a ^ b) % (1 << 64)).bit_count() <= distance:
            group[top(b)] = top(a)
    return [top(v) for v in fps]


def test_near_duplicates_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()
    least, groups = {}, _plain_components([fingerprint(r["text"]) for r in rows])
    for r, g in zip(rows, groups):
        least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in keep_one_per_component(docs).collect()) == sorted(least.values())
    assert {(r["doc_id"], r["component"]) for r in simhash_components(docs).collect()} == {(r["doc_id"], least[g]) for r, g in zip(rows, groups)}


def test_one_row_of_each_component_stays(documents):
    """Rows that differ in another column only, repeated rows, rows without id, and ids on both sides of zero."""
    same = "one two three four five six"
    rows = [(None, same, "a"), (5, same, "b"), (5, same, "a"), (5, same, "a"), (None, "other words here", "a"), (None, "other words here", "b"), (-4, None, "a"), (7, "", "a")]
    got = sorted(((r["doc_id"], r["text"]) for r in keep_one_per_component(documents(rows)).collect()), key=str)
    assert got == [(-4, None), (5, same), (None, "other words here")]
    found = simhash_components(documents(rows)).collect()
    assert {(r["doc_id"], r["component"]) for r in found} == {(None, 5), (5, 5), (None, None), (-4, -4), (7, -4)}


def test_mixing_keeps_documents_without_id(documents):
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(10))
    rows = [(i if i % 3 else None, text(i), "ab"[i % 2]) for i in range(60)]
    rows += [(None, text(0), "a"), (7, text(99), "b"), (7, text(98), "b")]  # a repeated row, other texts under one id
    docs = documents(rows)
    got = [r.asDict() for r in read_by_mix(docs).collect()]
    mixed = [(r["doc_id"], r["source"], sum(p["taken"] for p in r["placements"])) for r in curriculum_mix(docs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted([(r["doc_id"], r["source"], r["taken"]) for r in got], key=key) == sorted([r for r in mixed if r[2]], key=key)
    assert any(r["doc_id"] is None for r in got)


def test_simhash_keeps_different_texts_under_one_id(documents):
    got = keep_one_per_component(documents([(1, "a b c d e f g", "a"), (1, "h i j k l m n", "a"), (1, "h i j k l m n", "a")])).collect()
    assert sorted(r["text"] for r in got) == ["a b c d e f g", "h i j k l m n"]


def test_spaced_letters_are_read_to_the_end():
    words = toxicity.words_of("y o u a r e a t o t a l l y d i s g u s t i n g i d i o t")
    assert {"youareatotallydisgusting", "lydisgustingidiot"} <= set(words)
    assert toxicity.words_of("i d i o t")["idiot"] == 1


@pytest.mark.parametrize("attributes, seen", [
    ("style='overflow:hidden'", True), ("class='overflow-hidden'", True), ("class=hidden-xs", True), ("aria-hidden='false'", True),
    ("data-hidden=1", True), ("hidden", False), ("hidden=''", False), ("style='color:red; display : none'", False),
    ('style="VISIBILITY:hidden"', False), ("id=a class=b hidden", False)])
def test_pages_hide_by_attributes_only(attributes, seen):
    page = f"<html><body><main {attributes}><p>A whole article stands here, with more than ten words in its only line.</p></main></body></html>"
    w, tr = pages.fit_crf()
    assert bool(pages.leaf_blocks(page)) == seen
    assert bool(pages.main_text(page, w, tr)) == seen


@pytest.mark.parametrize("text, secret", [
    ("password: hunter2pass", "hunter2pass"), ("token: abcdefghijKLMNOPqrstUVWXyz", "abcdefghijKLMNOPqrstUVWXyz"),
    ("DB_PASSWORD=Summer2024!", "Summer2024!"), ("API_KEY=" + "aB3dE5fG7h." * 30 + "x", "aB3dE5fG7h." * 30 + "x"),
    ("secret = \"" + "aB3dE5fG7h." * 30 + "\"", "aB3dE5fG7h." * 30), ("Authorization: Bearer qWeRtYuIoPaSdFgH12", "qWeRtYuIoPaSdFgH12")])
def test_secrets_after_a_name(text, secret):
    forest = secrets.fit_forest()
    found = [c for _, _, c, score in secrets.findings(f"so\n{text}\nnext line", forest) if score >= 0.5]
    assert found == [secret]


@pytest.mark.parametrize("text", ["the token: is read here", "password = os.environ[PASSWORD]", "token = null", "Donaudampfschifffahrt fährt", "key: value", "-" * 40])
def test_harmless_values_stay(text):
    assert not [c for _, _, c, score in secrets.findings(text, secrets.fit_forest()) if score >= 0.5]
