"""Main text of web pages: a linear-chain conditional random field over leaf blocks."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

#: Elements that stand in a line of text, have no content, or hold no text to read.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code del dfn em font i img ins kbd mark q s samp small span strike strong sub sup "
                   "time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNREAD = frozenset("script style noscript template head title svg math iframe object select textarea button canvas audio video".split())
#: Elements an opening tag closes if they are open (and nothing of ``SCOPES`` lies between).
CLOSED_BY = {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"),
             "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table article section div main aside nav header footer form body td th blockquote".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title)\b(?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<",
    re.S | re.I)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_PARTS = re.compile(r"[a-z]+")
_ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)

#: Parts of class, id and role names that tell content and surroundings apart.
CONTENT_NAMES = frozenset("article articlebody content contents post entry main body story text maincontent blog prose".split())
BOILER_NAMES = {
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc tabs toolbar skip links".split(),
    "header": "header masthead banner topbar logo branding search".split(),
    "footer": "footer bottom copyright legal colophon".split(),
    "side": "sidebar aside side rail widget related recommended popular trending tags complementary more".split(),
    "ad": "ad ads advert advertisement advertising sponsor sponsored promo promotion adsense banner".split(),
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay dialog privacy warning".split(),
    "form": "form login signup subscribe newsletter register contact search".split(),
    "comment": "comment comments disqus reply replies respond discussion reviews".split(),
    "share": "share sharing social follow meta byline".split(),
}
_BOILER = {name: kind for kind, names in BOILER_NAMES.items() for name in names}
#: Whole class names that a style sheet usually hides; a feature like others, as scripts may show the element.
HIDDEN_CLASSES = frozenset("hidden hide d-none is-hidden invisible visually-hidden sr-only screen-reader-text".split())


def is_hidden(attributes: str) -> bool:
    """Whether a tag's attributes hide the element by themselves: ``hidden``, or a style of no display or hidden visibility."""
    found = [(m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or "") for m in _ATTRIBUTE.finditer(attributes)]
    return any(name == "hidden" or name == "style" and _UNSEEN.search(value) for name, value in found)


def _classes(attributes: str) -> list[str]:
    return [c for m in _ATTRIBUTE.finditer(attributes) if m.group(1).lower() == "class" for c in (m.group(2) or m.group(3) or m.group(4) or "").lower().split()]


class Block:
    __slots__ = ("text", "tags", "kinds", "content", "linked", "tag")

    def __init__(self, text, stack, linked):
        self.text, self.linked = text, linked
        self.tag = stack[-1][0] if stack else ""
        self.tags = {s[0] for s in stack}
        self.kinds = {k for s in stack for k in s[1]}
        self.content = any(s[2] for s in stack)


def leaf_blocks(page: str | None) -> list[Block]:
    """Blocks of a page in order: text between the tags of block elements, white space made one space, references decoded."""
    blocks: list[Block] = []
    stack: list[tuple[str, frozenset, bool, bool]] = []  # tag, kinds of surroundings, content, unread
    pieces: list[str] = []
    links, linked, unread = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                blocks.append(Block(text, stack, min(1.0, linked / len(text))))
            pieces.clear()
        linked = 0

    def close(upto: int) -> None:
        nonlocal unread
        while len(stack) > upto:
            unread -= stack.pop()[3]

    for m in _TOKEN.finditer(page or ""):
        name = m.group(3)
        if name is None:
            piece = m.group()
            if m.group(1) is None and not piece.startswith(("<!", "<?", "</")) and not unread:
                piece = html.unescape(piece)
                pieces.append(piece)
                linked += len(piece) if links else 0
            continue
        name, ends = name.lower(), bool(m.group(2))
        if name in INLINE:
            if name == "a":
                links = 0 if ends else 1
            elif name == "br" and not unread:
                pieces.append(" ")
            continue
        flush()
        links = 0
        if ends:
            at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if at is not None:
                close(at)
            continue
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in CLOSED_BY.get(name, ("p",)):
                close(i)
            elif stack[i][0] in SCOPES:
                break
        if name in VOID:
            continue
        names = [p for g in _NAMES.findall(m.group(4)) for p in _PARTS.findall("".join(g).lower())]
        kinds = frozenset(_BOILER[p] for p in names if p in _BOILER)
        if names and not HIDDEN_CLASSES.isdisjoint(_classes(m.group(4))):
            kinds |= {"hidden"}
        hidden = name in UNREAD or is_hidden(m.group(4))
        stack.append((name, kinds, any(p in CONTENT_NAMES for p in names), hidden))
        unread += hidden
    flush()
    return blocks


TAGS = "article main section nav header footer aside form li ul ol td table p h1 h2 h3 h4 blockquote pre figure figcaption dl label address".split()
NAMED = [*(f"tag {t}" for t in TAGS), *(f"leaf {t}" for t in (*TAGS, "div", "body")), *(f"kind {k}" for k in (*BOILER_NAMES, "hidden")),
         "content name", "content or article", "no content around", "words 1", "words 2-4", "words 5-9", "words 10-24", "words 25+", "linked none",
         "linked some", "linked most", "ends a sentence", "copyright", "separators", "first", "last", "bare page"]
SLOT = {name: i for i, name in enumerate(NAMED)}
MAIN = 1


_PLAIN = frozenset("html body p div h1 h2 h3 h4 h5 h6 blockquote pre center".split())


def block_features(blocks: list[Block]) -> list[list[int]]:
    rows = []
    any_content = any(b.content or b.tags & {"article", "main"} for b in blocks)
    # Nothing tells an article from its surroundings: no element or name of either, no list, form or table.
    bare = not any_content and not any(b.kinds or b.tags - _PLAIN for b in blocks)
    for i, b in enumerate(blocks):
        n = b.text.count(" ") + 1
        row = [f"tag {t}" for t in b.tags if t in TAGS] + [f"kind {k}" for k in b.kinds]
        row += [f"leaf {b.tag}"] if f"leaf {b.tag}" in SLOT else []
        row += ["content name"] if b.content else []
        row += ["content or article"] if b.content or b.tags & {"article", "main"} else ["no content around"] if any_content else []
        row.append("words 1" if n < 2 else "words 2-4" if n < 5 else "words 5-9" if n < 10 else "words 10-24" if n < 25 else "words 25+")
        row.append("linked none" if b.linked == 0 else "linked some" if b.linked < 0.6 else "linked most")
        row += ["ends a sentence"] if b.text[-1] in ".!?…\"»”" else []
        row += ["copyright"] if "©" in b.text or "copyright" in b.text.lower() else []
        row += ["separators"] if b.text.count("|") + b.text.count("·") > n / 4 else []
        row += ["first"] if i == 0 else []
        row += ["last"] if i == len(blocks) - 1 else []
        row += ["bare page"] if bare else []
        rows.append([SLOT[f] for f in row])
    return rows


def labelled_pages(n: int = 240, seed: int = 17) -> list[tuple[list[Block], list[int]]]:
    """Pages laid out by rule, with the blocks of their article marked: articles in an element of their own, in a named one or
    bare, among menus, headers, adverts, notices, sidebars, forms, comments and footers, some of them never closed."""
    rng, veil = np.random.default_rng(seed), np.random.default_rng(seed + 1000)
    syllables = "ba ce di fo gu la me ni po ru sa te vi zo en ar is on th el".split()

    def words(a, b):
        return " ".join("".join(syllables[i] for i in rng.integers(len(syllables), size=rng.integers(1, 4))) for _ in range(rng.integers(a, b)))

    def pick(*xs):
        return xs[rng.integers(len(xs))]

    def links(k):
        return "".join(f'<li><a href="/{i}">{words(1, 4)}</a></li>' for i in range(k))

    pages = []
    for _ in range(n):
        inside: list[str] = []

        def keep(text, inside=inside):
            inside.append(" ".join(text.split()))
            return text

        def sentence():
            return words(*pick((1, 4), (5, 20), (20, 90))).capitalize() + pick(".", ".", ".", "!", "")

        body = [f"<h1>{keep(words(3, 10))}</h1>"] if rng.random() < 0.9 else []
        for _ in range(rng.integers(1, 9)):
            body.append(pick(
                lambda: f"<p>{keep(sentence())}" + pick("</p>", "", "</p>"), lambda: f"<p><b>{keep(sentence())}<br>" + pick("", "</b></p>"),
                lambda: f"<p>{keep(sentence())}</p>", lambda: f"<h2>{keep(words(2, 7))}</h2>",
                lambda: f"<ul>{''.join(f'<li>{keep(sentence())}</li>' for _ in range(rng.integers(2, 5)))}</ul>",
                lambda: f"<blockquote>{keep(sentence())}</blockquote>", lambda: f"<div>{keep(sentence())}</div>",
                lambda: f"<table><tr><td>{keep(words(1, 4))}</td><td>{keep(words(1, 4))}</td></tr></table>",
                lambda: f'<div class="{pick("ad", "advert", "promo")}">{sentence()}</div>', lambda: f"<p>{keep(' | '.join(words(1, 3) for _ in range(12)))}</p>",
                lambda: f'<aside>{sentence()}</aside>', lambda: f'<div class="share"><a href="#">{words(1, 3)}</a></div>')())
        before = [f"<nav><ul>{links(rng.integers(2, 8))}</ul></nav>", f'<div class="{pick("menu", "navbar", "breadcrumb")}">{links(3)}</div>',
                  f"<header>{pick('<h1>', '<p>', '<div>')}{words(1, 6)}</header>", f'<div id="header"><h2>{words(1, 5)}</h2></div>',
                  f'<div class="{pick("ad", "ads", "sponsored", "banner")}">{sentence()}</div>', f'<div class="{pick("cookie-notice", "consent", "alert notice")}"><p>{sentence()}</p></div>',
                  f'<form><label>{words(1, 4)}</label><p>{words(2, 9)}</p></form>']
        after = [f'<aside class="{pick("sidebar", "widget", "related")}"><h3>{words(1, 4)}</h3><ul>{links(4)}</ul><p>{sentence()}</p></aside>',
                 f'<div class="sidebar"><p>{sentence()}</p></div>', f'<form class="newsletter"><p>{sentence()}</p></form>',
                 f'<{pick("section", "div")} {pick("class", "id")}="comments"><h3>{words(1, 3)}</h3>' + "".join(f'<div class="comment"><p>{sentence()}</p></div>' for _ in range(3)) + pick("</section></div>", ""),
                 f"<footer>{pick('&copy; ', '')}{sentence()} &middot; {words(1, 9)}" + pick("</footer>", "", "</footer>"), f'<div id="footer"><p>&copy; {words(2, 9)}</p></div>']
        start, end = pick(("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="post-body">', "</div>"),
                          ("<main><article>", "</article></main>"), ("", ""), ('<div class="entry">', "</div>"))
        head = [x for x in before if rng.random() < 0.45] or before[:1]
        tail = [x for x in after if rng.random() < 0.45] or after[-2:-1]
        if veil.random() < 0.2:  # drawn apart, so that the rest of a page is the same with and without
            unseen = " ".join("".join(syllables[i] for i in veil.integers(len(syllables), size=3)) for _ in range(veil.integers(3, 25)))
            (head, tail)[veil.integers(2)].append(f'<div class="{("hidden", "hide", "sr-only")[veil.integers(3)]}"><p>{unseen}.</p></div>')
        text = f"<html><head><title>{words(2, 6)}</title></head><body>{''.join(head)}{start}{''.join(body)}{end}{''.join(tail)}</body></html>"
        blocks = leaf_blocks(text)
        main = set(inside)
        pages.append((blocks, [int(b.text in main) for b in blocks]))
    bare = np.random.default_rng(seed + 2000)  # pages that are nothing but their text

    def bare_words(a, b):
        return " ".join("".join(syllables[i] for i in bare.integers(len(syllables), size=bare.integers(1, 4))) for _ in range(bare.integers(a, b)))

    for _ in range(n // 6):
        lines = [bare_words(*((2, 9), (5, 25), (20, 90))[bare.integers(3)]).capitalize() + (".", "", "!")[bare.integers(3)] for _ in range(bare.integers(1, 4))]
        form = ("{}", "<p>{}", "<p>{}</p>", "<div>{}", "<div>{}</div>", "<html><body><p>{}</p></body></html>", "<h1>{}</h1>")[bare.integers(7)]
        joined = "<p>".join(lines) if form in ("{}", "<div>{}") else "".join(form.format(x) for x in lines)
        blocks = leaf_blocks(form.format(joined) if form in ("{}", "<div>{}") else joined)
        pages.append((blocks, [1] * len(blocks)))
    return [p for p in pages if p[0]]


def _matrix(pages):
    longest = max(len(b) for b, _ in pages)
    x, y, n = np.zeros((len(pages), longest, len(NAMED))), np.zeros((len(pages), longest), int), np.zeros(len(pages), int)
    for i, (blocks, labels) in enumerate(pages):
        n[i] = len(blocks)
        y[i, :len(labels)] = labels
        for t, row in enumerate(block_features(blocks)):
            x[i, t, row] = 1
    return x, y, n


@lru_cache(maxsize=2)
def fit_crf(pages: int = 240, rounds: int = 200, reg: float = 0.02) -> tuple[np.ndarray, np.ndarray]:
    """(weights per feature and label, weights per label and next label): the likelihood's maximum, by forward-backward gradients."""
    x, y, n = _matrix(labelled_pages(pages))
    p, longest = y.shape
    mask = np.arange(longest)[None, :] < n[:, None]
    gold, step = np.eye(2)[y] * mask[..., None], (mask[:, 1:])[..., None, None]
    gold_pairs = (gold[:, :-1, :, None] * gold[:, 1:, None, :] * step).sum((0, 1))
    w, tr = np.zeros((x.shape[2], 2)), np.zeros((2, 2))
    seen_w, seen_t = np.full_like(w, 1e-6), np.full_like(tr, 1e-6)
    for _ in range(rounds):
        emit = x @ w
        alpha, beta = np.zeros((p, longest, 2)), np.zeros((p, longest, 2))
        alpha[:, 0] = emit[:, 0]
        for t in range(1, longest):
            new = np.logaddexp.reduce(alpha[:, t - 1, :, None] + tr, axis=1) + emit[:, t]
            alpha[:, t] = np.where(mask[:, t, None], new, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(tr + (emit[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(mask[:, t + 1, None], new, 0)
        z = np.logaddexp.reduce(alpha[:, -1], axis=1)
        node = np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
        pair = np.exp(alpha[:, :-1, :, None] + tr + (emit + beta)[:, 1:, None, :] - z[:, None, None, None]) * step
        g = np.einsum("ptf,ptk->fk", x, gold - node) / p - reg * w / p
        gt = (gold_pairs - pair.sum((0, 1))) / p
        seen_w, seen_t = seen_w + g * g, seen_t + gt * gt
        w, tr = w + 0.4 * g / np.sqrt(seen_w), tr + 0.4 * gt / np.sqrt(seen_t)
    return w, tr


def viterbi(rows: list[list[int]], w: np.ndarray, tr: np.ndarray) -> list[int]:
    """The likeliest labels of a page's blocks."""
    if not rows:
        return []
    emit = [w[r].sum(0).tolist() for r in rows]
    (a, b), back = emit[0], []
    (t00, t01), (t10, t11) = tr.tolist()
    for e0, e1 in emit[1:]:
        back.append((int(b + t10 > a + t00), int(b + t11 > a + t01)))
        a, b = max(a + t00, b + t10) + e0, max(a + t01, b + t11) + e1
    labels = [int(b > a)]
    for choice in reversed(back):
        labels.append(choice[labels[-1]])
    return labels[::-1]


def main_text(page: str | None, w: np.ndarray, tr: np.ndarray) -> str:
    blocks = leaf_blocks(page)
    labels = viterbi(block_features(blocks), w, tr)
    return "\n".join(b.text for b, label in zip(blocks, labels) if label == MAIN)


def extract_main_text(pages: DataFrame, model: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """``page_id, url, text, n_chars``: the article of each page, one block per line.

    Whole pages are read. A null, empty or markup-free page is an empty text or its only block, as the model decides; null ids and urls stay;
    repeated rows give a row each; an empty table gives no rows. No shuffle; the model is all that is sent to tasks.
    """
    w, tr = model or fit_crf()

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(h, w, tr) for h in batch["html"]]
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.selectExpr("CAST(page_id AS STRING) AS page_id", "url", "html").mapInPandas(
        extract, "page_id string, url string, text string, n_chars long").selectExpr(
        f"CAST(page_id AS {kind}) AS page_id", "url", "text", "n_chars")
