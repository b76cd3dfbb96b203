"""Secret scans: candidate strings in texts, judged by a random forest."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A candidate: a run of key characters of 16 or more, or the value given to a secret's name, quoted or not and of any length.
_CANDIDATE = re.compile(r"[A-Za-z0-9_\-]{10,}(?:\.[A-Za-z0-9_\-]{10,}){2}|[A-Za-z0-9+/_=\-]{16,}")
_ASSIGNED = re.compile(
    r"""(?i)(?:passw(?:or)?d|passwd|passphrase|pwd|secret|token|api[_-]?key|apikey|[a-z]{2,20}[_-]key|\bkey|auth(?:orization)?|credentials?)"""
    r"""[a-z0-9_.\-]{0,40}["'`]?\s{0,3}(?::=|=>|[:=])\s{0,3}(?:(?:bearer|basic|token)\s+)?"""
    r"""(?:"([^"\n]+)"|'([^'\n]+)'|`([^`\n]+)`|["'`]?([^\s"'`]+))|\bbearer\s+([^\s"'`]{8,})|://[^\s/:@"'`]{1,64}:([^\s/@"'`]+)(?=@)""")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_\-]*=+(?=[^=])")
_TAIL = ".,;:)]}>"

#: Words that name a secret, words that name a harmless digest or id, placeholders, common words in identifiers.
NAMES = ("token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "api-key", "access_key", "auth", "bearer", "credential",
         "private_key", "client_secret", "key")
HARMLESS = ("commit", "sha", "sha1", "sha256", "md5", "checksum", "digest", "hash", "etag", "uuid", "guid", "revision", "build",
            "integrity", "fingerprint", "version", "id")
PLACEHOLDERS = ("example", "your", "xxxx", "placeholder", "changeme", "sample", "dummy", "redacted", "test")
WORDS = ("access", "account", "action", "address", "admin", "application", "array", "async", "auth", "base", "buffer", "build", "button",
         "cache", "callback", "change", "channel", "char", "check", "class", "client", "code", "color", "column", "common", "config",
         "connection", "content", "context", "control", "count", "create", "current", "data", "date", "default", "delete", "device",
         "document", "element", "error", "event", "example", "factory", "field", "file", "filter", "format", "function", "get", "global",
         "group", "handler", "header", "height", "hidden", "http", "image", "index", "info", "input", "instance", "int", "interface", "item",
         "json", "key", "label", "layout", "length", "level", "line", "link", "list", "load", "local", "log", "main", "manager", "map",
         "message", "meta", "method", "model", "module", "name", "network", "node", "null", "number", "object", "option", "order", "page",
         "param", "parent", "password", "path", "pattern", "place", "plugin", "point", "policy", "position", "private", "process",
         "product", "profile", "project", "property", "public", "query", "queue", "read", "record", "report", "request", "resource",
         "response", "result", "return", "role", "root", "row", "rule", "sample", "schema", "scope", "script", "search", "secret",
         "section", "select", "server", "service", "session", "set", "size", "source", "start", "state", "static", "status", "store",
         "stream", "string", "style", "system", "table", "target", "task", "template", "test", "text", "thread", "time", "title", "token",
         "tree", "type", "unit", "update", "upload", "url", "user", "util", "value", "version", "view", "web", "width", "window", "work",
         "write", "xml", "your")
_WORDS = re.compile("|".join(sorted(WORDS, key=len, reverse=True)))

FEATURES = ("length", "entropy", "digits", "uppers", "symbols", "class_changes", "vowel_changes", "distinct", "hex_only", "dictionary",
            "placeholder", "in_path", "name_before", "harmless_before", "quoted", "assigned", "dashes", "longest_letters", "code",
            "prefixed", "three_parts", "in_address")


def features(candidate: str, before: str, after: str) -> list[float]:
    """Numbers on a candidate and the text around it, in the order of ``FEATURES``."""
    n, low, near = len(candidate), candidate.lower(), before.lower()
    classes = "".join("d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in candidate)
    counts = np.array([low.count(c) for c in set(low)], float)
    letters = re.findall(r"[a-z]+", low)
    covered = sum(len(w) for w in _WORDS.findall(low) if len(w) > 2)
    vowels = [c in "aeiou" for c in low if c.isalpha()]
    words = re.findall(r"[a-z0-9_\-]+", near[-40:])[-4:]
    return [
        min(n, 200), float(-(counts / n * np.log2(counts / n)).sum()),
        classes.count("d") / n, classes.count("u") / n, classes.count("s") / n,
        sum(a != b for a, b in zip(classes, classes[1:])) / n,
        sum(a != b for a, b in zip(vowels, vowels[1:])) / max(1, len(vowels)),
        len(counts) / min(n, 64), float(all(c in "0123456789abcdef" for c in low)),
        covered / max(1, sum(map(len, letters))), float(any(p in low for p in PLACEHOLDERS)),
        float(candidate.count("/") > 1 or bool(re.search(r"(://|/|\\|\.(?:com|org|net|html?|js|py)\S*)$", before[-30:]))),
        float(any(w.strip("_-") in NAMES or any(w.endswith(("_" + k, "-" + k)) for k in NAMES) for w in words)),
        float(any(w.strip("_-") in HARMLESS for w in words)),
        float(before[-1:] in "\"'`" and before != "" and after[:1] in "\"'`" and after != ""),
        float(bool(re.search(r"[:=]\s*[\"'`]?$", before))), candidate.count("-"), max(map(len, letters), default=0),
        sum(c in "()[]{}<>$ " for c in candidate) / n,
        # A key that names its issuer: a short word, a separator, and one long run of letters and digits.
        float(bool(re.fullmatch(r"[A-Za-z]{2,10}(?:[_\-][a-z]{2,8})?[_\-][A-Za-z0-9]{16,}", candidate))),
        float(candidate.count(".") == 2 and all(len(part) > 9 for part in candidate.split("."))),
        float(bool(re.search(r"://[^\s/:@]+:$", before)) and after[:1] == "@"),
    ]


def candidates(text: str | None, reach: int = 60) -> list[tuple[int, str, str, str]]:
    """(start, candidate, text before, text after), in order; a longer match covers those inside it."""
    text = text or ""
    spans, named = set(), []
    if "=" in text or ":" in text or "earer" in text or "EARER" in text:
        for m in _ASSIGNED.finditer(text):
            k = m.lastindex
            a, b = m.span(k)
            if k > 3:  # not quoted: without the sentence's or the bracket's end
                kept = text[a:b].rstrip(_TAIL if not any(c in text[a:b] for c in "([{<") else ".,;:")
                b = a + len(kept)
            if b > a:
                spans.add((a, b))
                named.append((m.start(), b))
    at = 0
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        while at < len(named) and named[at][1] <= a:
            at += 1
        k = at
        while k < len(named) and named[k][0] < b:  # what stands outside the name and its value
            if named[k][0] - a >= 16:
                spans.add((a, named[k][0]))
            a = max(a, named[k][1])
            k += 1
        if b - a >= 16:
            name = _NAME.match(text, a, b)
            spans.add((name.end() if name else a, b))
    out, end = [], -1
    for a, b in sorted(spans, key=lambda s: (s[0], -s[1])):
        if b > end:
            a, end = max(a, end), b
            out.append((a, text[a:b], text[max(0, a - reach):a], text[b:b + reach]))
    return out


def labelled_findings(n: int = 1500, seed: int = 7) -> tuple[list[tuple[str, str, str]], np.ndarray]:
    """``n`` findings with labels (1: a secret), drawn by rule: random strings and passwords under a secret's name or in an address, keys that name
    their issuer and web tokens anywhere, against digests, ids, placeholders, identifiers, calls, paths and prose. Passwords are syllables
    with digits and signs; no word list is behind them."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[rng.integers(len(xs))]
    draw = lambda alphabet, k: "".join(pick(alphabet) for _ in range(k))
    hexes, alnum, upper = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    prose = lambda: " ".join(draw("etaoinshr", rng.integers(2, 8)) for _ in range(rng.integers(2, 6)))

    def password():
        word = "".join(draw("bcdfghklmnprstvw", 1) + draw("aeiou", 1) + draw("lmnrst", rng.integers(2)) for _ in range(rng.integers(2, 4)))
        word = word.capitalize() if rng.integers(2) else word
        more = "".join(draw("bcdfglmprst", 1) + draw("aeiou", 1) for _ in range(2)) if rng.integers(4) == 0 else ""
        return word + draw("0123456789", rng.integers(1, 5)) + pick([more, "", draw("!#$%&*?@", 1), draw("!#$%&*?@", 1)])

    rows, labels = [], []
    for i in range(n):
        secret, kind = i % 2, rng.integers(13 if i % 2 else 10)
        name, quote, sign = pick(NAMES), pick(["\"", "'", ""]), pick([" = ", "=", ": ", ":"])
        if secret:
            value = [lambda: draw(hexes, pick([32, 40, 40, 64])), lambda: draw(alnum, rng.integers(20, 60)),
                     lambda: "AK" + draw(upper, 18), lambda: "sk-" + draw(alnum, rng.integers(24, 48)),
                     lambda: draw(alnum + "+/", rng.integers(30, 88)) + "==", lambda: draw(hexes, 40).upper(),
                     password,
                     lambda: draw(alnum, rng.integers(8, 20)) + pick(["", "!", "@9", "%"]),
                     lambda: draw(alnum[:52], rng.integers(16, 50)), lambda: "".join(draw(alnum, 9) + "." for _ in range(rng.integers(22, 60))),
                     lambda: draw(alnum[:52], rng.integers(2, 6)) + pick(["_", "-", "_" + draw(alnum[26:52], 4) + "_"]) + draw(alnum, rng.integers(20, 48)),
                     lambda: ".".join(draw(alnum + "_-", rng.integers(14, 60)) for _ in range(3)), password][kind]()
            before = f"{prose()} {pick(['', 'my_', 'service '])}{name}{sign}{quote}"
            if kind in (10, 11) and rng.integers(3):  # such keys speak for themselves
                before = f"{prose()} {pick(['', '', quote, '('])}"
            elif kind == 12:
                before, quote = f"{prose()} {draw('abcdefgh', 5)}://{draw('etaoinshr', rng.integers(3, 9))}:", "@"
        elif kind < 2:
            value = draw(hexes, pick([32, 40, 64])) if kind else "-".join(draw(hexes, k) for k in (8, 4, 4, 4, 12))
            before = f"{prose()} {pick(HARMLESS)}{pick([' ', ': ', ' = '])}{quote}"
        elif kind == 2:
            value, before = pick(PLACEHOLDERS) + pick(["_", "-"]) + "_".join(pick(WORDS) for _ in range(3)) + pick(["1", "123", "00"]), f"{prose()} {name}{sign}{quote}"
        elif kind == 3:
            value, before = "_".join(pick(WORDS) for _ in range(rng.integers(3, 6))) + pick(["1", "2", "v2"]), f"{prose()} {pick(['', name + sign])}{quote}"
        elif kind == 4:
            value, before, quote = "/".join(draw("etaoinshr", rng.integers(3, 9)) for _ in range(4)) + str(rng.integers(1000)), f"{prose()} https://{draw('abc', 6)}.com/", ""
        elif kind == 5:
            value, before = pick([lambda: draw("etaoinshr", rng.integers(1, 12)), lambda: pick(WORDS), lambda: pick(["null", "none", "true", "false", "str", "string", "*****", "..."]),
                                  lambda: str(rng.integers(1000))])(), f"{prose()} {name}{sign}{pick([quote, ''])}"
        elif kind == 6:
            value, before, quote = pick(["os.environ[{}]", "get_{}()", "${{{}}}", "$({})", "<your-{}>", "self.{}", "config.{}.value", "{{{{ {} }}}}"]).format(
                pick([pick(WORDS), pick(WORDS).upper(), pick(NAMES).upper()])), f"{prose()} {name}{sign}", ""
        elif kind == 7:
            value, before, quote = draw("etaoinshrlducmp", rng.integers(16, 34)), f"{prose()} ", ""
        elif kind == 8:
            value, before = " ".join(draw("etaoinshr", rng.integers(2, 8)) for _ in range(rng.integers(2, 9))), f"{prose()} {name}{sign}{quote}"
        else:
            value, before = pick([draw("0123456789", rng.integers(16, 24)), draw("-=", 20) + "1", draw("etaoinshr", rng.integers(16, 40)) + "2"]), f"{prose()} "
            quote = ""
        if rng.integers(3) == 0:
            before = before.upper() if secret else before
        rows.append((value, before, f"{quote} {prose()}"))
        labels.append(secret)
    return rows, np.array(labels)


class Forest:
    """A small random forest: bootstrap rows, a random part of the features per split, Gini impurity."""

    def __init__(self, x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 8, seed: int = 11) -> None:
        self.rng, self.depth = np.random.default_rng(seed), depth
        self.tries = max(1, math.isqrt(x.shape[1]))
        self.trees = [self._grow(x[rows], y[rows], depth) for rows in (self.rng.integers(len(y), size=len(y)) for _ in range(trees))]

    def _grow(self, x, y, depth):
        share = float(y.mean())
        if depth == 0 or len(y) < 4 or share in (0.0, 1.0):
            return share
        best = None
        for f in self.rng.choice(x.shape[1], self.tries, replace=False):
            order = np.argsort(x[:, f], kind="stable")
            v, ones = x[order, f], np.cumsum(y[order])
            cut = np.flatnonzero(v[1:] > v[:-1])
            if not len(cut):
                continue
            left, hits = cut + 1, ones[cut]
            right, rest = len(y) - left, ones[-1] - hits
            impurity = hits * (left - hits) / left + rest * (right - rest) / right
            i = int(impurity.argmin())
            if best is None or impurity[i] < best[0]:
                best = (impurity[i], int(f), float((v[cut[i]] + v[cut[i] + 1]) / 2))
        if best is None:
            return share
        low = x[:, best[1]] <= best[2]
        return best[1], best[2], self._grow(x[low], y[low], depth - 1), self._grow(x[~low], y[~low], depth - 1)

    def score(self, row: list[float]) -> float:
        total = 0.0
        for node in self.trees:
            while isinstance(node, tuple):
                node = node[2] if row[node[0]] <= node[1] else node[3]
            total += node
        return total / len(self.trees)


def fit_forest(findings: int = 2400) -> Forest:
    rows, labels = labelled_findings(findings)
    return Forest(np.array([features(*r) for r in rows]), labels)


def findings(text: str | None, forest: Forest) -> list[tuple[int, int, str, float]]:
    return [(a, len(c), c, forest.score(features(c, before, after))) for a, c, before, after in candidates(text)]


def scan_secrets(docs: DataFrame, least: float = 0.5, forest: Forest | None = None) -> DataFrame:
    """Every candidate: ``doc_id, start, n_chars, kind, score, is_secret`` (start in characters; the string itself is not passed on).

    Whole texts are scanned; null and empty ones have no candidates. A null doc_id is kept. Repeated rows report each. An
    empty table gives no rows. Needs no shuffle; the forest (fitted on a bounded labelled set) is all that is sent to tasks.
    """
    forest = forest or fit_forest()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(d, a, n, "hex" if re.fullmatch("(?i)[0-9a-f]+", c) else "mixed", s)
                    for d, t in zip(batch["doc_id"], batch["text"]) for a, n, c, s in findings(t, forest)]
            yield pd.DataFrame(rows, columns=["doc_id", "start", "n_chars", "kind", "score"])

    found = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(
        scan, "doc_id string, start long, n_chars long, kind string, score double")
    return found.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("is_secret", F.col("score") >= least)


def redact_secrets(docs: DataFrame, least: float = 0.5, mark: str = "[secret]", forest: Forest | None = None) -> DataFrame:
    """``docs`` with secrets in ``text`` replaced by ``mark`` and, where there is such a column, ``n_chars`` counted anew.
    All rows and columns stay; null texts stay null."""
    forest = forest or fit_forest()

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        def one(text):
            if text is None:
                return None
            parts, at = [], 0
            for a, n, _, score in findings(text, forest):
                if score >= least:
                    parts += [text[at:a], mark]
                    at = a + n
            return "".join(parts) + text[at:] if parts else text
        return texts.map(one, na_action=None)

    cleaned = docs.withColumn("text", clean("text"))
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cleaned
