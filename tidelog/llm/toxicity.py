"""Toxicity: a support vector machine on a gap-tolerant string kernel, in Nyström form.

Two words are alike by the subsequences of three characters they share, each weighted by ``decay`` to the power of the length
it spans: an insult with characters put in between or left out stays near the insult. The kernel is normalised and raised to a
power (again a kernel), which keeps words apart that share no more than a syllable. A word's kernel values with the landmark words,
times the inverse root of the landmarks' own kernel matrix, are its features (Nyström); a sentence has the sum over its words.
The subsequences of all landmarks are laid out as one matrix, so a word meets every landmark in one sparse product.
"""

from __future__ import annotations

import pickle
import re
import warnings
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from itertools import combinations
from string import punctuation

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER = 3
#: Subsequences that stretch over more characters weigh next to nothing and don't count.
SPAN = 7
_EDGES = re.compile(r"^[\W\d_]+|[\W\d_]+$")
_INSIDE = re.compile(r"[^\w]+|_+")
_SPACED = re.compile(r"(?<!\S)(?:[^\W\d_][ .\-_*]){2,}[^\W\d_](?!\S)")
_SENTENCE = re.compile(r"[.!?\n]+")
_LONGEST = 24


def words_of(text: str | None) -> Counter:
    """Words in lower case without punctuation around or inside them, with their counts.

    Letters spaced out are one word. Words of more than 24 characters count as overlapping pieces of 24."""
    text = (text or "").lower()
    words: dict[str, int] = {}

    def add(word: str, n: int) -> None:
        if len(word) > _LONGEST:
            for at in range(0, len(word) - _LONGEST // 2, _LONGEST // 2):
                piece = word[at:at + _LONGEST]
                words[piece] = words.get(piece, 0) + n
        elif word:
            words[word] = words.get(word, 0) + n

    for raw, n in Counter(text.split()).items():
        word = raw if raw.isalpha() else raw.strip(punctuation)
        if not word.isalpha():
            add(_INSIDE.sub("", _EDGES.sub("", word)), n)
        elif len(word) > _LONGEST:
            add(word, n)
        else:  # most words
            words[word] = words.get(word, 0) + n
    for found in _SPACED.findall(text):
        add(re.sub(r"[ .\-_*]", "", found), 1)
    return Counter(words)


@lru_cache(maxsize=64)
def _places(length: int, decay: float) -> tuple[np.ndarray, np.ndarray]:
    places = [p for p in combinations(range(length), ORDER) if p[-1] - p[0] < SPAN]
    places = np.array(places, np.int32).reshape(-1, ORDER)
    return places, (decay ** (places[:, -1] - places[:, 0] + 1)).astype(np.float32)


def _chars(words: list[str]) -> np.ndarray:
    """Code points of words of one length, between their marks; one row per word."""
    marked = "".join(f"^{w}$" for w in words)
    return np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)


def _own_kernel(chars: np.ndarray, decay: float) -> np.ndarray:
    """The kernel of each word with itself; one row of characters per word, all of one length."""
    places, weight = _places(chars.shape[1], decay)
    letters, ids = np.unique(chars, return_inverse=True)
    ids = ids.reshape(chars.shape)
    code = np.zeros((len(chars), len(places)), np.int64)
    for k in range(ORDER):
        code = code * len(letters) + ids[:, places[:, k]]
    # The place goes along in the lowest bits, so numbers are sorted, not their order.
    bits = len(places).bit_length()
    code = np.sort((code << bits) + np.arange(len(places)), axis=1)
    code, flat = code >> bits, weight[code & ((1 << bits) - 1)].ravel()
    first = np.ones(code.shape, bool)
    first[:, 1:] = code[:, 1:] != code[:, :-1]
    starts = np.flatnonzero(first.ravel())
    squares = np.add.reduceat(flat, starts) ** 2
    return np.bincount(starts // code.shape[1], squares, len(chars))


@dataclass
class WordKernel:
    """Sums over the landmarks' subsequences, for many words at a time."""

    landmarks: list[str]
    decay: float = 0.6
    power: int = 4

    def __post_init__(self) -> None:
        self.letters = np.unique(np.concatenate([_chars([w]).ravel() for w in self.landmarks]))
        self.base = len(self.letters) + 1
        codes = [self._codes(self._ids(_chars([w]))) for w in self.landmarks]
        known = np.unique(np.concatenate([c[0][0] for c in codes]))
        self.slot = np.zeros(self.base ** ORDER, np.int32)
        self.slot[known] = np.arange(1, len(known) + 1)
        self.matrix = np.zeros((len(known) + 1, len(self.landmarks)), np.float32)
        for i, (code, weight) in enumerate(codes):
            np.add.at(self.matrix[:, i], self.slot[code[0]], weight)
        self.matrix /= np.sqrt((self.matrix ** 2).sum(0))
        self.matrix[0] = 0

    def _ids(self, chars: np.ndarray) -> np.ndarray:
        """Characters as numbers from 1; 0 for those that no landmark has."""
        at = np.searchsorted(self.letters, chars)
        return np.where(self.letters[np.minimum(at, len(self.letters) - 1)] == chars, at + 1, 0)

    def _codes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        places, weight = _places(ids.shape[1], self.decay)
        code = np.zeros((len(ids), len(places)), np.int64)
        known = np.ones_like(code, bool)
        for k in range(ORDER):
            at = ids[:, places[:, k]]
            code, known = code * self.base + at, known & (at > 0)
        return np.where(known, code, 0), weight

    def apply(self, words: list[str]) -> np.ndarray:
        """Kernel values of words (rows) with the landmarks (columns)."""
        out = np.zeros((len(words), self.matrix.shape[1]), np.float32)
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for members in by_length.values():
            for at in range(0, len(members), 256):
                part = members[at:at + 256]
                chars = _chars([words[i] for i in part])
                code, weight = self._codes(self._ids(chars))
                slots = self.slot[code]
                # A word has some seventy subsequences of the landmarks' thousands: only their rows are read.
                total = np.concatenate([weight @ self.matrix.take(slots[k:k + 32], 0, mode="clip") for k in range(0, len(part), 32)])
                cosine = total / np.sqrt(_own_kernel(chars, self.decay))[:, None]
                out[part] = reduce(np.multiply, [cosine] * self.power)
        return out


def _sentences(text: str) -> list[list[str]]:
    return [list(w) for w in (words_of(s) for s in _SENTENCE.split(text)) if w]


def _hinge(x: np.ndarray, y: np.ndarray, use: np.ndarray, rounds: int = 24, reg: float = 1e-6, seed: int = 5) -> tuple[np.ndarray, float]:
    """A linear machine for the rows ``use`` of ``x``, labelled ``y``, by averaged stochastic subgradients; both classes weigh the same."""
    rng = np.random.default_rng(seed)
    v, b, mean, mean_b, t = np.zeros(x.shape[1], np.float32), 0.0, np.zeros(x.shape[1], np.float32), 0.0, 0
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    for r in range(rounds):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 64):
            i = order[at:at + 64]
            t += 1
            step = 8 / (1 + 0.002 * t)
            rows = x[use[i]]
            bad = y[i] * (rows @ v + b) < 1
            g = weight[i] * y[i] * bad
            v = (1 - step * reg) * v + step * (g @ rows) / len(i)
            b += step * float(g.mean())
            if r >= rounds // 2:
                mean, mean_b = mean + v, mean_b + b
    n = max(1, (rounds - rounds // 2) * ((len(y) + 63) // 64))
    return mean / n, mean_b / n


@dataclass
class ToxicityModel:
    kernel: WordKernel
    table: np.ndarray
    over: list[float]
    doc_weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def word_scores(self, words: list[str]) -> np.ndarray:
        return self.kernel.apply(words) @ self.table

    def learn(self, documents: list[Counter], known: dict[str, float]) -> None:
        """Add the scores of the words that are new."""
        new = list(dict.fromkeys(w for counts in documents for w in counts if w not in known))
        known.update(zip(new, self.word_scores(new).tolist()))

    def set_thresholds(self, clean: list[Counter], known: dict[str, float]) -> None:
        """Words score high if few words of clean texts do: at several shares, from common to rare."""
        scores = [known[w] for w in {w for c in clean for w in c}] or [0.0]
        self.over = [float(np.quantile(scores, share)) for share in (0.99, 0.998, 0.9995)]

    def features(self, counts: Counter, known: dict[str, float]) -> np.ndarray:
        """Of a document: its best words and how many, absolutely and relatively, score high."""
        total, least = max(1, sum(counts.values())), self.over[0]
        scores = [known[w] for w in counts]
        top = sorted(((s, n) for s, n in zip(scores, counts.values()) if s > least), reverse=True)
        best = [s for s, n in top for _ in range(min(n, 5))][:5]
        hits = [sum(n for s, n in top if s > over) for over in self.over]
        return np.array([max(scores, default=0.0), sum(best) / 5, *np.log1p(hits), *np.log1p(1000 * np.array(hits) / total)])

    def scores(self, texts: list[str | None], known: dict[str, float], at_once: int = 200) -> list[float]:
        out: list[float] = []
        for at in range(0, len(texts), at_once):
            documents = [words_of(t) for t in texts[at:at + at_once]]
            if len(known) > 300_000:  # a cache only
                known.clear()
            self.learn(documents, known)
            x = (np.stack([self.features(c, known) for c in documents]) - self.centre) / self.scale
            out += (1 / (1 + np.exp(-np.clip(x @ self.doc_weights[1:] + self.doc_weights[0], -30, 30)))).tolist()
        return out


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, reg: float = 1e-4) -> np.ndarray:
    """Logistic weights for weighted rows, none below 0 but the constant: more or higher hits never make a text less toxic."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    step = 4 / np.linalg.eigvalsh((x * weight[:, None]).T @ x)[-1]
    for _ in range(3000):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= step * (x.T @ (weight * (p - y)) + reg * w)
        w[1:] = np.maximum(w[1:], 0)
    return w


def _spread(ranked: list[str], n: int, decay: float, apart: float = 0.75) -> list[str]:
    """The first ``n`` words none of which is nearer to an earlier one than ``apart``."""
    near = WordKernel(ranked, decay, 1).apply(ranked)
    chosen: list[int] = []
    for i in range(len(ranked)):
        if len(chosen) < n and (not chosen or near[i, chosen].max() < apart):
            chosen.append(i)
    return [ranked[i] for i in chosen]


def fit(texts: list[str], labels: list[int], landmarks: int = 128, decay: float = 0.6, power: int = 4,
        rounds: int = 3, prior: float | None = None) -> ToxicityModel | None:
    """Fit on labelled texts. ``prior`` is the share of toxic texts where it isn't that of the sample.

    Only texts are labelled, so sentences are labelled in turns: those of a toxic text that score highest stand for it, those of
    clean texts are all negative. Sentences are fitted on each half of the texts (split by CRC-32), the step per document on what they make of
    the other half; words have the mean of both scores.

    None, with a warning, where labels are unusable: a class is missing or without words in the fitted half, or nothing
    tells the classes apart.
    """
    y = np.array(labels)
    one: dict[str, str] = {}  # a word is held once, not once per text
    counts = [{one.setdefault(w, w): n for w, n in words_of(t).items()} for t in texts]
    if len({k for c, k in zip(counts, labels) if any(len(w) >= 2 for w in c)}) < 2:
        return _unusable("a class has no text with words")
    # Of rising share among toxic texts: a z-score of document frequencies, smoothed.
    seen = {k: Counter(w for c, label in zip(counts, labels) if label == k for w in c) for k in (0, 1)}
    n0, n1 = int((y == 0).sum()), int((y == 1).sum())

    def rise(w: str) -> float:
        a, b = seen[1][w], seen[0][w]
        p = (a + b + 1) / (n0 + n1 + 2)
        return (a / n1 - b / n0) / np.sqrt(p * (1 - p) * (1 / n0 + 1 / n1))

    vocabulary = sorted(w for w in seen[1] | seen[0] if len(w) >= 2)
    ranked = sorted(vocabulary, key=lambda w: (-rise(w), w))
    rng = np.random.default_rng(3)
    rest = ranked[landmarks // 2:]
    chosen = _spread(ranked[:8 * landmarks], landmarks // 2, decay)
    chosen += [rest[i] for i in rng.choice(len(rest), min(len(rest), landmarks // 2), replace=False) if rest[i] not in set(chosen)]
    kernel = WordKernel(chosen, decay, power)
    values, vectors = np.linalg.eigh(kernel.apply(chosen).astype(np.float64))
    root = ((vectors / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T).astype(np.float32)

    words = sorted({w for c in counts for w in c})
    at = {w: k for k, w in enumerate(words)}
    values = kernel.apply(words)  # once for all that follows

    # Sentences of one half of the texts are fitted, the other half tells what their scores say about a document; and the other way round.
    half = np.array([zlib.crc32((t or "").encode("utf-8", "surrogatepass")) % 2 == 0 for t in texts])
    marked = set(ranked[:2 * landmarks])
    models, x, of = [], [], []
    for mine in (half, ~half):
        v = _sentence_machine([texts[i] for i in np.flatnonzero(mine)], y[mine], values, at, root, marked, rounds)
        if v is None:
            continue
        model = ToxicityModel(kernel, root @ v, [], np.zeros(1), np.zeros(1), np.ones(1))
        known = dict(zip(words, (values @ model.table).tolist()))
        model.set_thresholds([counts[i] for i in np.flatnonzero(mine & (y == 0))], known)
        other = np.flatnonzero(~mine)
        models.append(model)
        x += [model.features(counts[i], known) for i in other]
        of += other.tolist()
    if not models or len(set(y[of])) < 2:
        return _unusable("too few labelled texts with words")
    z, label = np.stack(x), y[of]
    model = ToxicityModel(kernel, np.mean([m.table for m in models], axis=0), [], z.mean(0), z.std(0) + 1e-9, np.ones(1))
    model.set_thresholds([c for c, k in zip(counts, y) if k == 0], dict(zip(words, (values @ model.table).tolist())))
    share = label.mean()
    prior = share if prior is None else prior
    model.doc_weights = _logistic((z - model.centre) / model.scale, label, np.where(label == 1, prior / share, (1 - prior) / (1 - share)))
    if not model.doc_weights[1:].any():
        return _unusable("the words of the labelled texts don't tell the classes apart")
    return model


def _unusable(why: str) -> None:
    warnings.warn(f"no toxicity model: {why}; every score is 0", stacklevel=3)


def _sentence_machine(texts: list[str], y: np.ndarray, values: np.ndarray, at: dict[str, int], root: np.ndarray, marked: set[str],
                      rounds: int) -> np.ndarray | None:
    """Weights of the landmark features, from sentences that get their labels in turns; None if a class has no sentence.
    ``values`` are the kernel values of all words, ``at`` their rows."""
    owners, sentences = [], []  # words as rows of ``values``
    for i, text in enumerate(texts):
        for s in _sentences(text or ""):
            known = np.array([at[w] for w in s if w in at], np.int32)
            if len(known):
                owners.append(i)
                sentences.append(known)
    if len(set(y[owners])) < 2:
        return None
    x = np.empty((len(sentences), values.shape[1]), np.float32)
    for k, s in enumerate(sentences):
        x[k] = values[s].sum(0) / np.sqrt(len(s))
    for k in range(0, len(x), 4096):
        x[k:k + 4096] = x[k:k + 4096] @ root
    owners = np.array(owners)
    toxic = y[owners] == 1
    telling = np.zeros(len(values), bool)
    telling[[at[w] for w in marked if w in at]] = True
    positive = toxic & np.array([telling[s].any() for s in sentences])
    if not positive.any():
        positive = toxic
    for _ in range(rounds):
        use = np.flatnonzero(positive | ~toxic)
        v, b = _hinge(x, np.where(positive[use], 1.0, -1.0), use)
        scores = x @ v + b
        positive = toxic & (scores > 0)
        best: dict[int, int] = {}
        for k in np.flatnonzero(toxic):
            if owners[k] not in best or scores[k] > scores[best[owners[k]]]:
                best[owners[k]] = k
        positive[list(best.values())] = True
    return v


def fit_on(docs: DataFrame, labels: DataFrame, per_class: int = 1500, most_chars: int = 20_000, **how) -> ToxicityModel | None:
    """Fit on a bounded sample of labelled documents outside the held-out fold (crc32(doc_id) mod 5 = 0).

    The sample are the ``per_class`` ids of each class with the least MD5; texts above ``most_chars`` are left out of it. Of several texts under
    one id one is taken, the same in every run. Null texts, labels other than 0 and 1 and labels without a document are left out. Unusable labels: see ``fit``.
    """
    label = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    label = label.where(~held_out(F.col("doc_id"))).withColumn("order", F.md5(F.col("doc_id").cast("string")))
    ids = [label.where(F.col("label") == k).orderBy("order", "doc_id").limit(per_class) for k in (0, 1)]
    # At most 2 * per_class rows, by the limits above.
    sample = docs.select("doc_id", "text").where(F.length("text") <= most_chars).join(F.broadcast(ids[0].unionByName(ids[1])), "doc_id")
    # Of texts under one id the one with the least MD5.
    rows = sample.groupBy("order").agg(F.min(F.struct(F.md5("text").alias("digest"), "text", "label")).alias("r")).select("order", "r.text", "r.label")
    prior = label.agg(F.avg("label").alias("p")).collect()[0]["p"]  # of all labelled rows, not of the balanced sample
    fitted = rows.repartition(1).mapInPandas(_fit_in_task(prior, how), "model binary, said array<string>").collect()
    for why in fitted[0]["said"] if fitted else []:
        warnings.warn(why, stacklevel=2)
    return pickle.loads(fitted[0]["model"]) if fitted else None


def _fit_in_task(prior: float | None, how: dict):
    """The fit takes some hundred MB beside the sample, which a task has and the driver needs for its plans; the model is 2 MB."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        rows = pd.concat(parts).sort_values("order")
        with warnings.catch_warnings(record=True) as said:
            warnings.simplefilter("always")
            model = fit(rows["text"].tolist(), rows["label"].tolist(), prior=prior, **how)
        yield pd.DataFrame({"model": [pickle.dumps(model)], "said": [[str(w.message) for w in said if w.category is UserWarning]]})

    return run


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def score_toxicity(docs: DataFrame, model: ToxicityModel | None) -> DataFrame:
    """``docs`` with a last column ``__toxicity`` in [0, 1]; no shuffle, whole texts, only the text is looked at.

    A null text scores like an empty one. Without a model (see ``fit``) every score is 0. All rows stay.
    """
    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, float] = {}
        for texts in batches:
            yield pd.Series([0.0] * len(texts) if model is None else model.scores(list(texts), known), dtype="float64")

    return docs.withColumn("__toxicity", scores("text"))
