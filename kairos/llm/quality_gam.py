"""Quality classifier: generalised additive model with pairwise interactions.

Every feature has a lookup table over quantile bins, and the strongest pairs of
features a table over bin pairs.  Training cycles over the features; each visit
fits one shallow tree (at most three leaves on one feature, four on a pair) to
the current residuals and adds it, shrunk, to that table.  A score is the sum
of table entries, i.e. vectorised bin lookups, through a logistic link.

Features are counts and ratios of the whole text.  Labels, language, source and
ids are never inputs.  The model is fitted on at most ``max_rows`` labelled
rows (default 20,000, taken by the hash order of their ids): a documented bound,
so the fit costs the same at any corpus size.

Defined cases: null and empty text have all-zero features and get a score like
any other.  Without labels of both classes every score is the share of label 1
(0.5 without labels).  Conflicting labels of an id all count.  Extra columns
pass through, columns named like a result are replaced, repeated rows stay.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairos.llm.common import map_texts

FEATURES = ["log_chars", "log_words", "word_len", "distinct_words", "top_word", "repeat_next", "distinct_pairs",
            "upper", "digits", "symbols", "bars", "stops", "commas", "non_ascii", "log_lines", "line_len",
            "distinct_lines", "marked_words", "longest_word", "short_words"]
_SYMBOLS = b"#$%&*!@^~=<>{}\\/_+"
_CLASS = np.zeros(256, dtype=np.intp)
for _i, _set in enumerate([bytes(range(65, 91)), b"0123456789", _SYMBOLS, b"|", b".?", b",;:", bytes(range(128, 192))], 1):
    _CLASS[list(_set)] = _i


def features(text: str | None) -> list[float]:
    """Counts and ratios of one whole text."""
    if not text:
        return [0.0] * len(FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    kinds = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=8)
    words, lines = text.split(), text.split("\n")
    n, nl, nb = len(words), len(lines), len(raw)
    if n:
        seen = Counter(words)
        nexts = list(zip(words, words[1:]))
        same = sum(a == b for a, b in nexts) / max(len(nexts), 1)
        pairs = len(set(nexts)) / max(len(nexts), 1)
        marked = sum(not w[-1].isalnum() for w in words) / n
        sizes = list(map(len, words))
        top, distinct, longest, short = max(seen.values()) / n, len(seen) / n, max(sizes), sum(s <= 3 for s in sizes) / n
    else:
        same = pairs = marked = top = distinct = longest = short = 0.0
    return [math.log1p(len(text)), math.log1p(n), len(text) / max(n, 1), distinct, top, same, pairs,
            *(kinds[i] / nb for i in range(1, 8)), math.log1p(nl), math.log1p(nb / nl), len(set(lines)) / nl,
            marked, math.log1p(longest), short]


@dataclass
class Gam:
    """Bin edges, one table per feature and one per pair."""

    base: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def codes(self, x: np.ndarray) -> np.ndarray:
        if not self.edges:
            return np.zeros((0, len(x)), dtype=np.intp)
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)])

    def logits(self, x: np.ndarray) -> np.ndarray:
        c = self.codes(x)
        out = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            out += t[c[j]]
        for (i, j), t in zip(self.pairs, self.pair_tables):
            out += t[c[i], c[j]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x), -40, 40)))


def _best_cut(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, int]:
    """Gain and place of the best cut of a run of bins (0: none)."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = gl**2 / (hl + l2) + (g.sum() - gl)**2 / (h.sum() - hl + l2) - g.sum()**2 / (h.sum() + l2)
    at = int(np.argmax(gain))
    return (float(gain[at]), at + 1) if gain[at] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    """Leaf values per bin of a tree with at most three leaves."""
    cuts = [0, len(g)]
    for _ in range(2):
        found = [(*_best_cut(g[a:b], h[a:b], l2), a) for a, b in zip(cuts, cuts[1:])]
        gain, at, start = max(found)
        if not gain:
            break
        cuts = sorted([*cuts, start + at])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + l2)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    """Leaf values of a depth-two tree over a bin grid: one cut by rows, then one by columns in each half."""
    _, at = _best_cut(g.sum(1), h.sum(1), l2)
    out = np.zeros_like(g)
    for rows in ([slice(0, at), slice(at, None)] if at else [slice(None)]):
        gc, hc = g[rows].sum(0), h[rows].sum(0)
        _, c = _best_cut(gc, hc, l2)
        for cols in ([slice(0, c), slice(c, None)] if c else [slice(None)]):
            out[rows, cols] = gc[cols].sum() / (hc[cols].sum() + l2)
    return out


def fit(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 60, pair_rounds: int = 20, n_pairs: int = 6,
        rate: float = 0.2, l2: float = 2.0) -> Gam:
    """Cyclic boosting of the tables, mains first, then the pairs that explain the residuals best."""
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Gam(math.log(share / (1 - share)))
    share = float(y.mean())
    gam = Gam(math.log(share / (1 - share)))
    gam.edges = [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins)) for j in range(x.shape[1])]
    sizes = [len(e) + 1 for e in gam.edges]
    gam.tables = [np.zeros(s) for s in sizes]
    c = gam.codes(x)
    logit = np.full(len(y), gam.base)
    for _ in range(rounds):
        for j, s in enumerate(sizes):
            p = 1 / (1 + np.exp(-logit))
            step = rate * _tree(np.bincount(c[j], y - p, s), np.bincount(c[j], p * (1 - p), s), l2)
            gam.tables[j] += step
            logit += step[c[j]]

    def grids(i, j, p):
        flat, shape = c[i] * sizes[j] + c[j], (sizes[i], sizes[j])
        size = sizes[i] * sizes[j]
        return np.bincount(flat, y - p, size).reshape(shape), np.bincount(flat, p * (1 - p), size).reshape(shape)

    p = 1 / (1 + np.exp(-logit))
    gains = []
    for i in range(len(sizes)):
        for j in range(i + 1, len(sizes)):
            g, h = grids(i, j, p)
            v = _pair_tree(g, h, l2)
            gains.append((float((g * v).sum()), i, j))
    gam.pairs = [(i, j) for _, i, j in sorted(gains, reverse=True)[:n_pairs]]
    gam.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in gam.pairs]
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(gam.pairs):
            p = 1 / (1 + np.exp(-logit))
            step = rate * _pair_tree(*grids(i, j, p), l2)
            gam.pair_tables[k] += step
            logit += step[c[i], c[j]]
    return gam


def _featurise():
    return lambda texts: [[features(t) for t in texts]]


def held_out(col: str = "doc_id"):
    """Rows kept out of every fit: crc32 of the id as text, mod 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, label: str = "quality",
          text_col: str = "text", id_col: str = "doc_id") -> Gam:
    """Fit on labelled rows that are not held out; at most ``max_rows`` of them, by hash order of their ids.

    Ids that repeat in either table give a row for each meeting; the limit holds after the join, by id, label and features.
    """
    known = (labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
             .select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_y"))
             .orderBy(F.xxhash64("_id"), "_id", "_y").limit(max_rows))
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .join(F.broadcast(known), "_id"))  # at most max_rows rows of two numbers
    made = (map_texts(rows, "_text", {"x": "array<double>"}, _featurise, drop_text=True)
            .orderBy(F.xxhash64("_id"), "_id", "_y", "x").limit(max_rows).orderBy("_id", "_y").collect())
    x = np.array([r["x"] for r in made], dtype=float).reshape(len(made), len(FEATURES))
    return fit(x, np.array([r["_y"] for r in made], dtype=float))


def score(docs: DataFrame, model: Gam, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """Add the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: bins x features and pairs

    def make():
        gam = shared.value
        return lambda texts: [gam.score(np.array([features(t) for t in texts]).reshape(len(texts), len(FEATURES)))]

    return map_texts(docs, text_col, {out_col: "double"}, make)


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """All columns of ``docs`` plus score, predicted and held_out."""
    return (score(docs, train(docs, labels, max_rows))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
            .withColumn("held_out", held_out()))
