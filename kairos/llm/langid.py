"""Language identification by hierarchical discrimination.

First the language family, by one linear machine per family against the rest;
then, within the family, one-versus-one linear support vector machines between
its languages, majority vote with the margins as tie-break.  Features are
hashed byte 1- to 4-grams of the lower-cased letters of the whole text, square-root scaled,
normalised to length 1.

Fitted on at most ``max_rows`` rows (default 4,000, taken by the hash order of
their ids among the rows that are not held out): a documented bound.

Defined cases: null text and text without a letter are ``und`` with score 0;
with no learned language everything is ``und``.  A family or a family member
alone wins without a machine.  Extra columns pass through, columns named like a
result are replaced, repeated rows stay.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairos.llm.common import map_texts
from kairos.llm.quality_gam import held_out

DIM = 1 << 12
_SEG = 1 << 20
# The families of some language codes.  Other codes join the family of the learned
# language whose mean features are nearest.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "is"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca"],
    "slavic": ["ru", "pl", "cs", "uk", "bg", "sk"],
}
_LETTER = regex.compile(r"\p{L}")


def features(text: str) -> np.ndarray:
    """Hashed byte n-gram counts of the whole text, in pieces of fixed size."""
    out = np.zeros(DIM)
    for at in range(0, len(text), _SEG):
        low = text[max(0, at - 3):at + _SEG].lower().encode("utf-8", "surrogatepass")
        b = np.frombuffer(b" " + low + b" ", np.uint8).astype(np.int64)
        letter = (b >= 97) & (b <= 122) | (b >= 128)
        b[~letter] = 32
        # runs of separators become one
        b = b[np.r_[True, (b[1:] != 32) | (b[:-1] != 32)]]
        h = b
        out[:256] += np.bincount(b, minlength=256)
        for k in range(1, 4):
            if len(b) <= k:
                break
            h = h[:-1] * 257 + b[k:]
            out += np.bincount(((h * 2654435761) >> 11) % (DIM - 256) + 256, minlength=DIM)
    out[32] = 0
    out = np.sqrt(out)
    size = np.linalg.norm(out)
    return out / size if size else out


def svm(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, epochs: int = 12, seed: int = 3) -> tuple[np.ndarray, float]:
    """Linear support vector machine (hinge loss) by averaged mini-batch subgradient steps; y is +1/-1."""
    rng, n = np.random.default_rng(seed), len(y)
    weight = np.where(y > 0, n / (2 * max((y > 0).sum(), 1)), n / (2 * max((y < 0).sum(), 1)))
    w, c, t = np.zeros(x.shape[1]), 0.0, 0
    mean, mean_c = np.zeros(x.shape[1]), 0.0
    for _ in range(epochs):
        order = rng.permutation(n)
        for lo in range(0, n, 64):
            rows = order[lo:lo + 64]
            t += 1
            rate = 1.0 / (l2 * (t + 1000))
            hit = rows[(x[rows] @ w + c) * y[rows] < 1]
            w *= 1 - rate * l2
            c *= 1 - rate * l2
            if len(hit):
                push = weight[hit] * y[hit] * (rate / len(rows))
                w += push @ x[hit]
                c += push.sum()
            mean += (w - mean) / t
            mean_c += (c - mean_c) / t
    return mean, float(mean_c)


@dataclass
class Machines:
    families: list[list[str]] = field(default_factory=list)
    family_w: np.ndarray | None = None
    family_b: np.ndarray | None = None
    pairs: dict[tuple[str, str], tuple[np.ndarray, float]] = field(default_factory=dict)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.families or not _LETTER.search(text):
            return "und", 0.0
        x = features(text)
        score = 1.0
        langs = self.families[0]
        if len(self.families) > 1:
            m = self.family_w @ x + self.family_b
            e = np.exp(2 * (m - m.max()))
            k = int(np.argmax(m))
            langs, score = self.families[k], float(e[k] / e.sum())
        if len(langs) == 1:
            return langs[0], score
        votes, margins = dict.fromkeys(langs, 0), dict.fromkeys(langs, 0.0)
        for i, a in enumerate(langs):
            for b in langs[i + 1:]:
                w, c = self.pairs[a, b]
                m = float(w @ x + c)
                votes[a if m >= 0 else b] += 1
                margins[a] += m
                margins[b] -= m
        best = max(langs, key=lambda v: (votes[v], margins[v]))
        within = margins[best] / max(votes[best], 1)
        return best, score / (1 + float(np.exp(-np.clip(2 * within, -30, 30))))


def fit(x: np.ndarray, langs: list[str]) -> Machines:
    names = sorted(set(langs))
    if not names:
        return Machines()
    y = np.array(langs)
    centre = {v: x[y == v].mean(0) for v in names}
    known = {v: f for f, members in FAMILIES.items() for v in members}
    groups: dict[str, list[str]] = {}
    for v in [v for v in names if v in known]:
        groups.setdefault(known[v], []).append(v)
    for v in [v for v in names if v not in known]:
        near = max((u for u in names if u in known), key=lambda u: float(centre[u] @ centre[v]), default=None)
        groups.setdefault(known[near] if near else "other", []).append(v)
    families = [sorted(g) for g in groups.values()]
    out = Machines(families)
    if len(families) > 1:
        got = [svm(x, np.where(np.isin(y, g), 1, -1)) for g in families]
        out.family_w, out.family_b = np.stack([w for w, _ in got]), np.array([b for _, b in got])
    for g in families:
        for i, a in enumerate(g):
            for b in g[i + 1:]:
                rows = (y == a) | (y == b)
                out.pairs[a, b] = svm(x[rows], np.where(y[rows] == a, 1, -1))
    return out


def train(docs: DataFrame, max_rows: int = 4_000, text_col: str = "text", lang_col: str = "lang",
          id_col: str = "doc_id") -> Machines:
    """Fit on rows with a language that are not held out; at most ``max_rows`` of them, by hash order of their ids.

    Ids may repeat: the limit holds for the rows of the picked ids too, by id, language and features.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
    # the ids are picked first, so that the sort carries no texts
    picked = (rows.select(F.col(id_col).alias("_id")).where("_id is not null").distinct()
              .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    sample = (rows.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
              .join(F.broadcast(picked), "_id"))  # at most max_rows ids

    def make():
        def f(texts):
            ok = [bool(_LETTER.search(t)) for t in texts]
            return [[features(t).astype(np.float32).tobytes() if k else None for t, k in zip(texts, ok)]]
        return f

    made = (map_texts(sample, "_text", {"x": "binary"}, make, drop_text=True).where("x is not null")
            .orderBy(F.xxhash64("_id"), "_id", "_lang", "x").limit(max_rows).orderBy("_id", "_lang").collect())
    x = np.array([np.frombuffer(r["x"], np.float32) for r in made], dtype=np.float32).reshape(len(made), DIM)
    return fit(x, [r["_lang"] for r in made])


def identify(docs: DataFrame, model: Machines, text_col: str = "text", lang_out: str = "lang_pred",
             score_out: str = "score") -> DataFrame:
    """Add the predicted language and its score (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size: machines x feature dimensions

    def make():
        m = shared.value

        def f(texts):
            got = [m.predict(t) for t in texts]
            return [[g[0] for g in got], [g[1] for g in got]]
        return f

    return map_texts(docs, text_col, {lang_out: "string", score_out: "double"}, make)
