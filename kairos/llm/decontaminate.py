"""Benchmark decontamination by spaced-seed hashing.

Words (runs of letters and digits, lower case) of benchmark items and documents
are hashed under fixed masks.  A mask looks at some positions of a run and
ignores the others, so a hit survives substituted words at ignored places.  Equal
mask hashes join items and documents, and each hit's diagonal is compared word by
word: an item is found where, on one diagonal, some run of ``window`` aligned
words (the whole item if shorter) agrees in at least ``share`` of them.

``MASKS`` miss nothing: however a fifth of 9 to 13 words is substituted, one of
the masks fits in between at some place.  They hold for a window of 9 to 13
words and a share of 0.8 or more.  Items under ``SPAN`` words have masks of their whole
length, one for each allowed choice of substituted words.

The benchmark side is broadcast in blocks of at most ``block_chars`` characters:
the size is measured first, a larger benchmark takes more passes over the
documents.  Documents are never shuffled.

Defined cases: null or wordless texts match nothing, on either side.  Items under
five words are found verbatim only.  Repeated items and documents are each reported.  Null ids are carried.  An empty benchmark finds nothing.
"""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairos.llm.common import _MULT, ALNUM, batch_words, map_texts, mix64

#: word positions a mask looks at, for items of SPAN words or more
MASKS = ["111011", "11000111", "110100011"]
SPAN = 9
_BITS = 22


def masks_of(n: int, share: float) -> list[str]:
    """Masks under which items of ``n`` words are hashed."""
    if n >= SPAN:
        return MASKS
    return ["".join("0" if i in gone else "1" for i in range(n)) for gone in combinations(range(n), n - math.ceil(share * n - 1e-9))]


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the looked-at words at every position."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return words[:0]
    h = np.full(n, np.uint64(int("1" + mask, 2) * 0xA24BAED4963EE407 % 2**64), dtype=np.uint64)
    for j, c in enumerate(mask):
        if c == "1":
            h += words[j:j + n] * _MULT[j]
    return mix64(h)


def _words(texts: list) -> list[np.ndarray]:
    return batch_words([t.lower() if t else t for t in texts], ALNUM)


class Index:
    """Seeds of one block of items: sorted hashes, where they come from, and a bit filter in front."""

    def __init__(self, items: list[tuple[object, str]], share: float = 0.8):
        self.ids = [i for i, _ in items]
        self.words = _words([t for _, t in items])
        self.masks = sorted({m for n in {len(w) for w in self.words} if n for m in masks_of(n, share)})
        hashes, owner, place = [], [], []
        for i, w in enumerate(self.words):
            for m in masks_of(len(w), share) if len(w) else ():
                h = seeds(w, m)
                hashes.append(h)
                owner.append(np.full(len(h), i))
                place.append(np.arange(len(h)))
        h = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hashes = h[order]
        self.owner = np.concatenate(owner)[order] if hashes else order
        self.place = np.concatenate(place)[order] if hashes else order
        self.filter = np.zeros(1 << _BITS, dtype=bool)
        self.filter[(self.hashes >> np.uint64(64 - _BITS)).astype(np.intp)] = True

    def diagonals(self, words: np.ndarray) -> dict[int, set[int]]:
        """Item -> offsets of its start in the document, from seed hits."""
        found: dict[int, set[int]] = defaultdict(set)
        for m in self.masks:
            h = seeds(words, m)
            at = np.flatnonzero(self.filter[(h >> np.uint64(64 - _BITS)).astype(np.intp)])
            if not len(at):
                continue
            lo = np.searchsorted(self.hashes, h[at], "left")
            hi = np.searchsorted(self.hashes, h[at], "right")
            for p, a, b in zip(at.tolist(), lo.tolist(), hi.tolist()):
                for o, q in zip(self.owner[a:b].tolist(), self.place[a:b].tolist()):
                    found[o].add(p - q)
        return found

    def hits(self, words: np.ndarray, window: int, share: float) -> list[dict]:
        """Verified overlaps: item, word span in the document, words compared and equal."""
        out = []
        for o, offsets in sorted(self.diagonals(words).items()):
            item = self.words[o]
            need = min(window, len(item))
            for d in sorted(offsets):
                a, b = max(0, d), min(len(words), d + len(item))
                if b - a < need:
                    continue
                same = words[a:b] == item[a - d:b - d]
                total = np.concatenate(([0], np.cumsum(same)))
                runs = np.flatnonzero(total[need:] - total[:-need] >= share * need - 1e-9)
                if len(runs):
                    lo, hi = int(runs[0]), int(runs[-1]) + need
                    out.append({"item_id": self.ids[o], "first_word": a + lo, "last_word": a + hi - 1,
                                "n_matched": int(total[hi] - total[lo])})
        return out


def _blocks(bench: DataFrame, id_col: str, text_col: str, block_chars: int):
    """The items in blocks whose size is checked before they reach the driver."""
    items = bench.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t is not null")
    size = items.agg(F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("n")).first()["n"]
    n = -(-size // block_chars)
    for k in range(n):
        yield [(r["i"], r["t"]) for r in items.where(F.pmod(F.xxhash64("t"), F.lit(n)) == k).orderBy("i", "t").collect()]


def mark(docs: DataFrame, bench: DataFrame, out_col: str = "hits", text_col: str = "text", item_col: str = "item_id",
         bench_text: str = "text", window: int = 13, share: float = 0.8, block_chars: int = 20_000_000) -> DataFrame:
    """Add an array of verified overlaps with benchmark items (empty: none); other columns pass through."""
    kind = bench.schema[item_col].dataType.simpleString()
    spark_type = f"array<struct<item_id:{kind},first_word:bigint,last_word:bigint,n_matched:bigint>>"
    out = docs.withColumn(out_col, F.expr(f"cast(array() as {spark_type})"))
    for items in _blocks(bench, item_col, bench_text, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(Index(items, share))  # at most block_chars characters of items

        def make(shared=shared):
            index = shared.value
            return lambda texts: [[index.hits(w, window, share) for w in _words(texts)]]

        out = map_texts(out, text_col, {"_kl_found": spark_type}, make)
        out = out.withColumn(out_col, F.concat(out_col, "_kl_found")).drop("_kl_found")
    return out


def overlaps(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per document, item and place of an overlap."""
    found = mark(docs, bench, out_col="_kl_hits", **options)
    return found.select(F.col(id_col), F.explode("_kl_hits").alias("h")).select(id_col, "h.*")


def clean(docs: DataFrame, bench: DataFrame, **options) -> DataFrame:
    """Documents without any overlap, with their columns."""
    return mark(docs, bench, out_col="_kl_hits", **options).where(F.size("_kl_hits") == 0).select(*docs.columns)
