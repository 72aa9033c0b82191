"""Source divergence audit: how differently the sources of a language use its terms.

Terms are runs of ASCII letters (A-Z lowered) and non-ASCII characters; a language
keeps the V terms found in at least ``min_docs`` of its documents.  A group (language,
source), and each language as a whole, gives a kept term ``p = 1 + floor(10^9 (count + 1) / (N + V))``,
N being the group's occurrences of kept terms.  Two distributions differ on a term
by ``f(p, q) = floor((p - q)^2 / q)``.

* ``pair``: for every other source of the language the sum of f over *all* kept terms.
  A source without a term still has its base value p0 there, so the sum is taken apart:
  V times f of the two base values; a correction for every count of either source against the
  other's base value; and for terms that both sources use a correction of the two.  The last
  ones come from a frequent-pattern tree: a term is the path of its nonzero
  counts, sources in order; equal paths meet first, then paths sorted by prefix are inserted
  with their multiplicities, and each node-ancestor combination gives its correction
  once, times the terms through the node.  Trees are cut at a number of nodes, as corrections add up.
* ``term``: the ``top`` terms that a source uses more than its language does, by f.

All arithmetic is exact (64-bit with split sums in the trees, decimals in Spark).

Corner cases: null text, language and source read as ''; every occurring group is reported, with value 0
where its language keeps no terms; repeated rows are documents of their own; an empty table gives no
rows; other columns are not read.  A document's terms are counted together, whatever its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kairos.llm.common import arrow_slices, materialise
from kairos.llm.words import Vocabulary, fold_table, token_blocks

SCALE = 1_000_000_000
#: everything but ASCII letters and non-ASCII bytes separates terms
FOLD = fold_table(bytes([*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
MAX_ROWS, MAX_TERMS = 1_500_000, 1 << 20
MAX_NODES = 200_000


# ---------------------------------------------------------------- counts of terms per group
class TermCounter:
    """Occurrences and documents per (group, term) of a task's documents, up to the next ``take``."""

    def __init__(self):
        self._clear()

    def _clear(self):
        self.vocabulary, self.groups = Vocabulary(), {}
        self.raw, self.rows = [], 0
        self.done = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, groups: list[tuple], texts: list) -> bool:
        """Count whole documents; true when the counts should be taken."""
        data = b"".join(t.translate(FOLD) + b"\n" for t in texts if t)  # no text holds a line feed any more
        ids = [self.vocabulary.numbers(tokens) for tokens in token_blocks(data)]
        ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        end = ids == 0
        doc = (np.cumsum(end) - end)[~end]
        # one row per document and term
        pairs, n = np.unique((doc << 32) | ids[~end], return_counts=True)
        of = np.array([self.groups.setdefault(g, len(self.groups)) for g, t in zip(groups, texts) if t], np.int64)
        if len(pairs):
            self.raw.append(((of[pairs >> 32] << 32) | (pairs & 0xFFFFFFFF), n, np.ones(len(pairs), np.int64)))
            self.rows += len(pairs)
        if self.rows > MAX_ROWS or len(self.vocabulary) > MAX_TERMS:
            self._settle()
        return len(self.done[0]) > MAX_ROWS or len(self.vocabulary) > MAX_TERMS

    def _settle(self):
        keys, n, d = (np.concatenate([old, *new]) for old, new in zip(self.done, zip(*self.raw) if self.raw else ([], [], [])))
        order = np.argsort(keys, kind="stable")
        keys, n, d = keys[order], n[order], d[order]
        if len(keys):
            first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            keys, n, d = keys[first], np.add.reduceat(n, first), np.add.reduceat(d, first)
        self.done, self.raw, self.rows = (keys, n, d), [], 0

    def take(self):
        """(lang, source, term, occurrences, documents) columns since the last call."""
        self._settle()
        keys, n, d = self.done
        groups, spelt = list(self.groups), list(self.vocabulary)
        at = (keys >> 32).tolist()
        out = ([groups[g][0] for g in at], [groups[g][1] for g in at], [spelt[t] for t in (keys & 0xFFFFFFFF).tolist()], n, d)
        self._clear()
        return out


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, d): occurrences and documents per group, counted within tasks first."""
    def run(batches):
        counter = TermCounter()

        def rows():
            *names, n, d = counter.take()
            for s in range(0, len(n), 100_000):
                cols = [pa.array(x[s:s + 100_000], t) for x, t in zip(names, (pa.string(), pa.string(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n[s:s + 100_000]), pa.array(d[s:s + 100_000])],
                                                 names=["lang", "source", "term", "n", "d"])

        for part in arrow_slices(batches):
            groups = list(zip(part.column("lang").to_pylist(), part.column("source").to_pylist()))
            if counter.add(groups, part.column("text").to_pylist()):
                yield from rows()
        yield from rows()

    return (docs.mapInArrow(run, "lang string, source string, term binary, n long, d long")
            .groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("d").alias("d")))


# ---------------------------------------------------------------- the tree
class PatternTree:
    """Prefix tree of paths of (source, p, base value) with multiplicities; one language at a time."""

    def __init__(self):
        self.child: dict[tuple, int] = {}
        self.parent, self.source, self.p, self.base, self.terms = [], [], [], [], []

    def __len__(self):
        return len(self.parent)

    def insert(self, sources: list, ps: list, bases: list, terms: int):
        at = -1
        for s, p, b in zip(sources, ps, bases):
            key = at, s, p
            found = self.child.get(key)
            if found is None:
                self.child[key] = found = len(self.parent)
                for values, x in ((self.parent, at), (self.source, s), (self.p, p), (self.base, b), (self.terms, 0)):
                    values.append(x)
            at = found
            self.terms[at] += terms

    def corrections(self) -> dict[tuple[int, int], int]:
        """Sum over terms of the corrections of each ordered pair of sources, in whole numbers."""
        parent, source, p, base, terms = (np.array(x, np.int64) for x in (self.parent, self.source, self.p, self.base, self.terms))
        total: dict[tuple[int, int], int] = {}
        node = np.flatnonzero(parent >= 0)
        up = parent[node]
        while len(node):
            for a, b in ((node, up), (up, node)):
                # |value| < 2**62: it is split, so that sums over a tree's terms stay exact
                value = (difference(p[a], p[b]) - difference(p[a], base[b]) - difference(base[a], p[b]) + difference(base[a], base[b]))
                pair, at = np.unique((source[a] << 32) | source[b], return_inverse=True)
                high, low = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
                np.add.at(high, at, (value >> 31) * terms[node])
                np.add.at(low, at, (value & 0x7FFFFFFF) * terms[node])
                for key, h, w in zip(pair.tolist(), high.tolist(), low.tolist()):
                    key = key >> 32, key & 0xFFFFFFFF
                    total[key] = total.get(key, 0) + (h << 31) + w
            up = parent[up]
            node, up = node[up >= 0], up[up >= 0]
        return total


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """f(p, q) in 64 bits: both are at most 10^9 + 1."""
    return (p - q) ** 2 // q


def tree_corrections(paths: DataFrame) -> DataFrame:
    """(lang, a, b, value) sums of the pair corrections; ``paths`` (lang, sources, ps, bases, terms) sorted by prefix."""
    def run(batches):
        tree, lang, n = PatternTree(), None, 0

        def rows():
            got = tree.corrections()
            pairs = list(got)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(pairs), pa.string()), pa.array([a for a, _ in pairs], pa.int32()),
                 pa.array([b for _, b in pairs], pa.int32()), pa.array([str(got[k]) for k in pairs], pa.string())],
                names=["lang", "a", "b", "value"])

        for part in arrow_slices(batches):
            for of, sources, ps, bases, terms in zip(*(part.column(c).to_pylist() for c in ("lang", "sources", "ps", "bases", "terms"))):
                if of != lang or len(tree) > MAX_NODES or n + terms > 1 << 24:
                    if len(tree):
                        yield rows()
                    tree, lang, n = PatternTree(), of, 0
                while terms:  # a tree's terms are bounded too, which keeps its sums within 64 bits
                    now = min(terms, 1 << 24)
                    tree.insert(sources, ps, bases, now)
                    terms, n = terms - now, n + now
                    if terms:
                        yield rows()
                        tree, n = PatternTree(), 0
        if len(tree):
            yield rows()

    return (paths.mapInArrow(run, "lang string, a int, b int, value string")
            .select("lang", "a", "b", F.col("value").cast("decimal(38,0)").alias("value")))


# ---------------------------------------------------------------- the audit
def _p(count: str, n: str, v: str):
    """1 + floor(10^9 (count + 1) / (n + v)), in decimals."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * (cast({count} as decimal(19,0)) + 1)) div cast({n} + {v} as decimal(38,0))")


def _f(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div ({q}))"


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): see the module."""
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                      F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), F.col(text_col).cast("binary").alias("text"))
    # a kept term with its counts per source
    terms = materialise(term_counts(src).groupBy("lang", "term")
                        .agg(F.collect_list(F.struct("source", "n")).alias("used"), F.sum("d").alias("d"), F.sum("n").alias("total"))
                        .where(F.col("d") >= min_docs).select("lang", "term", "total", "used"))
    used = terms.select("lang", "term", "total", F.inline("used"))
    size = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("all_n"))
    groups = (src.select("lang", "source").distinct().join(used.groupBy("lang", "source").agg(F.sum("n").alias("gn")), ["lang", "source"], "left")
              .join(size, "lang", "left").na.fill(0, ["gn", "v", "all_n"])
              .withColumn("base", F.when(F.col("v") > 0, _p("0", "gn", "v")))
              .withColumn("id", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("gn"), "source"))))
    groups = materialise(groups)
    rows = (used.join(groups, ["lang", "source"]).withColumn("p", _p("n", "gn", "v"))
            .select("lang", "term", "source", "id", "p", "base", _p("total", "all_n", "v").alias("q")))
    return _term_part(rows, top).unionByName(_pair_part(rows, groups))


def _ranked():
    return F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))


def _term_part(rows: DataFrame, top: int) -> DataFrame:
    found = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), F.expr(_f("p", "q")).alias("value"))
    return (found.withColumn("rank", _ranked()).where(F.col("rank") <= top)
            .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))


def _pair_part(rows: DataFrame, groups: DataFrame) -> DataFrame:
    a = groups.select("lang", F.col("source"), F.col("id").alias("a"), F.col("base").alias("pa"), "v")
    b = groups.select("lang", F.col("source").alias("item"), F.col("id").alias("b"), F.col("base").alias("pb"))
    pairs = a.join(b, "lang").where("a != b")  # the report itself has a row for each of these
    whole = "cast({} as decimal(19,0))"
    both_base = pairs.select("lang", "a", "b", F.expr(f"coalesce({whole.format('v')} * {whole.format(_f('pa', 'pb'))}, 0)").cast("decimal(38,0)").alias("value"))

    # one side uses the term: per (source, p) the number of terms, against the other sources' base values
    alone = rows.groupBy("lang", "id", "p", "base").agg(F.count("*").alias("m"))
    others = groups.select("lang", F.col("id").alias("other"), F.col("base").alias("other_base"))
    met = alone.join(others, "lang").where("id != other")
    def times(x):
        return F.expr(f"{whole.format('m')} * {whole.format(x)}").cast("decimal(38,0)").alias("value")
    left = met.select("lang", F.col("id").alias("a"), F.col("other").alias("b"),
                      times(_f("p", "other_base") + " - " + _f("base", "other_base")))
    right = met.select("lang", F.col("other").alias("a"), F.col("id").alias("b"),
                       times(_f("other_base", "p") + " - " + _f("other_base", "base")))

    # both use it: the tree
    path = (rows.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("id", "p", "base"))).alias("path"))
            .where("size(path) > 1")
            .groupBy("lang", F.col("path.id").alias("sources"), F.col("path.p").alias("ps"), F.col("path.base").alias("bases"))
            .agg(F.count("*").alias("terms")))
    order = ["lang", "sources", "ps"]
    tree = tree_corrections(materialise(path).repartitionByRange(*order).sortWithinPartitions(*order))

    total = (both_base.unionByName(left).unionByName(right).unionByName(tree)
             .groupBy("lang", "a", "b").agg(F.sum("value").cast("bigint").alias("value")))
    found = (total.join(a.select("lang", "a", "source"), ["lang", "a"]).join(b.select("lang", "b", "item"), ["lang", "b"])
             .select("lang", "source", "item", "value"))
    return found.withColumn("rank", _ranked()).select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
