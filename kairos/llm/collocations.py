"""Phrase collocation mining with mergeable Misra-Gries summaries.

Texts are lower-cased (A-Z), cut at ``. , ; : ! ?`` and line breaks into pieces
and those at spaces and tabs into words.  Phrases of 2 (to 3) words that occur
``min_count`` times or more within pieces of a language are candidates.

1. *Summaries.*  Every task counts its words and n-grams exactly and deals them by hash to
   partitions; a partition's summaries are merged with a capacity above its
   mass divided by ``min_count`` (mass: occurrences that reached it, those of
   one task and n-gram counted up to ``min_count``).  The excess over the
   capacity is taken off all counters at once, less than ``min_count`` in
   total, so every n-gram with ``min_count`` occurrences survives; those whose counter
   and all that was taken off stay below ``min_count`` together can't have as many and go.
2. *Exact counts.*  Survivors become a bitmap of bounded size (at most 16 MB).  A second
   pass counts the words and n-grams whose bit is set, adds the tasks' counts under their
   text within the same partitions, and drops those under ``min_count``.  Hash collisions only let more n-grams through.
3. *Scores.*  Each cut of a candidate into two parts has
   ``floor(10^6 a^2 / (l r))``; the lowest counts, computed in decimals.
   Candidates inside a longer candidate that holds ``share`` percent of their
   occurrences are dropped; the best ``top`` per language are returned.

Corner cases: null or empty texts hold no words; a null language is ``und``;
repeated rows count each; an empty table gives no rows; other columns of the
input are not read.  A text of any length is counted whole, in blocks.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kairos.llm.common import arrow_slices, materialise, mix64
from kairos.llm.words import Vocabulary, fold_table, token_blocks

#: bytes that end a piece, and the table that folds texts
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
FOLD = fold_table(b"\t", BREAKS)
#: n-grams of up to 3 words are keys of 63 bits: numbers of words within a task stay under 2**21
ID_BITS = 21
#: a task hands on its counts beyond so many distinct n-grams, or so many words
MAX_GRAMS, MAX_WORDS = 500_000, 200_000
#: bytes of text for one partition of summaries, and the least number of partitions (a power of two)
PARTITION_BYTES, PARTITIONS = 1 << 24, 64
REST_BITS = 32  # an n-gram's hash within its partition; n-grams that share one only survive more easily
MAX_BITMAP = 1 << 27


class GramCounter:
    """Exact counts of a task's words and n-grams per language, up to the next ``take``.

    ``keep``, if given, tells from hashes which words and n-grams are wanted; the others aren't held.
    """

    def __init__(self, max_words: int, keep: GramFilter | None = None):
        if max_words not in (2, 3):
            raise ValueError("phrases have 2 or 3 words at most")
        self.sizes, self.keep = range(1, max_words + 1), keep
        self._clear()

    def _clear(self):
        self.vocabulary = Vocabulary()
        self.raw, self.done, self.pending = defaultdict(list), {}, 0
        self.total: Counter = Counter()

    def add(self, lang: bytes, data: bytes) -> Iterator[None]:
        """Count ``data``; yields whenever the counts should be taken."""
        carry: list[bytes] = []
        for tokens in token_blocks(data, FOLD):
            tokens = carry + tokens
            ids = self.vocabulary.numbers(tokens)
            for n in self.sizes:
                at = max(0, len(carry) - n + 1)  # n-grams that end in the carried words were counted
                m = len(ids) - n + 1 - at
                if m <= 0:
                    continue
                key, whole = np.zeros(m, np.int64), np.ones(m, bool)
                for j in range(n):
                    part = ids[at + j:at + j + m]
                    key = (key << ID_BITS) | part
                    whole &= part != 0
                self.raw[lang, n].append(key[whole])
                self.pending += m
            carry = tokens[-(self.sizes[-1] - 1):]
            if self.pending > MAX_GRAMS or len(self.vocabulary) > MAX_WORDS:
                self._settle()
                if sum(len(k) for k, _ in self.done.values()) > MAX_GRAMS or len(self.vocabulary) > MAX_WORDS:
                    yield

    def _settle(self):
        wh = self.vocabulary.hashes() if self.keep is not None else None
        for at, parts in self.raw.items():
            keys, counts = np.unique(np.concatenate(parts), return_counts=True)
            lang, n = at
            if n == 1:
                self.total[lang] += int(counts.sum())
            if self.keep is not None:
                wanted = self.keep.maybe(gram_hashes(lang, n, keys, wh))
                keys, counts = keys[wanted], counts[wanted]
            if at in self.done:
                old, times = self.done[at]
                keys, counts = merge_counts(np.concatenate([old, keys]), np.concatenate([times, counts]))
            self.done[at] = keys, counts
        self.raw, self.pending = defaultdict(list), 0

    def take(self):
        """(vocabulary, {(lang, n): (keys, counts)}, {lang: words}) since the last call; n = 1: words."""
        self._settle()
        out = self.vocabulary, self.done, self.total
        self._clear()
        return out


def merge_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal keys joined, their counts added; keys ascending."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _count_batches(batches, max_words: int, keep: GramFilter | None = None):
    """Counts of a task's texts, taken whenever they fill their bound and at the end."""
    counter = GramCounter(max_words, keep)
    for part in arrow_slices(batches):
        by_lang = defaultdict(list)
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
            if text:
                by_lang[lang.encode()].append(text)
        for lang, texts in by_lang.items():
            for _ in counter.add(lang, b"\n".join(texts)):
                yield counter.take()
    yield counter.take()


def gram_hashes(lang: bytes, n: int, keys: np.ndarray, word_hashes: np.ndarray) -> np.ndarray:
    seed = np.frombuffer(hashlib.blake2b(lang, digest_size=8).digest(), np.uint64)
    h = np.full(len(keys), seed[0] ^ np.uint64(n))
    for j in reversed(range(n)):
        h = mix64(h * np.uint64(0x9E3779B97F4A7C15) + word_hashes[(keys >> (ID_BITS * j)) & ((1 << ID_BITS) - 1)])
    return h


def _pack(values: np.ndarray) -> np.ndarray:
    """Hashes within a partition as four bytes each."""
    return values.astype("<u4")


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4").astype(np.uint64)


def _deal(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(partition, hash within the partition) of n-gram hashes."""
    return (h >> np.uint64(64 - bits)).astype(np.int64), (h << np.uint64(bits)) >> np.uint64(64 - REST_BITS)


SUMMARY = "part int, mass long, grams binary, counts binary"


def task_summaries(docs: DataFrame, min_count: int, max_words: int, bits: int) -> DataFrame:
    """One row per task (or filled bound) and partition: its n-grams' hashes and counts up to ``min_count``."""
    width = np.uint8 if min_count < 256 else np.uint32

    def run(batches):
        for vocabulary, grams, _ in _count_batches(batches, max_words):
            wh = vocabulary.hashes()
            found = [(gram_hashes(lang, n, k, wh), np.minimum(c, min_count)) for (lang, n), (k, c) in grams.items()]
            if not found:
                continue
            h, c = merge_counts(np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]))
            part, rest = _deal(h, bits)
            c = np.minimum(c, min_count).astype(width)
            edge = np.r_[0, np.flatnonzero(part[1:] != part[:-1]) + 1, len(part)] if len(part) else np.zeros(1, np.int64)
            for s in range(0, len(edge) - 1, 64):
                spans = list(zip(edge[s:s + 64], edge[s + 1:s + 65]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part[a] for a, _ in spans], pa.int32()), pa.array([int(c[a:b].sum()) for a, b in spans], pa.int64()),
                     pa.array([_pack(rest[a:b]).tobytes() for a, b in spans], pa.binary()),
                     pa.array([c[a:b].tobytes() for a, b in spans], pa.binary())], names=["part", "mass", "grams", "counts"])

    return docs.mapInArrow(run, SUMMARY)


def merge_summaries(summaries, capacity: int, width=np.uint8) -> tuple[np.ndarray, np.ndarray, int]:
    """Misra-Gries merge of (hashes, counts) pairs: (surviving hashes, their counters, what was taken off every counter).

    Pairs gather until they outnumber the capacity; then equal hashes meet, and if more than ``capacity``
    are left, the count of the largest one beyond it is taken off all.  Each unit taken off costs more than
    ``capacity`` occurrences, so the total stays at or under mass / (capacity + 1).
    """
    held = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    taken = 0

    def fold(parts):
        nonlocal taken
        keys, counts = merge_counts(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
        if len(keys) > capacity:
            cut = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
            taken += cut
            keys, counts = keys[counts > cut], counts[counts > cut] - cut
        return keys, counts

    waiting, n = [held], 0
    for grams, counts in summaries:
        waiting.append((_unpack(grams), np.frombuffer(counts, width).astype(np.int64)))
        n += len(counts) // np.dtype(width).itemsize
        if n > max(capacity, 1 << 16):
            waiting, n = [fold(waiting)], 0
    keys, counts = fold(waiting)
    return keys, counts, taken


def survivors(summaries: DataFrame, min_count: int, bits: int) -> DataFrame:
    """Per partition a bitmap of the n-grams that survive the merge (``slots`` bits, a power of two)."""
    width = np.uint8 if min_count < 256 else np.uint32
    most = max(64, MAX_BITMAP >> bits)
    mass = summaries.groupBy("part").agg(F.sum("mass").alias("total"))

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None

        def pairs():
            nonlocal total
            for b in batches:
                total = b.column("total")[0].as_py()
                yield from zip(b.column("grams").to_pylist(), b.column("counts").to_pylist())

        feed = pairs()
        first = next(feed)  # the group's first row tells its mass
        keys, counts, taken = merge_summaries(_chain(first, feed), total // min_count + 1, width)
        keys = keys[counts + taken >= min_count]  # a counter is at most ``taken`` short of its n-gram's occurrences
        slots = 64
        while slots < min(most, 16 * len(keys)):
            slots *= 2
        flags = np.zeros(slots, bool)
        flags[(keys & np.uint64(slots - 1)).astype(np.int64)] = True
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(flags).tobytes()], pa.binary())],
                                         names=["part", "flags"])

    return summaries.join(mass, "part").groupBy("part").applyInArrow(run, "part int, flags binary")


def _chain(first, rest):
    yield first
    yield from rest


class GramFilter:
    """Survivors' bitmaps of all partitions, laid end to end."""

    def __init__(self, rows, bits: int):
        self.bits = bits
        flags = {r["part"]: np.frombuffer(bytes(r["flags"]), np.uint8) for r in rows}
        none = np.zeros(8, np.uint8)
        parts = [flags.get(p, none) for p in range(1 << bits)]
        self.mask = np.array([len(f) * 8 - 1 for f in parts], np.int64)
        self.start = np.cumsum([0] + [len(f) * 8 for f in parts[:-1]])
        self.bytes = np.concatenate(parts)

    def maybe(self, h: np.ndarray) -> np.ndarray:
        part, rest = _deal(h, self.bits)
        at = self.start[part] + (rest.astype(np.int64) & self.mask[part])
        return (self.bytes[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def exact_counts(docs: DataFrame, keep: GramFilter, min_count: int, max_words: int) -> DataFrame:
    """(lang, n, phrase, f): words and phrases with ``min_count`` occurrences or more; n = 0: a language's words.

    A task sends a partition its phrases as one row; equal phrases meet there and are added by their text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(keep)

    def run(batches):
        for vocabulary, grams, total in _count_batches(batches, max_words, shared.value):
            spelt, wh = list(vocabulary), vocabulary.hashes()
            for lang in total:
                texts, parts, times = [b""], [np.zeros(1, np.int64)], [np.array([total[lang]])]
                for n in range(1, max_words + 1):
                    keys, counts = grams.get((lang, n), (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                    cols = [((keys >> (ID_BITS * j)) & ((1 << ID_BITS) - 1)).tolist() for j in reversed(range(n))]
                    texts += [b" ".join([spelt[i] for i in at]) for at in zip(*cols)]
                    parts.append(_deal(gram_hashes(lang, n, keys, wh), keep_bits)[0])
                    times.append(counts)
                part, counts = np.concatenate(parts), np.concatenate(times)
                order = np.argsort(part, kind="stable")
                part, counts = part[order], counts[order]
                edge = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
                spans = list(zip(edge[:-1].tolist(), edge[1:].tolist()))
                for s in range(0, len(spans), 256):
                    some = spans[s:s + 256]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part[a] for a, _ in some], pa.int32()), pa.array([lang.decode()] * len(some), pa.string()),
                         pa.array([b"\n".join([texts[i] for i in order[a:b]]) for a, b in some], pa.binary()),
                         pa.array([counts[a:b].tobytes() for a, b in some], pa.binary())], names=["part", "lang", "phrases", "counts"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, dict] = defaultdict(lambda: defaultdict(int))
        for b in batches:
            for lang, phrases, counts in zip(*(b.column(c).to_pylist() for c in ("lang", "phrases", "counts"))):
                of = sums[lang]
                for phrase, f in zip(phrases.split(b"\n"), np.frombuffer(counts, np.int64).tolist()):
                    of[phrase] += f
        for lang, of in sums.items():
            found = [(p.count(b" ") + 1 if p else 0, p, f) for p, f in of.items() if f >= min_count or not p]
            for s in range(0, len(found), 100_000):
                n, p, f = zip(*found[s:s + 100_000])
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(n, pa.int32()), pa.array(p, pa.binary()),
                                                  pa.array(f, pa.int64())], names=["lang", "n", "phrase", "f"])

    keep_bits = keep.bits
    return (docs.mapInArrow(run, "part int, lang string, phrases binary, counts binary")
            .groupBy("part").applyInArrow(meet, "lang string, n int, phrase binary, f long")
            .withColumn("phrase", F.col("phrase").cast("string")))


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 10, max_words: int = 3,
         share: int = 50, top: int = 2000) -> DataFrame:
    """The best collocations per language: lang, rank, phrase, a, l, r, n, score (see the module)."""
    if min_count < 2:
        raise ValueError("min_count must be 2 or more")
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("binary").alias("text"))
    size = src.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = (PARTITIONS - 1).bit_length()
    while size >> bits > PARTITION_BYTES:
        bits += 1
    summaries = materialise(task_summaries(src, min_count, max_words, bits))
    keep = GramFilter(survivors(summaries, min_count, bits).collect(), bits)
    counted = materialise(exact_counts(src, keep, min_count, max_words))
    return best(scored(counted, max_words, share), top)


def scored(counted: DataFrame, max_words: int, share: int) -> DataFrame:
    """Candidates with their lowest cut (a, l, r, n, score), without those inside a frequent longer one."""
    def of(n, *cols):
        return counted.where(F.col("n") == n).select("lang", *cols)

    def part(n, name, f):
        return of(n, F.col("phrase").alias(name), F.col("f").alias(f))

    def score(left, right):
        wide = "cast({} as decimal(15,0))"
        a, l, r = (wide.format(c) for c in ("a", left, right))
        return F.expr(f"cast({a} * {a} * cast(1000000 as decimal(7,0)) as decimal(38,0)) div cast({l} * {r} as decimal(38,0))")

    two = (of(2, "phrase", F.col("f").alias("a")).withColumn("first", F.substring_index("phrase", " ", 1))
           .withColumn("last", F.substring_index("phrase", " ", -1))
           .join(part(1, "first", "l"), ["lang", "first"]).join(part(1, "last", "r"), ["lang", "last"])
           .withColumn("score", score("l", "r")))
    out = two.select("lang", "phrase", "a", "l", "r", "score")
    if max_words == 3:
        three = (of(3, "phrase", F.col("f").alias("a")).withColumn("first", F.substring_index("phrase", " ", 1))
                 .withColumn("head", F.substring_index("phrase", " ", 2)).withColumn("last", F.substring_index("phrase", " ", -1))
                 .withColumn("tail", F.expr("substring(phrase, length(first) + 2)")))
        longest = (three.select("lang", F.explode(F.array("head", "tail")).alias("phrase"), F.col("a").alias("longer"))
                   .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
        out = (out.join(longest, ["lang", "phrase"], "left")
               .where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))).drop("longer"))
        cut = (three.join(part(1, "first", "l1"), ["lang", "first"]).join(part(2, "tail", "r1"), ["lang", "tail"])
               .join(part(2, "head", "l2"), ["lang", "head"]).join(part(1, "last", "r2"), ["lang", "last"])
               .withColumn("s1", score("l1", "r1")).withColumn("s2", score("l2", "r2")).withColumn("at1", F.expr("s1 <= s2")))
        out = out.unionByName(cut.select("lang", "phrase", "a", F.expr("if(at1, l1, l2)").alias("l"), F.expr("if(at1, r1, r2)").alias("r"),
                                         F.least("s1", "s2").alias("score")))
    return out.join(of(0, F.col("f").alias("n")), "lang")


def best(found: DataFrame, top: int, bins: int = 1000, salts: int = 8) -> DataFrame:
    """The first ``top`` per language by score and count descending, phrase ascending.

    Counts per range of scores show below which range nothing can be among them; the rest is ranked
    within ``salts`` shares of a language first, so that no task holds all of a language's candidates.
    """
    found = materialise(found).withColumn("_bin", F.expr(f"score div {1_000_000 // bins}"))
    down = Window.partitionBy("lang").orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1)
    floor = (found.groupBy("lang", "_bin").agg(F.count("*").alias("_n"))
             .withColumn("_above", F.coalesce(F.sum("_n").over(down), F.lit(0))).where(F.col("_above") < top)
             .groupBy("lang").agg(F.min("_bin").alias("_low")))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(salts))).orderBy(*order)
    rows = (found.join(floor, "lang").where("_bin >= _low").withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
