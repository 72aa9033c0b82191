"""N-gram Jaccard join with set-relation skipping, reduced to connected components.

A document's set holds the distinct hashes of its 4-word shingles.  Two sets
link when their Jaccard similarity reaches ``num / den``.  The join returns the
smallest id reachable over links, without listing the pairs inside a group.

1. Frequency sketch: shingle counts over all documents in 2**20 counters (a
   fixed 4 MB whatever the corpus).  Tokens are ordered by (count, hash); any
   fixed order is exact, a rare-first one keeps index lists short.
2. Equal sets become one set.  Each set's prefix (the tokens of which any
   linked set must share one) enters the index.  An entry at position p of a
   set of n tokens reaches only partner sizes up to ``reach(n, p)``: lists are
   cut into blocks by size band, and an entry visits only the blocks its
   position lets it reach (index-level skipping).  Tokens of one set are dropped.
3. Answer-level skipping: in each block all sets are first compared with one
   leader, the set that holds the token earliest.  Sets that link to a leader
   form its cluster; with |m minus L| known, a set's overlap with every member
   is bounded by its overlap with the leader, so later steps compare leaders
   and open a cluster only where that bound still allows a link.
4. Clusters that share a block are compared by their leaders, opened where
   needed, and the links' components are contracted.

Verification always recomputes both whole texts' sets.  Hashes have 64 bits
(shingles) and 128 bits (equal sets).

Defined cases: null or wordless text is an empty set: never linked, its own
component.  Fewer words than ``k``: the whole sequence is the one shingle.
A null id keeps its row, unlinked, with a null component.  Every row is a
document of its own; rows that repeat an id are returned each.  Columns other
than id and text are not looked at.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kairos.llm.common import (WHITE, arrow_slices, batch_words, connected_components, id_bitmap, in_bitmap,
                               map_texts, materialise, shingles)

#: counters of the frequency sketch (2**bits) and the blocks it travels in
SKETCH_BITS, SKETCH_BLOCKS = 20, 64
#: a token whose sketch count exceeds the average by this many sets is spread over several tasks
SALT_EVERY = 50_000


def text_sets(texts: list, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each whole text."""
    return [np.unique(shingles(w, k)) for w in batch_words(texts, WHITE)]


def set_key(s: np.ndarray) -> tuple[int, int]:
    """128 bits that are equal for equal sets."""
    a = np.bitwise_xor.reduce(s * np.uint64(0x9FB21C651E98DF25) ^ (s >> np.uint64(29)))
    b = np.add.reduce((s ^ (s >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93))
    a = (int(a) * 0x9E3779B97F4A7C15 + len(s) * 0xC2B2AE3D27D4EB4F) & (2**64 - 1)
    return a - (a >> 63 << 64), int(np.int64(b.astype(np.int64)))


def frequency_sketch(docs: DataFrame, text_col: str, k: int) -> np.ndarray:
    """Shingle counts over all texts by hash bucket; each task sends its counters once."""
    size = 1 << SKETCH_BITS
    step = size // SKETCH_BLOCKS

    def count(batches):
        total = np.zeros(size, dtype=np.uint32)
        for part in arrow_slices(batches):
            words = batch_words(part.column(0).to_pylist(), WHITE)
            h = [shingles(w, k) for w in words if len(w)]
            if h:
                total += np.bincount((np.concatenate(h) & np.uint64(size - 1)).astype(np.intp), minlength=size).astype(np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SKETCH_BLOCKS), pa.int32()),
             pa.array([zlib.compress(total[i * step:(i + 1) * step].tobytes(), 1) for i in range(SKETCH_BLOCKS)], pa.binary())],
            names=["block", "counts"])

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                c = np.frombuffer(zlib.decompress(c), np.uint32).astype(np.uint64)
                sums[i] = sums[i] + c if i in sums else c
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                          pa.array([x.tobytes() for x in sums.values()], pa.binary())],
                                         names=["block", "counts"])

    schema = "block int, counts binary"
    merged = docs.select(text_col).mapInArrow(count, schema).repartition(SKETCH_BLOCKS, "block").mapInArrow(add, schema)
    out = np.zeros(size, dtype=np.uint64)
    for r in merged.collect():  # SKETCH_BLOCKS rows, 8 MB in all
        out[r["block"] * step:(r["block"] + 1) * step] = np.frombuffer(r["counts"], np.uint64)
    return out


def _prefixes(docs: DataFrame, text_col: str, k: int, num: int, den: int, counts: np.ndarray) -> DataFrame:
    """Per document: set size, set key and the rare-first prefix (with salts for hot tokens)."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # fixed size
    mean = float(counts.mean())

    def make():
        freq = shared.value

        def f(texts):
            n, a, b, prefix, salts = [], [], [], [], []
            for s in text_sets(texts, k):
                size = len(s)
                n.append(size)
                if not size:
                    a.append(0), b.append(0), prefix.append(None), salts.append(None)
                    continue
                x, y = set_key(s)
                a.append(x), b.append(y)
                keep = size - (num * size + den - 1) // den + 1
                c = freq[s & np.uint64((1 << SKETCH_BITS) - 1)]
                first = np.lexsort((s, c))[:keep]
                prefix.append(s[first].view(np.int64))
                spread = np.ceil(np.maximum(c[first] - mean, 0) / SALT_EVERY).astype(np.int32)
                salts.append(spread if (spread > 1).any() else None)
            return [n, a, b, prefix, salts]
        return f

    return map_texts(docs, text_col, {"n": "bigint", "s1": "bigint", "s2": "bigint", "prefix": "array<bigint>",
                                      "salts": "array<int>"}, make, drop_text=True)


def _verify(pairs: DataFrame, sets: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(a, b, na, nb, common) of set pairs, from the whole texts of one document of each set."""
    wanted = (pairs.select(F.col("a").alias("s1")).unionByName(pairs.select(F.col("b").alias("s1"))).distinct()
              .join(sets.select("s1", "rep"), "s1"))
    wanted = materialise(wanted)
    near = in_bitmap(docs.select("id", "text"), "id", id_bitmap(wanted, "rep"))

    def make():
        def f(texts):
            return [[set_key(s)[0] if len(s) else 0 for s in text_sets(texts, k)]]
        return f

    # a repeated id may carry another text: the recomputed key says which row is meant
    texts = map_texts(near.join(wanted, F.col("id") == F.col("rep")).select("s1", "text"), "text", {"key": "bigint"}, make)
    texts = texts.where("key = s1").groupBy("s1").agg(F.first("text").alias("text"))
    texts = materialise(texts)
    both = (pairs.select("a", "b").join(texts.select(F.col("s1").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("s1").alias("b"), F.col("text").alias("tb")), "b"))

    def compare(batches):
        for part in arrow_slices(batches):
            a, b, ta, tb = (part.column(c).to_pylist() for c in ("a", "b", "ta", "tb"))
            own = dict(zip(a, ta)) | dict(zip(b, tb))
            got = dict(zip(own, text_sets(list(own.values()), k)))
            common = [len(np.intersect1d(got[x], got[y], assume_unique=True)) for x, y in zip(a, b)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([len(got[x]) for x in a], pa.int64()),
                 pa.array([len(got[y]) for y in b], pa.int64()), pa.array(common, pa.int64())],
                names=["a", "b", "na", "nb", "common"])

    return materialise(both.select("a", "b", "ta", "tb")
                       .mapInArrow(compare, "a bigint, b bigint, na bigint, nb bigint, common bigint"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4,
                       num: int = 85, den: int = 100) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``docs``; see the module's text."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = frequency_sketch(src, "text", k)
    rows = materialise(_prefixes(src, "text", k, num, den, counts))
    # one document stands for all of an equal set (a few repeats may share its bit: they add nothing new)
    reps = materialise(rows.where("n > 0 and id is not null").groupBy("s1", "s2").agg(F.min("id").alias("rep")))
    sets = in_bitmap(rows.where("n > 0 and id is not null"), "id", id_bitmap(reps, "rep"))
    width = math.log(den / num)
    total = num + den

    def band(col):
        return F.floor(F.log(col) / F.lit(width)).cast("int")

    entries = (sets.select("s1", "n", "salts", F.posexplode("prefix").alias("pos", "tok"))
               .withColumn("spread", F.coalesce(F.get("salts", F.col("pos")), F.lit(1)))
               .withColumn("salt", F.when(F.col("spread") > 1, F.pmod(F.col("s1"), F.col("spread"))).otherwise(F.lit(0)).cast("int"))
               # lists are kept by 32 bits of the token: a collision only adds candidates
               .select(F.hash("tok").alias("tok"), "salt", (F.col("spread") > 1).alias("hot"), "s1", F.col("n").cast("int").alias("n"), "pos"))
    # most tokens are of one set: they can link nothing
    held = Window.partitionBy("tok", "salt")
    index = materialise(
        entries.withColumn("held", F.count("*").over(held)).where("held > 1 or hot")
        .withColumn("reach", F.floor(((F.col("n") - F.col("pos")) * F.lit(total)) / F.lit(num) - F.col("n") + F.lit(1e-9)).cast("int"))
        .select("tok", "s1", "n", "pos", "reach", band(F.col("n")).alias("band")))

    # every set against the leader of its blocks: the one with the fewest rarer tokens, i.e. the least altered of a group
    lead = index.groupBy("tok", "band").agg(F.min(F.struct("pos", "s1", "n", "reach")).alias("lead"))
    stars = (index.join(lead, ["tok", "band"])
             .where("s1 != lead.s1 and n <= lead.reach and lead.n <= reach")
             .select(F.col("lead.s1").alias("a"), F.col("s1").alias("b")).distinct())
    star = _verify(materialise(stars), reps, src, k)
    linked = f"{total} * common >= {num} * (na + nb)"

    # clusters: members link to a leader that is no member itself
    ties = star.where(linked)
    member = ties.select(F.col("b").alias("a")).distinct()
    cluster = materialise(
        ties.join(member, "a", "left_anti").groupBy("b")
        .agg(F.min(F.struct("a", (F.col("nb") - F.col("common")).alias("out"), F.col("nb").alias("n"))).alias("m"))
        .select(F.col("b").alias("s1"), F.col("m.a").alias("cl"),
                (F.lit(total) * F.col("m.out") - F.lit(num) * F.col("m.n")).alias("slack")))

    # clusters that share a block, compared by their leaders
    blocks = (index.join(cluster.select("s1", "cl"), "s1", "left")
              .withColumn("cl", F.coalesce("cl", "s1"))
              .groupBy("tok", "band", "cl").agg(F.min("n").alias("n"), F.max("reach").alias("reach")))
    probes = blocks.select("tok", F.explode(F.sequence("band", F.greatest(F.col("band"), band(F.greatest("reach", F.lit(1)))))).alias("band"),
                           F.col("cl").alias("p"), F.col("n").alias("pn"), F.col("reach").alias("preach"))
    met = (probes.join(blocks, ["tok", "band"]).where("p != cl and pn <= reach and n <= preach")
           .select(F.least("p", "cl").alias("a"), F.greatest("p", "cl").alias("b")).distinct())
    known = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                        F.when(F.col("a") < F.col("b"), F.col("na")).otherwise(F.col("nb")).alias("na"),
                        F.when(F.col("a") < F.col("b"), F.col("nb")).otherwise(F.col("na")).alias("nb"), "common").distinct()
    met = materialise(met)
    fresh = _verify(met.join(known, ["a", "b"], "left_anti"), reps, src, k)
    leaders = fresh.unionByName(met.join(known, ["a", "b"]).select(*fresh.columns))

    # clusters whose bound still allows a link of members are opened
    open_ = cluster.groupBy("cl").agg(F.max("slack").alias("most"))
    room = (leaders.where(f"not ({linked})")
            .join(open_.select(F.col("cl").alias("a"), F.col("most").alias("ma")), "a", "left")
            .join(open_.select(F.col("cl").alias("b"), F.col("most").alias("mb")), "b", "left")
            .where("ma is not null or mb is not null")
            .withColumn("ma", F.greatest(F.coalesce("ma", F.lit(-10**15)), -num * F.col("na")))
            .withColumn("mb", F.greatest(F.coalesce("mb", F.lit(-10**15)), -num * F.col("nb")))
            .withColumn("have", F.lit(total) * F.col("common")).where("have + ma + mb >= 0"))
    inside = cluster.select(F.col("cl"), F.col("s1").alias("m"), "slack")
    left = (room.select("a", "b", "have", "mb", "nb", F.col("a").alias("x"), (-num * F.col("na")).alias("sx"))
            .unionByName(room.join(inside, room["a"] == inside["cl"])
                         .select("a", "b", "have", "mb", "nb", F.col("m").alias("x"), F.col("slack").alias("sx")))
            .where("have + sx + mb >= 0"))
    pairs = (left.select("x", "sx", "have", F.col("b").alias("y"), (-num * F.col("nb")).alias("sy"), "a", "b")
             .unionByName(left.join(inside, left["b"] == inside["cl"])
                          .select("x", "sx", "have", F.col("m").alias("y"), F.col("slack").alias("sy"), "a", "b"))
             .where("have + sx + sy >= 0 and not (x = a and y = b)")
             .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    opened = _verify(materialise(pairs), reps, src, k)

    links = (ties.select("a", "b").unionByName(leaders.where(linked).select("a", "b"))
             .unionByName(opened.where(linked).select("a", "b")))
    comp = connected_components(links)
    label = reps.join(comp.select(F.col("id").alias("s1"), "component"), "s1", "left")
    lows = (label.where("component is not null").groupBy("component").agg(F.min("rep").alias("low")))
    label = (label.join(lows, "component", "left")
             .select("s1", "s2", F.coalesce("low", "rep").alias("low")))
    full = rows.where("n > 0 and id is not null").select("id", "n", "s1", "s2").join(label, ["s1", "s2"])
    rest = rows.where("n = 0 or id is null")
    return (full.select("id", "n", F.col("low").alias("c"))
            .unionByName(rest.select("id", "n", F.col("id").alias("c")))
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("c").alias("component_id")))
