"""Line dedup as an exact set-similarity join, in DataFrame operations only.

A line's set holds its distinct words.  A line is removed when an earlier line
of the corpus (smaller document id, then smaller line number) has a Jaccard
similarity of ``num / den`` or more; removed lines count as earlier lines too.

1. One pass splits texts into lines and words; a layer keeps each line's word
   hashes.  Lines of equal sets (exact repeats among them) meet by two 64-bit keys of the set, aggregated
   map-side: all but the first go, and only the first enters the join.  Sets too small to be similar to any
   other set are settled with that.
2. Rarity: exact corpus word counts, kept as 4-bit classes in 262,144 cells (a
   fixed 128 KB); a cell has the class of its most frequent word.  Words are
   ordered by (class, longer first, hash).  Any fixed order is exact.
3. Prefix filter: similar lines of n words share one of their first n - ceil(n * num / den) + 1 words, and two
   of their first n - ceil(n * num / den) + 2 where they must share two at all.  A rare word is an index key of its own; a
   frequent one is a key together with each later word of the longer prefix, so no list is as long as a
   frequent word's.  Position and length filters: a key at position p can meet only partner sizes up to
   ``reach(n, p)``.  A 64-bit signature travels with the entry: words set in one signature only bound the
   overlap from above.
4. Keys are counted first (map-side); bitmaps keep those of one line out of the index and tell lists of
   more than ``SHORT`` lines.  Shorter lists are compared where they meet.  In longer
   lists every line is first compared with the earliest of its block (key, size
   band); what matches is settled and asks no further, so a group of near copies
   costs one comparison a line, and the others are joined with the earlier lines
   of the blocks they reach.  Entries of lists of more than ``MANY`` lines carry the line's
   keys of such lists before them, and a pair is made at the first of them that both
   lines have, not again at each of the others.
5. A 128-bit signature bounds the overlap again, then verification counts the
   common words of both whole lines.  Only documents that lose a line are joined
   with what they lose.

Words are compared by 52-bit hashes and their length (up to 31 bytes).

Defined cases: lines with fewer than ``min_words`` distinct words are left
alone (blank lines always).  Null and empty texts stay as they are.  Rows with a
null id keep their text and are nobody's earlier line.  Rows that repeat an id
are lines at the same place: they don't remove each other.  Extra columns pass
through; ``n_lines`` and ``n_removed`` are replaced.  An empty table stays empty.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kairos.llm.common import LAYERS, id_bitmap, in_bitmap, materialise, maybe_in, release

CELLS = 1 << 18
#: lists up to this length are compared in place; longer ones go by leaders and a join
SHORT = 48
#: of the lists longer than this, only the first that two lines share makes a pair of them
MANY = 1024
#: words of more lines than this are keys in pairs only
FREQUENT = 2048
#: size of the pre-filters for repeated keys and for first places
BITS = 1 << 26
_LOW52 = (1 << 52) - 1
#: layers whose neighbouring rows repeat values
_PACKED = {"compression": "zstd", "parquet.dictionary.page.size": str(8 << 20)}


def _plain(col: str) -> str:
    return rf"replace(replace({col}, '\t', ' '), '\r', ' ')"


def _signature(which: int) -> str:
    """64 bits in which each word of its half sets one."""
    return f"aggregate(toks, 0L, (s, t) -> s | if(t & 64L = {which * 64}L, shiftleft(1L, cast(t & 63L as int)), 0L))"


def line_sets(docs: DataFrame, min_words: int) -> DataFrame:
    """(id, line_no, k, toks, n, c0, c1, s0, s1): a key of the line, its distinct words (hash and length, ascending), their
    number, two keys of the set, and its signature."""
    lines = docs.where("id is not null").select("id", F.expr(rf"posexplode(split({_plain('text')}, '\n')) as (line_no, line)"))
    word = f"shiftleft(cast(31 - least(31, octet_length(x)) as bigint), 52) | (xxhash64(x) & {_LOW52}L)"
    return (lines.select("id", "line_no", F.xxhash64("line").alias("k"),
                         F.sort_array(F.expr(f"array_distinct(transform(array_remove(split(line, ' '), ''), x -> {word}))")).alias("toks"))
            .where(F.size("toks") >= max(1, min_words))
            .withColumns({"n": F.size("toks"), "c0": F.xxhash64("toks"), "c1": F.xxhash64(F.lit(1), "toks"),
                          "s0": F.expr(_signature(0)), "s1": F.expr(_signature(1))}))


def rarity_cells(sets: DataFrame) -> tuple[str, int]:
    """Classes of corpus word counts, 16 cells of 4 bits to a number, as SQL for an array of CELLS / 16 numbers, and
    the least class of which all words are in more than ``FREQUENT`` lines."""
    words = sets.select(F.explode("toks").alias("t")).groupBy("t").agg(F.count("*").alias("c"))
    cells = words.groupBy(F.expr(f"cast(t & {CELLS - 1}L as int)").alias("cell")).agg(F.max("c").alias("c")).collect()  # CELLS rows at most
    # sixteen classes of equal width on the logarithm of the count
    widest = math.log2(max([r["c"] for r in cells], default=1)) + 1e-9
    out = [0] * (CELLS // 16)
    for r in cells:
        out[r["cell"] >> 4] |= min(15, int(16 * math.log2(r["c"]) / widest)) << 4 * (r["cell"] & 15)
    frequent = math.ceil(16 * math.log2(FREQUENT) / widest)
    return "cast(split('" + ",".join(str(x - (x >> 63 << 64)) for x in out) + "', ',') as array<bigint>)", frequent


def _bound(xn: str, xs: list[str], yn: str, ys: list[str], num: int, den: int) -> str:
    """Whether signatures allow the similarity: words that only one side has can't be common."""
    apart = " + ".join(f"bit_count({a} ^ {b})" for a, b in zip(xs, ys))
    return f"{num + den} * ({xn} + {yn} - ({apart})) >= {2 * num} * ({xn} + {yn})"


def _compare(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Lines (id, line_no, k) of the pairs whose Jaccard similarity reaches num / den; pairs: id, line_no, eid, eline."""
    def fetch(of: DataFrame, *cols) -> DataFrame:
        wanted = (of.select("id", "line_no").unionByName(of.select(F.col("eid").alias("id"), F.col("eline").alias("line_no")))
                  .select(F.xxhash64("id", "line_no").alias("h")))
        near = in_bitmap(sets.withColumn("h", F.xxhash64("id", "line_no")), "h", id_bitmap(wanted, "h"))
        return near.select("id", "line_no", *cols)

    def earlier(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("id").alias("eid"), F.col("line_no").alias("eline"),
                           *[F.col(c).alias(f"e{c}") for c in rows.columns if c not in ("id", "line_no")])

    marks = fetch(pairs, "n", "s0", "s1")
    likely = materialise(pairs.join(marks, ["id", "line_no"]).join(earlier(marks), ["eid", "eline"])
                         .where(_bound("n", ["s0", "s1"], "en", ["es0", "es1"], num, den)).select("id", "line_no", "eid", "eline"))
    whole = fetch(likely, "k", "toks")
    both = (likely.join(whole, ["id", "line_no"]).join(earlier(whole.drop("k")), ["eid", "eline"])
            .withColumn("common", F.size(F.array_intersect("toks", "etoks"))))
    return (both.where(f"{num + den} * common >= {num} * (size(toks) + size(etoks))")
            .select("id", "line_no", "k").distinct())


def first_of_equals(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines whose word set an earlier line has, the first line of every set)."""
    place = F.struct("id", "line_no")
    keys = materialise(sets.groupBy("c0", "c1").agg(F.count("*").alias("c"), F.min(place).alias("first"))
                       .where("c > 1").select("c0", "c1", "first"))
    flagged = maybe_in(sets, "c0", id_bitmap(keys, "c0", BITS), BITS)
    # lines that only share a bit with a repeated set have no first place and stay
    known = materialise(flagged.where("_kl_maybe").select("id", "line_no", "k", "c0", "c1").join(keys, ["c0", "c1"], "left")
                        .select("id", "line_no", "k", F.coalesce(place > F.col("first"), F.lit(False)).alias("again")))
    # lines that repeat none before (and the few repeats that share a bit with one: they are removed anyway)
    kept = id_bitmap(known.where("not again").select(F.xxhash64("id", "line_no").alias("h")), "h", BITS)
    marked = flagged.withColumnRenamed("_kl_maybe", "repeats").withColumn("h", F.xxhash64("id", "line_no"))
    firsts = maybe_in(marked, "h", kept, BITS).where("not repeats or _kl_maybe")
    return known.where("again").select("id", "line_no", "k"), firsts.select("id", "line_no", "n", "s0", "c0", "toks")


def index_keys(firsts: DataFrame, cells: str, frequent: int, num: int, den: int) -> DataFrame:
    """(tok, id, line_no, n, reach, s, c0): a row per key of a line, rare words alone and frequent ones with a later word."""
    level = f"shiftright(get({cells}, cast(shiftright(t & {CELLS - 1}L, 4) as int)), 4 * cast(t & 15L as int)) & 15L"
    ordered = firsts.select("id", "line_no", "n", F.col("s0").alias("s"), "c0", F.expr(f"n - cast(ceil(n * {num} / {den}) as int)").alias("last"),
                            F.sort_array(F.expr(f"transform(toks, t -> t | shiftleft({level}, 57))")).alias("o"))
    # a similar line shares ceil(n * num / den) words or more; where that is one, a frequent word is a key alone too
    alone = "array(struct(p as pos, xxhash64(t) as tok))"
    pairs = "transform(slice(o, p + 2, last + 1 - p), u -> struct(p as pos, xxhash64(t, u) as tok))"
    keys = f"""flatten(transform(slice(o, 1, last + 1), (t, p) -> case when shiftrightunsigned(t, 57) < {frequent} then {alone}
        when ceil(n * {num} / {den}) >= 2 then {pairs} else concat({alone}, {pairs}) end))"""
    return (ordered.select("id", "line_no", "n", "s", "c0", F.expr(f"inline({keys})"))
            .select("tok", "id", "line_no", "n", F.expr(f"cast((n - pos) * {num + den} div {num} - n as int)").alias("reach"), "s", "c0"))


def once_per_pair(index: DataFrame) -> DataFrame:
    """``index`` with ``seen``: the keys of the same line that come before the row's.

    Keys come in the order of their words, so two lines meet first at the key they share with nothing common
    before it on either side.  Its words stand earliest in both lines: where the position filter fails there,
    it fails at every later key.  ``c0`` tells lines of a repeated id apart.
    """
    keys = F.sort_array(F.collect_set(F.struct((-F.col("reach")).alias("back"), "tok")))
    return (index.groupBy("id", "line_no", "n", "s", "c0").agg(keys.alias("ks"))
            .select("id", "line_no", "n", "s", F.expr("inline(transform(ks, (k, i) -> struct(k.tok as tok, -k.back as reach, slice(ks.tok, 1, i) as seen)))")))


def repeated_lines(docs: DataFrame, min_words: int = 1, num: int = 4, den: int = 5) -> DataFrame:
    """(id, line_no, k) of the lines to remove; ``docs`` has id and text."""
    sets = materialise(line_sets(docs, min_words), **_PACKED)
    exact, firsts = first_of_equals(sets)
    width = math.log(den / num)

    def band(c):
        return F.floor(F.log(c) / F.lit(width)).cast("int")

    # two different sets of fewer words than this differ too much: n * den >= (n + 1) * num fails
    least = -(-num // (den - num))
    entries = index_keys(firsts.where(f"n >= {least}"), *rarity_cells(sets), num, den)
    counts = materialise(entries.groupBy("tok").agg(F.count("*").alias("c")).where("c > 1"))
    met = in_bitmap(entries, "tok", id_bitmap(counts, "tok", BITS), BITS)
    # a key's bit says the same of all its lines, so no list is taken apart; a short list that shares a long one's bit goes by the join
    index = materialise(maybe_in(met, "tok", id_bitmap(counts.where(f"c > {SHORT}"), "tok", BITS), BITS)
                        .select("tok", "id", "line_no", "n", "reach", "s", "c0", F.col("_kl_maybe").alias("long")), **_PACKED)
    release(docs.sparkSession, [])
    # short lists: earlier lines stand before a line
    row = F.struct("id", "line_no", "n", "reach", "s")
    fits = (f"(e.id < id or e.id = id and e.line_no < line_no) and n <= e.reach and e.n <= reach and {den} * n >= {num} * e.n "
            f"and {den} * e.n >= {num} * n and " + _bound("n", ["s"], "e.n", ["e.s"], num, den))
    listed = Window.partitionBy("tok").orderBy("id", "line_no").rowsBetween(1 - SHORT, -1)
    groups = (index.where("not long").withColumn("before", F.collect_list(row).over(listed))
              .select("id", "line_no", F.explode(F.expr(f"transform(filter(before, e -> {fits}), e -> struct(e.id as id, e.line_no as line_no))")).alias("e"))
              .select("id", "line_no", F.col("e.id").alias("eid"), F.col("e.line_no").alias("eline")).distinct())
    groups = materialise(groups)
    release(docs.sparkSession, [])
    short = materialise(_compare(groups, sets, num, den))
    release(docs.sparkSession, [])

    # long lists: everything against the earliest line of its block first
    index = index.where("long").drop("long").withColumn("band", band("n"))
    x, y = ("n", ["s"]), ("e.n", ["e.s"])
    lead = index.groupBy("tok", "band").agg(F.min(F.struct("id", "line_no", "n", "reach", "s")).alias("e"))
    later = F.struct("id", "line_no") > F.struct(F.col("e.id").alias("id"), F.col("e.line_no").alias("line_no"))
    star = (index.join(lead, ["tok", "band"]).where(later & F.expr("n <= e.reach and e.n <= reach and " + _bound(*x, *y, num, den)))
            .select("id", "line_no", F.col("e.id").alias("eid"), F.col("e.line_no").alias("eline")).distinct())
    settled = materialise(_compare(materialise(star), sets, num, den))
    low = F.greatest(F.col("n") * num / den, F.lit(1))

    def met_again(rows: DataFrame, once: bool) -> DataFrame:
        """Pairs of an unsettled line and an earlier one that share a key."""
        carried = ["id", "line_no", "n", "reach", "s", *(["seen"] if once else [])]
        asking = (rows.join(settled.select("id", "line_no"), ["id", "line_no"], "left_anti")
                  .select("tok", *carried, F.explode(F.sequence(band(low), F.greatest(band(low), band(F.greatest("reach", F.lit(1)))))).alias("band")))
        before = rows.select("tok", band("n").alias("band"), F.struct(*carried).alias("e"))
        return (asking.join(before, ["tok", "band"])
                .where(later & F.expr(f"n <= e.reach and e.n <= reach and {den} * n >= {num} * e.n and {den} * e.n >= {num} * n and " + _bound(*x, *y, num, den)
                                      + (" and not arrays_overlap(seen, e.seen)" if once else "")))
                .select("id", "line_no", F.col("e.id").alias("eid"), F.col("e.line_no").alias("eline")))

    parted = maybe_in(index, "tok", id_bitmap(counts.where(f"c > {MANY}"), "tok", BITS), BITS)
    rest = (met_again(parted.where("not _kl_maybe"), False)
            .unionByName(met_again(once_per_pair(parted.where("_kl_maybe")), True)).distinct())
    found = _compare(materialise(rest), sets, num, den)
    return exact.unionByName(short).unionByName(settled).unionByName(found)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 1,
                num: int = 4, den: int = 5) -> DataFrame:
    """``docs`` without the lines that repeat an earlier one; adds n_lines and n_removed."""
    cols = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    at = len(LAYERS)
    gone = materialise(repeated_lines(src, min_words, num, den)
                       .groupBy("id").agg(F.collect_list(F.struct("line_no", "k")).alias("_kl_gone")))
    # what led here is not read any more
    done, LAYERS[at:] = LAYERS[at:-1], LAYERS[-1:]
    release(docs.sparkSession, done)
    flagged = maybe_in(docs.select(*cols), id_col, id_bitmap(gone, "id"))
    lines = rf"split(`{text_col}`, '\n')"
    whole = (flagged.where(f"not _kl_maybe or `{id_col}` is null")
             .select(*cols, F.expr(f"cast(coalesce(size({lines}), 0) as bigint)").alias("n_lines"), F.lit(0).cast("bigint").alias("n_removed")))
    # a repeated id may carry another text: the key says whether the line is meant
    meant = rf"array_distinct(transform(filter(_kl_gone, r -> xxhash64(get(split({_plain('`' + text_col + '`')}, '\n'), r.line_no)) = r.k), r -> r.line_no))"
    cut = (flagged.where(f"_kl_maybe and `{id_col}` is not null").drop("_kl_maybe")
           .join(gone.withColumnRenamed("id", "_kl_id"), F.col(id_col) == F.col("_kl_id"), "left")
           .withColumn("_kl_lines", F.expr(lines))
           .withColumn("_kl_no", F.expr(f"case when _kl_gone is null then cast(array() as array<int>) else {meant} end"))
           .withColumn("_kl_left", F.expr("array_except(sequence(0, size(_kl_lines) - 1), _kl_no)"))
           .withColumn("_kl_new", F.expr("array_join(transform(_kl_left, i -> get(_kl_lines, i)), '\n')")))
    cut = cut.select(*[F.when(F.size("_kl_no") > 0, F.col("_kl_new")).otherwise(F.col(f"`{c}`")).alias(c) if c == text_col else F.col(f"`{c}`") for c in cols],
                     F.expr("cast(coalesce(size(_kl_lines), 0) as bigint)").alias("n_lines"), F.size("_kl_no").cast("bigint").alias("n_removed"))
    return whole.unionByName(cut)


def drop_emptied(deduped: DataFrame, text_col: str = "text") -> DataFrame:
    """Without the documents that lost lines and have only blank lines left, or none."""
    return deduped.where(rf"n_removed = 0 or `{text_col}` rlike '[^ \\t\\r\\n]'")
