"""Mixing sources to target weights by Pareto order sampling, with DataFrame operations only.

1. *Targets.*  A document's size is its number of words.  Sources in code point order
   (null last) take ``weights`` in turn and share ``share`` of all words by weight.  No target exceeds ``cap``
   times its source's size; the excess is shared again by weight until none is above: rounds of one aggregate
   over the table of sources, each of which fetches three numbers.
2. *Whole copies.*  A document is wanted ``e`` times: target / source size, or more by its own ``weight_col``
   (relative, ``cap`` at most).  ``floor(e)`` copies are certain, the rest is its inclusion probability.
3. *Pareto order sampling.*  With U uniform from the id's hash, documents are ranked by the random odds
   U / (1 - U) divided by the inclusion odds; the first ones are taken once more, a fixed number of each source's
   size class.  Classes are an eighth of an octave wide, and their numbers are rounded from the largest
   class down, each carrying on what the classes before it took too much or too little, so the words taken stay
   near the target although single documents differ 20,000-fold.

Ranks are found without gathering a class: documents fall into ranges of their ranking number, counts of
the ranges show which one holds the last to be taken, and only within ranges rows are numbered.

Corner cases: null or empty text has size 0 and takes 0 words; a null source is one of its own; rows with equal id, source
and size are alike, so ties change nothing; repeated rows are documents of their own; an empty table gives no rows; other
columns are not read.  The draw depends on id, size and ``seed`` alone: reruns and other partitionings agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kairos.llm.common import materialise

#: inclusion probabilities are whole multiples of 2**-30, so that their sums don't depend on order
UNIT = 1 << 30
WORD = r"[^\x20\x09-\x0D]+"


def global_order(rows: DataFrame, *order: Column | str) -> DataFrame:
    """``rows`` with ``place`` (from 0) in the given order: numbered within ranges, offset by the ranges' counts."""
    ranged = materialise(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offset = ranged.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"))
    number = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.withColumn("_number", number).join(offset, "_part").withColumn("place", F.col("_at") + F.col("_number") - 1).drop("_part", "_number", "_at")


def _whole(x: str) -> str:
    return f"cast({x} as decimal(19,0))"


def targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.0, cap: int = 3) -> DataFrame:
    """(source, source_size, weight, target, place) of every source in ``sizes`` (source, size)."""
    found = global_order(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), F.col("source").isNull(), F.col("source"))
    turn = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = materialise(found.withColumn("weight", turn.cast("bigint")))
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    total = int(total * share) if share != 1.0 else total
    full, before = "false", None
    while True:
        now = rows.agg(F.sum(F.expr(f"case when {full} then 0 else weight end")),
                       F.sum(F.expr(f"case when {full} then {_whole('source_size')} * {cap} else 0 end"))).first()
        open_weight, capped = int(now[0] or 0), int(now[1] or 0)
        if (open_weight, capped) == before:
            break
        before = open_weight, capped
        # full: an equal share of what is left would be the cap or more
        full = f"({_whole('source_size')} * {cap * open_weight}BD <= {_whole('weight')} * {total - capped}BD)" if open_weight else "true"
    fair = F.col("weight").cast("double") * F.lit(float(total - capped)) / F.lit(float(open_weight or 1))
    return rows.withColumn("target", F.when(F.expr(full), (F.col("source_size") * cap).cast("double")).otherwise(fair))


def _wanted(rows: DataFrame, cap: int, rounds: int = 64) -> DataFrame:
    """``e``: copies wanted of each document, proportional to its ``own`` weight within a source, ``cap`` at most."""
    level = rows.select("place", "target").distinct().withColumn("level", F.lit(None).cast("double"))
    for _ in range(rounds):
        at = rows.join(level.select("place", "level"), "place")
        full = F.coalesce(F.col("own") * F.col("level") >= cap, F.lit(False))
        left = at.groupBy("place").agg(F.sum(F.when(full, F.col("size") * cap).otherwise(0)).alias("fixed"),
                                       F.sum(F.when(full, F.lit(0).cast("decimal(38,6)")).otherwise(
                                           F.col("own").cast("decimal(18,6)") * F.col("size"))).cast("double").alias("free"))
        fair = F.when(F.col("free") > 0, F.greatest(F.lit(0.0), (F.col("target") - F.col("fixed")) / F.col("free")))
        new = materialise(level.join(left, "place").select("place", "target", fair.alias("level")))
        same = level.join(new.select("place", F.col("level").alias("new")), "place").where("not (level <=> new)").isEmpty()
        level = new
        if same:
            break
    return rows.join(level.select("place", "level"), "place").withColumn("e", F.least(F.lit(float(cap)), F.coalesce(F.col("own") * F.col("level"), F.lit(float(cap)))))


def size_class(size: str) -> Column:
    """Eighths of an octave, one class for each size under 16; from the binary digits alone."""
    return F.expr(f"case when {size} < 16 then cast({size} as int) else length(bin({size})) * 8 "
                  f"+ cast(shiftright({size}, length(bin({size})) - 4) & 7 as int) end")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weight_col: str | None = None,
        weights: Sequence[int] = (5, 2, 1), share: float = 1.0, cap: int = 3, seed: int = 0) -> DataFrame:
    """(id, size, source_size, target, copies, taken) of every document; ``taken`` is copies times size."""
    own = F.lit(1.0) if weight_col is None else F.coalesce(F.col(weight_col).cast("double"), F.lit(1.0))
    sizes = materialise(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                                    F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"), own.alias("own")))
    of = targets(sizes, weights, share, cap)
    rows = (sizes.alias("d").join(of.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
            .select("d.id", "d.size", "d.own", "t.source_size", "t.target", "t.place"))
    if weight_col is None:
        rows = rows.withColumn("e", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    else:
        rows = materialise(_wanted(rows, cap))
    rows = (rows.withColumn("sure", F.floor("e")).withColumn("part", F.floor((F.col("e") - F.col("sure")) * UNIT)).withColumn("class", size_class("size")))
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), "size", F.lit(str(seed)))), 1, 13), 16, 10)
    u, p = F.col("_u"), F.col("part") / F.lit(float(UNIT))
    chance = (rows.where("part > 0 and size > 0").withColumn("_u", (draw.cast("bigint") + 0.5) / F.lit(float(1 << 52)))
              .withColumn("_q", (u / (1 - u)) / (p / (1 - p))).drop("_u"))
    # as many ranges as leave a few thousand documents in each, were a source and class to hold all of them
    ranges = 1 << min(16, (sizes.count() >> 12).bit_length())
    chance = chance.withColumn("_range", F.floor(F.col("_q") / (1 + F.col("_q")) * ranges))

    counts = chance.groupBy("place", "class", "_range").agg(F.count("*").alias("n"), F.sum("part").cast("decimal(38,0)").alias("wanted"),
                                                            F.sum(F.expr(f"{_whole('part')} * {_whole('size')}")).cast("decimal(38,0)").alias("words"))
    counts = materialise(counts)
    upto = Window.partitionBy("place", "class").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    last = (counts.withColumn("_before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
            .join(class_numbers(counts), ["place", "class"])
            .select("place", "class", "_range", (F.col("take") - F.col("_before")).alias("_left")))
    within = Window.partitionBy("place", "class", "_range").orderBy("_q", "id", "size")
    drawn = (chance.withColumn("_number", F.row_number().over(within)).join(last, ["place", "class", "_range"])
             .withColumn("copies", F.col("sure") + F.when(F.col("_number") <= F.col("_left"), 1).otherwise(0)))
    sure = rows.where("not (part > 0 and size > 0)").withColumn("copies", F.col("sure"))
    cols = ["id", "size", "source_size", "target", "copies"]
    return (sure.select(*cols).unionByName(drawn.select(*cols))
            .select(F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")))


def class_numbers(counts: DataFrame) -> DataFrame:
    """(place, class, take): documents to take of each size class, rounded from the largest class down.

    A class should give ``words``; what earlier classes gave beyond or below theirs is carried on.
    """
    per = (counts.groupBy("place", "class").agg(F.sum("n").alias("n"), (F.sum("wanted").cast("double") / UNIT).alias("wanted"),
                                                (F.sum("words").cast("double") / UNIT).alias("words"))
           .groupBy("place").agg(F.sort_array(F.collect_list(F.struct("class", "n", "wanted", "words")), asc=False).alias("cs")))
    step = """aggregate(cs, named_struct('carry', cast(0 as double), 'out', cast(array() as array<struct<class:int,take:bigint>>)),
      (s, c) -> transform(array(least(c.n, greatest(0L, cast(floor((c.words + s.carry) / (c.words / c.wanted) + 0.5D) as bigint)))),
        t -> named_struct('carry', s.carry + c.words - t * (c.words / c.wanted),
                          'out', concat(s.out, array(named_struct('class', c.class, 'take', t)))))[0],
      s -> s.out)"""
    return per.select("place", F.inline(F.expr(step)))
