"""Document fingerprints by winnowing, in DataFrame operations only.

Every k-gram of words (lower case, split at white space) is hashed; of each
window of ``w`` consecutive k-grams the smallest hash is chosen, the rightmost
one of ties, and its position is kept.  Two texts that share a run of
``k + w - 1`` words choose at least one common k-gram from it.

A chosen gram is one number: 40 bits of hash, then the position counted down
(23 bits, modulo 2**23), so that the smallest number of a window is the
smallest hash, rightmost first.  The fingerprint lists "hash:position" in hex.

Defined cases: null and empty texts, and texts without a word, have an empty
fingerprint; two empty fingerprints have likeness 1, an empty and another 0.
Fewer words than ``k``: the whole text is one gram.  Repeated rows stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kairos.llm.common import materialise

_POS = (1 << 23) - 1


def _grams_sql(text: str, k: int) -> str:
    """Numbers of all k-grams of a text, in order."""
    flat = rf"replace(replace(replace(lower({text}), '\n', ' '), '\t', ' '), '\r', ' ')"
    words = f"transform(array_remove(split({flat}, ' '), ''), x -> xxhash64(x))"
    parts = ", ".join(f"get(h, i + {j})" for j in range(k))
    number = f"shiftleft(xxhash64({parts}) & {(1 << 40) - 1}L, 23) | ({_POS} - (i & {_POS}))"
    # a let: the word hashes are made once
    return (f"element_at(transform(array({words}), h -> case when size(h) = 0 then cast(array() as array<bigint>) "
            f"else transform(sequence(0, greatest(size(h) - {k}, 0)), i -> {number}) end), 1)")


def chosen_sql(text: str, k: int, w: int) -> str:
    """Chosen grams of a text, by position."""
    return (f"element_at(transform(array({_grams_sql(text, k)}), g -> case when size(g) = 0 then g "
            f"else array_distinct(transform(sequence(1, greatest(size(g) - {w} + 1, 1)), i -> array_min(slice(g, i, {w})))) end), 1)")


def text_sql(chosen: str) -> str:
    """Fingerprint as text: hash:position in hex."""
    return f"array_join(transform({chosen}, x -> concat(hex(shiftright(x, 23)), ':', hex({_POS} - (x & {_POS})))), ',')"


def likeness_sql(a: str, b: str) -> str:
    """Jaccard similarity of the distinct chosen hashes (0 to 1)."""
    x, y = (f"transform({c}, x -> shiftright(x, 23))" for c in (a, b))
    common = f"size(array_intersect({x}, {y}))"
    return (f"case when size({a}) = 0 and size({b}) = 0 then 1D else "
            f"{common} / cast(size(array_distinct({x})) + size(array_distinct({y})) - {common} as double) end")


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint", k: int = 3, w: int = 4) -> DataFrame:
    """Add the fingerprint of every whole text; other columns pass through."""
    return (docs.withColumn(out_col, F.expr(chosen_sql(f"coalesce(`{text_col}`, '')", k, w)))
            .withColumn(out_col, F.expr(text_sql(f"`{out_col}`"))))


def with_next(rows: DataFrame, columns: list[str], order: str = "id", buckets: int = 1024,
              derive: dict[str, str] | None = None) -> DataFrame:
    """Add ``next_<column>`` of the following row in ascending order; after the last comes the first.

    ``derive`` names further columns as SQL over ``rows``, made once for every row.

    Rows are dealt to ranges of the order column, cut at approximate quantiles, and
    follow each other within a range; a range's last row takes the next range's
    first one.  Ties go by ``h``.  No task holds more than a range.
    """
    cuts = rows.select(F.percentile_approx(order, [i / buckets for i in range(1, buckets)], 10 * buckets)).first()[0] or []
    cuts = sorted(set(cuts))
    lookup = "array(" + ", ".join(f"{c}L" for c in cuts) + ")" if cuts else "cast(array() as array<bigint>)"
    def made(df: DataFrame) -> DataFrame:
        return df.withColumns({n: F.expr(e) for n, e in (derive or {}).items()})

    dealt = rows.withColumn("bucket", F.expr(f"aggregate({lookup}, 0, (n, c) -> n + if(c <= {order}, 1, 0))"))
    inside = Window.partitionBy("bucket").orderBy(order, "h")
    led = made(dealt).withColumns({f"next_{c}": F.lead(c).over(inside) for c in columns} | {"_has": F.lead(F.lit(True)).over(inside)})
    # at most one row a range: first and last by (order, h)
    ends = dealt.groupBy("bucket").agg(F.min(F.struct(order, "h")).alias("first"), F.max(F.struct(order, "h")).alias("last"))
    edges = (ends.withColumn("follows", F.coalesce(F.lead("first").over(Window.orderBy("bucket")),
                                                   F.first("first").over(Window.orderBy("bucket"))))
             .select("last", "follows"))
    # one row a range at most: no more than ``buckets`` rows of an id and a number are broadcast
    edges = materialise(edges)
    key = F.struct(order, "h")
    lasts = made(rows.join(F.broadcast(edges), key.eqNullSafe(F.col("last"))).drop("last").dropDuplicates([order, "h"]))
    heads = made(rows.join(F.broadcast(edges.select("follows")), key.eqNullSafe(F.col("follows")), "left_semi").dropDuplicates([order, "h"]))
    heads = heads.select(key.alias("_first"), *[F.col(c).alias(f"next_{c}") for c in columns])
    last = lasts.join(heads, F.col("follows").eqNullSafe(F.col("_first"))).drop("follows", "_first")
    return led.where("_has").drop("bucket", "_has").unionByName(last)


def edit_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, w: int = 4) -> DataFrame:
    """Fingerprints of every text and of its edit, whose second half comes from the next document."""
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .withColumn("h", F.xxhash64("text")))
    pairs = with_next(rows, ["text", "c"], derive={"c": chosen_sql("text", k, w)})
    edited = (pairs.withColumn("n", F.length("text"))
              .withColumn("edited", F.expr("concat(substring(text, 1, n - n div 2), substring(next_text, 1, n div 2))"))
              .withColumn("e", F.expr(chosen_sql("edited", k, w))))
    return edited.select(
        F.col("id").alias(id_col), F.col("n").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        F.expr(text_sql("c")).alias("fingerprint"), F.expr(text_sql("e")).alias("edited_fingerprint"),
        F.expr(likeness_sql("c", "e")).alias("near_edited"), F.expr(likeness_sql("c", "next_c")).alias("near_next"))
