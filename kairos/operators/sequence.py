"""Per-key sequence helpers that stay parallel when one key is hot.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task; if
one key holds a third of the data, that task holds a third of the data.  The
helpers here run the window on ``(key, slice)`` groups instead -- ``slice`` is
a coarse bucket of the ordering column, e.g. the month -- and stitch slice
borders with a per-(key, slice) summary that has at most one row per key and
slice.  The summary is built with a partial (map-side) aggregate, so the hot
key never gathers in one task, and the border window runs over slices only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def time_slice(c, unit: str = "month") -> Column:
    """Coarse time bucket used to split hot keys (NULL times go to one sentinel slice)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.date_trunc(unit, col).cast("timestamp_ntz"),
                      F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))


def with_neighbours(df: DataFrame, keys: Sequence[str], order: Sequence, take: Sequence[str],
                    slice_unit: str | None = None, prev_name: str = "_prev", next_name: str = "_next") -> DataFrame:
    """Add ``prev_name`` / ``next_name`` structs holding the ``take`` columns of the
    previous / next row of the same key, rows ordered by ``order`` (which must be
    unique within a key for a deterministic result; ``order[0]`` is the time).

    With ``slice_unit`` every key is windowed per (key, time slice) and slice
    borders are stitched from a per-(key, slice) summary built by a partial
    aggregate: no task holds more of a key than one slice.  Without it this is a
    plain lag/lead window, for keys known to be small.
    """
    keys = list(keys)
    order_c = _cols(order)
    payload = F.struct(*[F.col(c) for c in take])
    if slice_unit is None:
        w = Window.partitionBy(*keys).orderBy(*order_c)
        return (df.withColumn(prev_name, F.lag(payload).over(w))
                .withColumn(next_name, F.lead(payload).over(w)))
    slice_col = time_slice(order_c[0], slice_unit)
    d = df.withColumn("_slice", slice_col)
    w = Window.partitionBy(*keys, "_slice").orderBy(*order_c)
    d = (d.withColumn(prev_name, F.lag(payload).over(w))
         .withColumn(next_name, F.lead(payload).over(w))
         .withColumn("_is_first", F.lag(F.lit(1)).over(w).isNull())
         .withColumn("_is_last", F.lead(F.lit(1)).over(w).isNull()))
    okey = F.struct(*order_c)
    summary = (df.withColumn("_slice", slice_col).groupBy(*keys, "_slice")
               .agg(F.min_by(payload, okey).alias("_sf"), F.max_by(payload, okey).alias("_sl")))
    wb = Window.partitionBy(*keys).orderBy("_slice")
    summary = summary.select(*keys, "_slice",
                             F.lag("_sl").over(wb).alias("_pl"),
                             F.lead("_sf").over(wb).alias("_nf"))
    out = d.join(summary, [*keys, "_slice"], "left")
    return (out.withColumn(prev_name, F.when(F.col("_is_first"), F.col("_pl")).otherwise(F.col(prev_name)))
            .withColumn(next_name, F.when(F.col("_is_last"), F.col("_nf")).otherwise(F.col(next_name)))
            .drop("_slice", "_is_first", "_is_last", "_pl", "_nf"))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, keep: str = "last") -> DataFrame:
    """One row per key: the row with the greatest (``keep='last'``) or least
    (``keep='first'``) ``order`` tuple; ties are broken by the remaining columns
    in the same direction, so the pick is total and deterministic.

    Implemented as a ``max``/``min`` of one struct, so a row's columns are held once:
    partial aggregation runs map-side, so a hot key is pre-reduced before the shuffle.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order_names = {c for c in order if isinstance(c, str)}
    ranked = [c.alias(f"_o{i}") for i, c in enumerate(_cols(order))] + [F.col(c) for c in others if c not in order_names]
    at = {c: f"_o{i}" for i, c in enumerate(order) if isinstance(c, str)}
    pick = F.max if keep == "last" else F.min
    return (df.groupBy(*keys).agg(pick(F.struct(*ranked)).alias("_r"))
            .select(*keys, *[F.col("_r")[at.get(c, c)].alias(c) for c in others]))
