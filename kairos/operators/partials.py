"""Metric partials (D9): a day-level state that rolls up to any coarser grain.

A finished metric often can't be added up: distinct customers of two days are not the sum, an average is
not the average of averages.  The state keeps what can be merged: sums, counts, minima and maxima; the
numerator and denominator of a ratio; and for exact distinct counts of integer ids bitmaps (blocks
of 32,768 ids, so an id costs at most a bit per day).  Ratios are derived after the merge.

``MetricTable`` stores the state by day: loading a day again replaces its state only, and months, quarters
or fewer dimensions are read from it without the rows.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from kairos.sources.commits import commit, committed, read_note

GRAINS = ("day", "week", "month", "quarter", "year")
#: how partial values merge
MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Measure:
    """``kind``: sum, count, min, max, distinct (integer ids) or ratio (of two sums or counts, by name)."""

    name: str
    kind: str
    expr: str = "1"
    over: str | None = None  # ratio: name of the denominator; ``expr`` names the numerator
    cast: str | None = None


class NotAdditive(ValueError):
    """A finished value that can't be added up was asked to be."""


def _check(measures: Sequence[Measure]) -> None:
    by = {m.name: m for m in measures}
    for m in measures:
        if m.kind not in (*MERGE, "distinct", "ratio"):
            raise ValueError(f"unknown kind {m.kind!r}")
        if m.kind == "ratio":
            for x in (m.expr, m.over):
                if x not in by or by[x].kind not in ("sum", "count"):
                    raise ValueError(f"ratio {m.name!r} needs sums or counts among the measures: {x!r}")


def day_values(df: DataFrame, measures: Sequence[Measure], time_col: str, dims: Sequence[str] = ()) -> DataFrame:
    """(day, dims, one column per sum, count, min and max): one aggregate over the rows."""
    _check(measures)
    aggs = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    cols = [aggs[m.kind](F.expr(m.expr)).alias(m.name) for m in measures if m.kind in aggs]
    cols = [c.cast(m.cast).alias(m.name) if m.cast else c for c, m in zip(cols, [m for m in measures if m.kind in aggs])]
    return df.groupBy(F.to_date(time_col).alias("day"), *dims).agg(*(cols or [F.count(F.lit(1)).alias("_rows")]))


def day_distinct(df: DataFrame, measures: Sequence[Measure], time_col: str, dims: Sequence[str] = ()) -> DataFrame | None:
    """(day, dims, measure, block, ids): bitmaps of the ids seen; None without a distinct measure."""
    _check(measures)
    named = [m for m in measures if m.kind == "distinct"]
    if not named:
        return None
    for m in named:
        if df.select(F.expr(m.expr)).schema[0].dataType.typeName() not in ("byte", "short", "integer", "long"):
            raise ValueError(f"{m.name!r} counts distinct integer ids; number other keys first")
    ids = F.explode(F.array(*[F.struct(F.lit(m.name).alias("measure"), F.expr(m.expr).cast("bigint").alias("id")) for m in named]))
    rows = df.select(F.to_date(time_col).alias("day"), *dims, ids.alias("_x")).select("day", *dims, "_x.*").where("id is not null")
    return (rows.groupBy("day", *dims, "measure", F.expr("bitmap_bucket_number(id)").alias("block"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(id))").alias("ids")))


def _period(grain: str) -> Column:
    if grain not in GRAINS:
        raise ValueError(f"a day-level state has no grain {grain!r}")
    return F.date_trunc(grain, F.col("day")).cast("timestamp_ntz").alias("period")


def roll_up(values: DataFrame, distinct: DataFrame | None, measures: Sequence[Measure], grain: str = "month", dims: Sequence[str] = ()) -> DataFrame:
    """The measures per period and ``dims`` (any of the state's), merged from day-level partials."""
    _check(measures)
    dims = list(dims)
    out = values.groupBy(_period(grain), *dims).agg(
        *[(MERGE[m.kind](m.name).cast(m.cast) if m.cast else MERGE[m.kind](m.name)).alias(m.name) for m in measures if m.kind in MERGE],
        F.count(F.lit(1)).alias("_parts")).drop("_parts")
    for name in [m.name for m in measures if m.kind == "distinct"]:
        merged = (distinct.where(F.col("measure") == name).groupBy(_period(grain), *dims, "block").agg(F.expr("bitmap_or_agg(ids)").alias("ids"))
                  .groupBy("period", *dims).agg(F.sum(F.expr("bitmap_count(ids)")).alias("_n")))
        on = F.lit(True)
        for c in ("period", *dims):
            on = on & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        out = out.alias("a").join(merged.alias("b"), on, "left").select("a.*", F.coalesce("b._n", F.lit(0)).alias(name))
    for m in measures:
        if m.kind == "ratio":
            over = F.col(m.over).cast("double")
            out = out.withColumn(m.name, F.when(over != 0, F.col(m.expr).cast("double") / over))
    return out.select("period", *dims, *[m.name for m in measures])


def add_up(finished: DataFrame, measures: Sequence[Measure], by: Sequence[str]) -> DataFrame:
    """Finished values added up over rows; distinct counts and ratios are refused."""
    bad = [m.name for m in measures if m.kind in ("distinct", "ratio")]
    if bad:
        raise NotAdditive(f"{', '.join(bad)} can't be added up: roll up the day-level state")
    return finished.groupBy(*by).agg(*[MERGE[m.kind](m.name).alias(m.name) for m in measures])


@dataclass
class MetricTable:
    """The state of ``measures`` by day and ``dims`` under ``path``.

    A load writes one generation (``values/gen=N``, ``distinct/gen=N``) and commits it; of every day the newest
    generation counts.  Files follow loads, not days.
    """

    spark: SparkSession
    path: str
    measures: Sequence[Measure]
    time_col: str
    dims: Sequence[str] = ()

    def load(self, df: DataFrame) -> None:
        """Replace the state of the days in ``df`` (which holds all rows of those days)."""
        done = committed(self.spark, self.path)
        since = read_note(self.spark, self.path, done[-1]).get("since", 0) if done else 0
        self._write(done[-1] + 1 if done else 0, day_values(df, self.measures, self.time_col, self.dims),
                    day_distinct(df, self.measures, self.time_col, self.dims), {"since": since})

    def _write(self, gen: int, values: DataFrame, distinct: DataFrame | None, note: dict) -> None:
        for name, state in (("values", values), ("distinct", distinct)):
            if state is not None:
                state.where("day is not null").write.mode("overwrite").parquet(os.path.join(self.path, name, f"gen={gen:06d}"))
        schemas = {"values": values.schema.jsonValue(), "distinct": distinct.schema.jsonValue() if distinct is not None else None}
        commit(self.spark, self.path, gen, note | schemas)

    def _state(self) -> tuple[DataFrame, DataFrame | None]:
        """The newest partials of every day."""
        done = committed(self.spark, self.path)
        if not done:
            raise ValueError(f"nothing was loaded under {self.path}")
        note = read_note(self.spark, self.path, done[-1])

        def rows(name):
            schema = StructType(list(StructType.fromJson(note[name]).fields)).add("gen", IntegerType())
            return (self.spark.read.schema(schema).parquet(os.path.join(self.path, name))
                    .where((F.col("gen") >= note["since"]) & (F.col("gen") <= done[-1])))

        newest = rows("values").groupBy("day").agg(F.max("gen").alias("gen"))
        return tuple(rows(n).join(newest, ["day", "gen"]).drop("gen") if note[n] else None for n in ("values", "distinct"))

    def compact(self) -> None:
        """Write the newest partials as one generation that later reads start from."""
        gen = committed(self.spark, self.path)[-1] + 1
        self._write(gen, *self._state(), {"since": gen})

    def read(self, grain: str = "month", dims: Sequence[str] | None = None) -> DataFrame:
        """The measures at ``grain`` over ``dims`` (default: all of the state's)."""
        dims = list(self.dims if dims is None else dims)
        if not set(dims) <= set(self.dims):
            raise ValueError(f"the state doesn't hold {sorted(set(dims) - set(self.dims))}")
        return roll_up(*self._state(), self.measures, grain, dims)
