"""D9/D10 metric registry: a measure evaluated at a time grain over dimensions.

A metric is a declaration (expression, filters, additivity); evaluation is a
single ``groupBy(date_trunc(grain), *dims).agg(...)``.  Semi-additive metrics
(balances, open counts) are not summed over time: the last value per entity
and period is taken first, then summed across entities.  With ``carry`` an entity
counts in every period from its first row on, also where it has no row
(``carried_balance``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kairos.operators.sequence import latest_per_key

AGGS = {
    "sum": lambda c: F.sum(c),
    "count": lambda c: F.count(c),
    "count_distinct": lambda c: F.count_distinct(c),
    "avg": lambda c: F.avg(c),
    "min": lambda c: F.min(c),
    "max": lambda c: F.max(c),
    "median": lambda c: F.median(c),
}


@dataclass
class Metric:
    name: str
    agg: str
    expr: str
    time_col: str
    filters: Sequence[str] = field(default_factory=list)
    additive: bool = True
    entity: str | None = None  # required for semi-additive metrics
    cast: str | None = None
    carry: bool = False  # semi-additive: go on with the last value in periods without a row
    until: str | None = None  # with carry: column of the time at which a row's value ends (null: open)


def grouped_median(df: DataFrame, by: Sequence[str], value: str, buckets: int = 1024) -> DataFrame:
    """Exact median per group in two passes, without holding a group's values in one task.

    Approximate quantiles cut each group into at most ``buckets`` ranges; counting the
    ranges shows which of them hold the middle one or two values, and only those
    ranges' rows are ranked.  A value that fills a range alone is counted, not ranked.
    """
    by = list(by)
    d = df.where(F.col(value).isNotNull())
    cuts = d.groupBy(*by).agg(F.percentile_approx(value, [i / 32 for i in range(1, 32)], buckets).alias("_cuts"),
                              F.count(F.lit(1)).alias("_n"))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"c.{c}")) for c in by]
    cond = same[0]
    for x in same[1:]:
        cond = cond & x
    # counts per distinct value first: equal values meet before the shuffle
    values = d.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_k"))
    placed = (values.alias("d").join(cuts.alias("c"), cond)
              .select(*[F.col(f"d.{c}").alias(c) for c in by], F.col(f"d.{value}").alias("_v"), "_k", "_n",
                      F.size(F.filter("_cuts", lambda q: q < F.col(f"d.{value}"))).alias("_b")))
    w = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (placed.groupBy(*by, "_b").agg(F.sum("_k").alias("_in"), F.max("_n").alias("_total"))
              .withColumn("_before", F.coalesce(F.sum("_in").over(w), F.lit(0)))
              # the middle ranks, counted from 1
              .withColumn("_lo", F.expr("(_total + 1) div 2")).withColumn("_hi", F.expr("(_total + 2) div 2"))
              .where("_hi > _before and _lo <= _before + _in"))
    same = F.col("p._b") == F.col("r._b")
    for c in by:
        same = same & F.col(f"p.{c}").eqNullSafe(F.col(f"r.{c}"))
    rows = (placed.alias("p").join(ranges.alias("r"), same)
            .select(*[F.col(f"p.{c}").alias(c) for c in by], "_v", "_k", F.col("p._b").alias("_b"), "_before", "_lo", "_hi"))
    upto = Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_end", F.col("_before") + F.sum("_k").over(upto)).withColumn("_start", F.col("_end") - F.col("_k"))
    middle = rows.where("_hi > _start and _lo <= _end")
    return middle.groupBy(*by).agg(((F.min("_v") + F.max("_v")) / 2).alias("median"))


def carried_balance(df: DataFrame, entity: str, time_col: str, value: str, dims: Sequence[str] = (), grain: str = "month",
                    name: str = "balance", until: str | None = None, last_period=None) -> DataFrame:
    """Balance at the end of every period, each entity with its latest value so far, by difference arrays.

    An entity's last row of a period adds its value there and takes it off in the period of its next row (or
    the one in which ``until`` falls); sums of these differences per period, added up in time, are the balances.
    Rows follow the changes, not entities times periods; a task holds one row per period of an entity or of ``dims``.

    ``value`` must be of an exact type (integer or decimal).  The result has every period from a group's
    first to ``last_period`` (default: the last one in the data) in which an entity counts, with ``n_entities``.
    Rows without an entity or a time belong to no balance.
    """
    dims = list(dims)
    period = F.date_trunc(grain, F.col(time_col)).cast("timestamp_ntz")
    end = F.lit(None).cast("timestamp_ntz") if until is None else F.date_trunc(grain, F.col(until)).cast("timestamp_ntz")
    rows = df.where(F.col(entity).isNotNull() & F.col(time_col).isNotNull()).select(
        period.alias("period"), *dims, F.col(entity).alias("_e"), F.col(time_col).alias("_t"), F.expr(value).alias("_v"), end.alias("_end"))
    if rows.schema["_v"].dataType.typeName() in ("float", "double"):
        raise ValueError("a carried balance needs an exact value: cast it to a decimal")
    last = latest_per_key(rows, ["period", "_e"], ["_t"])
    following = F.lead("period").over(Window.partitionBy("_e").orderBy("period"))
    steps = (last.withColumn("_off", F.least(following, F.col("_end"))).where("_off is null or _off > period")
             .select(*dims, F.explode(F.array(F.struct("period", F.col("_v").alias("_d"), F.lit(1).alias("_n")),
                                              F.struct(F.col("_off").alias("period"), (-F.col("_v")).alias("_d"), F.lit(-1).alias("_n")))).alias("_s"))
             .select(*dims, "_s.*").where("period is not null"))
    final = rows.agg(F.max("period")).scalar() if last_period is None else F.lit(last_period).cast("timestamp_ntz")
    zero = F.lit(0)
    # every period of a group, so that a period without a change has a row too
    grid = (steps.groupBy(*dims).agg(F.min("period").alias("_first")) if dims else steps.agg(F.min("period").alias("_first")))
    grid = (grid.withColumn("_final", final).where("_first <= _final")
            .select(*dims, F.explode(F.sequence("_first", "_final", F.expr(f"INTERVAL 1 {grain}"))).alias("period"),
                    zero.cast(steps.schema["_d"].dataType).alias("_d"), zero.alias("_n")))
    sums = steps.unionByName(grid).groupBy(*dims, "period").agg(F.sum("_d").alias("_d"), F.sum("_n").alias("_n"))
    upto = Window.partitionBy(*(dims or [F.lit(1)])).orderBy("period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = sums.select(*dims, "period", F.sum("_d").over(upto).alias(name), F.sum("_n").over(upto).alias("n_entities"), F.lit(final).alias("_final"))
    return out.where("n_entities > 0 and period <= _final").select("period", *dims, name, "n_entities")


def _evaluate_carried(metric: Metric, d: DataFrame, dims: Sequence[str], grain: str) -> DataFrame:
    if metric.agg not in ("sum", "count") or not metric.entity:
        raise ValueError("a carried balance is a sum or a count and needs an entity column")
    value = metric.expr if metric.agg == "sum" else f"cast({metric.expr} is not null as int)"
    if metric.agg == "sum" and metric.cast:
        value = f"cast({value} as {metric.cast})"
    out = carried_balance(d, metric.entity, metric.time_col, value, dims, grain, metric.name, metric.until).drop("n_entities")
    return out.withColumn(metric.name, F.col(metric.name).cast(metric.cast)) if metric.cast else out


def evaluate(metric: Metric, df: DataFrame, dims: Sequence[str] = (), grain: str = "month") -> DataFrame:
    """Evaluate one metric at ``grain`` over ``dims``."""
    d = df
    for f in metric.filters:
        d = d.where(F.expr(f))
    if metric.carry:
        return _evaluate_carried(metric, d, dims, grain)
    period = F.date_trunc(grain, F.col(metric.time_col)).cast("timestamp_ntz").alias("period")
    value = F.expr(metric.expr)
    if not metric.additive:
        if not metric.entity:
            raise ValueError("semi-additive metric needs an entity column")
        d = d.select(period, *dims, metric.entity, F.col(metric.time_col).alias("_t"), value.alias("_v"))
        # one row per entity and period; an entity that changes a dimension counts under its last value
        d = latest_per_key(d, ["period", metric.entity], ["_t"])
        value = F.col("_v")
        period = F.col("period")
    if metric.agg == "median":
        out = grouped_median(d.select(period, *dims, value.alias("_v")), ["period", *dims], "_v").withColumnRenamed("median", metric.name)
    else:
        out = d.groupBy(period, *dims).agg(AGGS[metric.agg](value).alias(metric.name))
    if metric.cast:
        out = out.withColumn(metric.name, F.col(metric.name).cast(metric.cast))
    return out


def evaluate_many(metrics: Sequence[Metric], df: DataFrame, dims: Sequence[str] = (),
                  grain: str = "month") -> DataFrame:
    """Several additive metrics with the same filters in one aggregate pass."""
    base = metrics[0]
    if any(not m.additive or list(m.filters) != list(base.filters) or m.time_col != base.time_col
           for m in metrics):
        raise ValueError("evaluate_many needs additive metrics with identical filters and time column")
    d = df
    for f in base.filters:
        d = d.where(F.expr(f))
    period = F.date_trunc(grain, F.col(base.time_col)).cast("timestamp_ntz").alias("period")
    aggs = []
    for m in metrics:
        a = AGGS[m.agg](F.expr(m.expr))
        aggs.append((a.cast(m.cast) if m.cast else a).alias(m.name))
    return d.groupBy(period, *dims).agg(*aggs)
