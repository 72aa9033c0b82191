"""Aggregations and history-safe features.

D1/D2 order_payments, D3 customer_orders, D4 order_items_summary, D7 rfm,
D8 daily_totals, D11 periodic_snapshot, D12 accumulating_snapshot,
D13 state_at, E5 history_safe_totals, E6 order_gaps, E7 daily_baseline.

Money is DECIMAL(18,2): sums are exact, so results do not depend on the
order in which partial aggregates meet.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kairos.functions.scalars import as_of as _as_of
from kairos.functions.scalars import day_diff, epoch_micros, packed_key, seconds_between, unpacked_key
from kairos.operators.sequence import time_slice, with_neighbours


def _count_if(cond) -> F.Column:
    return F.count(F.when(cond, F.lit(1)))


def order_payments(stg_payments: DataFrame, key: str = "order_master_sk", packed: bool = False) -> DataFrame:
    """D1/D2 (int_order_payments): attempts, paid amount, status counts, is_paid per order.

    Keys, text or packed already, cross the shuffle packed; ``packed`` leaves them so, for a join on them that needs no further exchange."""
    st = F.col("payment_status")
    if stg_payments.schema[key].dataType.typeName() == "string":
        stg_payments = stg_payments.withColumn(key, packed_key(key))
    out = stg_payments.groupBy(key).agg(
        F.count("payment_id").alias("payment_attempts"),
        F.sum(F.when(st == "success", F.col("amount")).otherwise(F.lit(0).cast("decimal(18,2)")))
        .cast("decimal(18,2)").alias("paid_amount"),
        _count_if(st == "success").alias("successful_payments"),
        _count_if(st == "failed").alias("failed_payments"),
        _count_if(st == "refunded").alias("refunded_payments"),
        ((F.max(F.when(st == "success", 1).otherwise(0)) == 1)
         & (F.max(F.when(st == "refunded", 1).otherwise(0)) == 0)).alias("is_paid"))
    return out if packed else out.withColumn(key, unpacked_key(key))


def customer_orders(stg_orders: DataFrame, key: str = "customer_master_sk") -> DataFrame:
    """D3 (int_customer_orders): order totals per customer entity, current versions only."""
    o = stg_orders.where(F.col("is_current"))
    return o.groupBy(key).agg(
        F.count("order_id").alias("total_orders"),
        F.sum("amount").cast("decimal(18,2)").alias("total_spent"),
        F.min("placed_at").alias("first_order_at"),
        F.max("placed_at").alias("last_order_at"),
        _count_if(F.col("status") == "returned").alias("returned_orders"),
        _count_if(F.col("status") == "completed").alias("completed_orders"))


def order_items_summary(stg_order_items: DataFrame, key: str = "order_id", few: bool = False) -> DataFrame:
    """Item count, quantity, distinct products and average unit price per order.

    ``few`` says that a key has a handful of items: they meet in one exchange instead of two."""
    if few:
        stg_order_items = stg_order_items.repartition(key)
    return stg_order_items.groupBy(key).agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("quantity").cast("bigint").alias("total_quantity"),
        F.count_distinct("product_id").alias("unique_products"),
        (F.sum("unit_price").cast("double") / F.count("unit_price").cast("double")).alias("avg_unit_price"))


def rfm(orders: DataFrame, customer: str, order_id: str, ts: str, amount: str, as_of=None,
        status: str | None = None, completed_value: str = "completed") -> DataFrame:
    """Recency (days), distinct-order frequency and monetary sum on completed orders."""
    o = orders if status is None else orders.where(F.col(status) == completed_value)
    return o.groupBy(customer).agg(
        day_diff(F.max(ts), _as_of(as_of)).alias("recency_days"),
        F.count_distinct(order_id).alias("frequency"),
        F.sum(amount).cast("decimal(18,2)").alias("monetary"))


def daily_totals(df: DataFrame, ts: str, measures: dict[str, str]) -> DataFrame:
    """One row per day, recomputed (not appended) -- write with dynamic overwrite."""
    return df.groupBy(F.to_date(ts).alias("day")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.sum(c).cast("decimal(18,2)").alias(name) for name, c in measures.items()])


def periodic_snapshot(history: DataFrame, key: str, start: str, end: str, attrs: Sequence[str],
                      valid_from: str = "valid_from", valid_to: str = "valid_to",
                      step: str = "1 day") -> DataFrame:
    """One row per entity and grid point, with the version valid at that point.

    The grid starts at ``start`` and goes on by ``step`` (a day, a week, a month)
    up to ``end``, the same for every version.  For steps of hours, days or weeks a version's first and last
    point follow by arithmetic, so work follows the rows that come out; longer steps filter the grid,
    which doesn't grow with the data.
    """
    s = F.lit(start).cast("timestamp_ntz")
    e = F.lit(end).cast("timestamp_ntz")
    vf, vt = F.col(valid_from), F.col(valid_to)
    h = history.where((vf <= e) & (vt.isNull() | (vt > s)))
    even = re.fullmatch(r"(\d+) (hour|day|week)s?", step.strip().lower())
    if even is None:
        grid = F.sequence(s, e, F.expr(f"INTERVAL {step}"))
        return h.select(key, *attrs, F.explode(F.filter(grid, lambda p: (p >= vf) & (vt.isNull() | (p < vt)))).alias("snapshot_at"))
    seconds = int(even[1]) * {"hour": 3600, "day": 86_400, "week": 604_800}[even[2]]
    width = F.lit(seconds * 1_000_000)

    def steps(micros):  # whole steps in a time after the start
        return ((micros - F.pmod(micros, width)).cast("decimal(20,0)") / width.cast("decimal(20,0)")).cast("bigint")

    zero = epoch_micros(s)
    first = steps(F.greatest(epoch_micros(vf) - zero, F.lit(0)) + width - 1)
    last = steps(F.least(epoch_micros(e), F.coalesce(epoch_micros(vt) - 1, epoch_micros(e))) - zero)
    points = h.withColumn("_first", first).withColumn("_last", last).where("_first <= _last")
    at = s + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("_k") * seconds).cast("decimal(18,6)"))
    return points.select(key, *attrs, F.explode(F.sequence("_first", "_last")).alias("_k")).select(key, *attrs, at.alias("snapshot_at"))


def accumulating_snapshot(changes: DataFrame, key: str, stage_col: str, ts: str,
                          stages: Sequence[str]) -> DataFrame:
    """One row per process: first time each stage was reached, and lags in seconds."""
    firsts = [F.min(F.when(F.col(stage_col) == s, F.col(ts))).alias(f"{s}_at") for s in stages]
    out = changes.groupBy(key).agg(*firsts)
    for a, b in zip(stages, stages[1:]):
        out = out.withColumn(f"{a}_to_{b}_s", seconds_between(f"{a}_at", f"{b}_at"))
    return out


def state_at(history: DataFrame, t, by: Sequence[str], valid_from: str = "valid_from",
             valid_to: str = "valid_to") -> DataFrame:
    """Count of entities per attribute value as of time ``t``."""
    tt = _as_of(t)
    alive = history.where((F.col(valid_from) <= tt) & (F.col(valid_to).isNull() | (tt < F.col(valid_to))))
    return alive.groupBy(*by).agg(F.count(F.lit(1)).alias("n_entities"))


def history_safe_totals(df: DataFrame, key: str, ts: str, value: str, prefix: str = "prior_",
                        slice_unit: str | None = "year") -> DataFrame:
    """E5: sum and count of *strictly earlier* rows of the same key (ties excluded).

    ``rangeBetween(unboundedPreceding, -1)`` over microseconds excludes rows at
    the same timestamp, so no row sees its own or a simultaneous outcome.  Keys
    are windowed per (key, time slice) and get the totals of their earlier slices
    from a one-row-per-(key, slice) aggregate; ``slice_unit=None`` takes whole keys.
    """
    micros = epoch_micros(ts)
    if slice_unit is None:
        w = Window.partitionBy(key).orderBy(micros).rangeBetween(Window.unboundedPreceding, -1)
        return (df.withColumn(f"{prefix}sum", F.coalesce(F.sum(value).over(w), F.lit(0)).cast("decimal(18,2)"))
                .withColumn(f"{prefix}count", F.count(F.lit(1)).over(w).cast("bigint")))
    sl = time_slice(ts, slice_unit)
    d = df.withColumn("_slice", sl)
    w = (Window.partitionBy(key, "_slice").orderBy(micros)
         .rangeBetween(Window.unboundedPreceding, -1))
    d = (d.withColumn("_in_sum", F.sum(value).over(w))
         .withColumn("_in_cnt", F.count(F.lit(1)).over(w)))
    tot = (df.withColumn("_slice", sl).groupBy(key, "_slice")
           .agg(F.sum(value).alias("_s_sum"), F.count(F.lit(1)).alias("_s_cnt")))
    wb = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(key, "_slice", F.sum("_s_sum").over(wb).alias("_b_sum"),
                     F.sum("_s_cnt").over(wb).alias("_b_cnt"))
    out = d.join(tot, [key, "_slice"], "left")
    zero = F.lit(0)
    return (out.withColumn(f"{prefix}sum", (F.coalesce(F.col("_in_sum"), zero) + F.coalesce(F.col("_b_sum"), zero))
                           .cast("decimal(18,2)"))
            .withColumn(f"{prefix}count", (F.coalesce(F.col("_in_cnt"), zero) + F.coalesce(F.col("_b_cnt"), zero))
                        .cast("bigint"))
            .select(*df.columns, f"{prefix}sum", f"{prefix}count"))


def order_gaps(df: DataFrame, key: str, ts: str, order_id: str, slice_unit: str | None = "year") -> DataFrame:
    """Days between consecutive orders per key, and their average (keys split by time slice)."""
    g = with_neighbours(df.select(key, order_id, ts), [key], [ts, order_id], [ts], slice_unit)
    g = g.select(key, order_id, ts, day_diff(F.col(f"_prev.{ts}"), F.col(ts)).alias("days_since_prev"))
    return g.groupBy(key).agg(F.count(F.lit(1)).alias("n_orders"),
                              F.avg("days_since_prev").alias("avg_days_between"))


def daily_baseline(df: DataFrame, ts: str, days: int = 7, threshold: float = 0.2) -> DataFrame:
    """Daily row counts with the mean and spread of the previous ``days`` days;
    ``is_anomaly`` when the count deviates more than ``threshold`` from the mean.

    Every day from the first to the last has a row: a day without data counts 0,
    in its own row and in the baselines of the days after it.  The data is first
    reduced to one row per day, so the unpartitioned window only sees days.
    """
    seen = df.where(F.col(ts).isNotNull()).groupBy(F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))
    calendar = seen.agg(F.min("day").alias("a"), F.max("day").alias("b")).select(F.explode(F.sequence("a", "b")).alias("day"))
    daily = calendar.join(seen, "day", "left").select("day", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"))
    w = Window.orderBy("day").rowsBetween(-days, -1)
    out = (daily.withColumn("baseline_avg", F.avg("n_rows").over(w))
           .withColumn("baseline_std", F.stddev_samp("n_rows").over(w)))
    away = F.abs(F.col("n_rows") - F.col("baseline_avg")) > F.lit(threshold) * F.col("baseline_avg")
    return out.withColumn("is_anomaly", F.coalesce(away, F.lit(False)))
