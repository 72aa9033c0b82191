"""Registered queries: every model and operator run over the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame that reads the
whole input tables.  Fixed parameters (cut-off times, as-of times, thresholds)
are stated once, below.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kairos.functions.scalars import recency_status, surrogate_key, ts_literal, version_sk
from kairos.operators import aggregates as agg
from kairos.operators import keys, pit, quality, scd
from kairos.operators.metrics import Metric, evaluate
from kairos.operators.sequence import latest_per_key
from kairos.plans.models import MODEL_NAMES, Models
from kairos.sources import raw as rawsrc
from kairos.session import scratch_path
from kairos.sources import sinks
from kairos.streaming.micro_batch import STREAM_QUERIES

# Fixed query parameters
EVENT_LOAD_CUTOFFS = ["2024-01-11 00:00:00", "2024-01-21 00:00:00"]  # 3 loads of the events log
EVENTS_MIDPOINT = "2024-01-15 00:00:00"
EVENTS_AS_OF = "2024-01-31 06:00:00"
EVENTS_TODAY = "2024-02-01 00:00:00"
ORDERS_AS_OF = "2001-12-31 00:00:00"
ORDERS_CUTOFF = "1999-01-01 00:00:00"
ORDERS_OVERLAP_FROM = "1998-01-01 00:00:00"
LOOKBACK_AS_OF = "2001-08-01 00:00:00"


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return rawsrc.read_raw(spark, d, name)


#: layers that several steps of a query read
SHARED_LAYERS = {"fct_orders": ("stg_orders",), "order_features": ("stg_orders",)}
#: layers that a query's steps are made of, but whose columns don't reach its result: an order's links to its customer
UNREAD_LAYERS = {n: ("customers_snapshot", "dim_customer_sk_map", "stg_customers") for n in ("stg_payments", "stg_order_items", "int_order_payments")}


def _models(spark, d, shared=(), unread=()) -> Models:
    """Models whose shared layers are checkpointed (computed once, lineage cut)."""
    return Models(spark, d, layer_mode="checkpoint", shared=shared, unread=unread)


def _model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, d):
        return getattr(_models(spark, d, SHARED_LAYERS.get(name, ()), UNREAD_LAYERS.get(name, ())), name)
    run.__name__ = name
    return run


# --- events as an entity history (user status) ----------------------------

def _status_changes(spark, d):
    return _t(spark, d, "events").where(F.col("event_type") != "purchase")


def _purchases(spark, d):
    return _t(spark, d, "events").where(F.col("event_type") == "purchase")


def user_history(spark, d) -> DataFrame:
    """S5 history of user status with version keys (sk, master_sk)."""
    h = scd.scd2_from_changes(_status_changes(spark, d), "user_id", "ts", ["event_type"])
    h = h.withColumn("sk", version_sk("user_id", "valid_from"))
    return keys.master_sk_window(h, key="user_id", ts="valid_from", sk="sk")


def q_s1_scd2_snapshot(spark, d):
    """S1 applied load by load: the events log read as a full-replace user table."""
    ev = _status_changes(spark, d).select("user_id", "event_type", "value", F.col("ts").alias("updated_at"))
    hist = None
    for cut in EVENT_LOAD_CUTOFFS + [None]:
        seen = ev if cut is None else ev.where(F.col("updated_at") < ts_literal(cut))
        load = latest_per_key(seen, ["user_id"], ["updated_at"])
        hist = scd.scd2_snapshot(hist, load, "user_id", "updated_at")
    return hist


def q_s1_snapshot_ties(spark, d):
    """Customer 'last order' history from orders: same-day orders of a customer tie on
    updated_at and are ordered by the remaining columns, so the pick is deterministic."""
    from kairos.functions.scalars import money
    from kairos.plans.models import snapshot_from_changes

    o = _t(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("last_order_id"),
                                      money("o_totalprice").alias("last_amount"),
                                      F.col("o_orderpriority").alias("priority"),
                                      F.col("o_orderdate").alias("updated_at"))
    return snapshot_from_changes(o)


def q_s5_scd2_from_changes(spark, d):
    return scd.scd2_from_changes(_status_changes(spark, d), "user_id", "ts", ["event_type"])


def q_s6_scd6(spark, d):
    h = scd.scd2_from_changes(_status_changes(spark, d), "user_id", "ts", ["event_type"])
    return scd.scd6(h, "user_id", ["event_type"]).select("user_id", "valid_from", "valid_to", "event_type",
                                                         "current_event_type")


def q_c5_fk_enrich_events(spark, d):
    h = user_history(spark, d)
    m = keys.first_version(h.withColumn("canonical_id", F.col("user_id")), "canonical_id", "valid_from", "sk")
    return pit.fk_enrich(_purchases(spark, d), "user_id", "ts", h, "user_id", "user", sk_map=m, slice_unit="week")


def q_c5_fk_enrich_join(spark, d):
    h = user_history(spark, d)
    m = keys.first_version(h.withColumn("canonical_id", F.col("user_id")), "canonical_id", "valid_from", "sk")
    return pit.fk_enrich(_purchases(spark, d), "user_id", "ts", h, "user_id", "user", sk_map=m, strategy="join")


def q_c2_pit_join_range(spark, d):
    h = user_history(spark, d)
    return pit.pit_join(_purchases(spark, d).select("event_id", "user_id", "ts", "value"), h, "user_id", "ts",
                        "user_id", take=("sk", "event_type"), prefix="status_", strategy="join")


def q_c2_pit_join(spark, d):
    h = user_history(spark, d)
    return pit.pit_join(_purchases(spark, d).select("event_id", "user_id", "ts", "value"), h, "user_id", "ts",
                        "user_id", take=("sk", "event_type"), prefix="status_")


def daily_user_features(spark, d) -> DataFrame:
    """Feature history per user: events and errors up to a day, valid from the next day on."""
    daily = (_t(spark, d, "events").groupBy("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"))
             .agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("e")))
    w = Window.partitionBy("user_id").orderBy("day")  # one row per user and day
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.col("day") + F.expr("INTERVAL 1 DAY")
    return daily.select("user_id", F.sum("n").over(upto).alias("events_to_date"), F.sum("e").over(upto).alias("errors_to_date"),
                        start.alias("valid_from"), F.lead(start).over(w).alias("valid_to"))


def q_c12_pit_features(spark, d):
    return pit.pit_features(_purchases(spark, d).select("event_id", "user_id", "ts"), daily_user_features(spark, d), "user_id", "ts",
                            "user_id", take=("events_to_date", "errors_to_date"))


def q_c11_scd_between_join(spark, d):
    h = user_history(spark, d)
    return pit.scd_between_join(_purchases(spark, d).select("event_id", "user_id", "ts"), h, "user_id", "ts",
                                "user_id", take=("sk",), today=EVENTS_TODAY)


def q_c11_between_join_range(spark, d):
    h = user_history(spark, d)
    return pit.scd_between_join(_purchases(spark, d).select("event_id", "user_id", "ts"), h, "user_id", "ts",
                                "user_id", take=("sk",), today=EVENTS_TODAY, strategy="join")


def q_c7_canonicalise(spark, d):
    c = _t(spark, d, "customer").select("c_custkey")
    return keys.canonicalise(c, "c_custkey", rawsrc.read_id_mapping(spark))


def q_s4_sk_map_incremental(spark, d):
    m = _models(spark, d)
    snap = m.orders_snapshot
    first_run = keys.sk_map(snap.where(F.col("scd_valid_from") < ts_literal(ORDERS_CUTOFF)), "id")
    return keys.sk_map(snap, "id", previous=first_run)


def q_c9_new_entities(spark, d):
    m = _models(spark, d)
    snap = m.orders_snapshot
    first_run = keys.sk_map(snap.where(F.col("scd_valid_from") < ts_literal(ORDERS_CUTOFF)), "id")
    base = scd.normalise_history(snap, "id").select("sk", "valid_from", F.col("source_id").alias("canonical_id"))
    return keys.new_entities(keys.first_version(base), first_run)


def q_s5_spliced_history(spark, d):
    """Status changes in four batches out of order, one of them twice, compacted between: the history of one pass."""
    from kairos.sources.spliced import SplicedHistory

    ch = _status_changes(spark, d)
    store = SplicedHistory(spark, scratch_path(spark, "s5-spliced"), "user_id", "ts", ["event_type"])
    for part in (3, 1, 3, 0, 2):
        store.apply(ch.where(F.col("event_id") % 4 == part))
        if part == 0:
            store.compact()
    return store.history()


def q_a9_additive_schema(spark, d):
    """Orders' versions over two loads: the second brings a new column and a wider id."""
    from kairos.operators.quality import conformed, evolved
    from kairos.sources.versions import VersionStore

    ch = rawsrc.order_changes(spark, d).join(
        _t(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority")), "id")
    first = ch.where(F.col("updated_at") < ts_literal(ORDERS_CUTOFF)).select(F.col("id").cast("int").alias("id"), "status", "updated_at")
    path = scratch_path(spark, "a9")
    rows = scd.scd2_changes(None, first, "id")
    VersionStore(spark, path, "id", rows.drop("_kind").schema).write(0, rows)
    second = ch.select("id", "status", "updated_at", "priority")
    shape = evolved(first.schema, second.schema)
    probe = scd.scd2_changes(None, conformed(second.limit(0), shape), "id").drop("_kind").schema
    store = VersionStore(spark, path, "id", probe)
    store.write(1, scd.scd2_changes(store.open_rows(0), conformed(second, shape), "id"))
    return store.table(1).select("id", "status", "priority", F.col("scd_valid_from").alias("valid_from"), F.col("scd_valid_to").alias("valid_to"))


def q_a7_upsert(spark, d):
    o = rawsrc.raw_orders_current(spark, d)
    target = o.where(F.col("placed_at") < ts_literal(ORDERS_CUTOFF))
    batch = (o.where(F.col("placed_at") >= ts_literal(ORDERS_OVERLAP_FROM))
             .withColumn("status", F.concat(F.col("status"), F.lit("*"))))
    return sinks.upsert(target, batch, ["id"])


def q_e2_dedup_latest(spark, d):
    return scd.dedup_latest(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def q_a16_apply_changes(spark, d):
    ch = (_t(spark, d, "events").select("user_id", "ts", "event_type", "value",
                                        F.when(F.col("event_type") == "error", "D").otherwise("U").alias("op")))
    mid = ts_literal(EVENTS_MIDPOINT)
    first = scd.apply_changes(None, ch.where(F.col("ts") < mid), ["user_id"], "ts")
    return scd.apply_changes(first, ch.where(F.col("ts") >= mid), ["user_id"], "ts")


TOMBSTONE_HORIZON = "2024-01-20 00:00:00"


def _change_table(spark, d, name):
    """Event changes dealt into three batches that overlap in time, stored in an odd order, one twice."""
    from kairos.sources.changes import ChangeTable

    ch = (_t(spark, d, "events").select("user_id", "ts", "event_type", "value",
                                        F.when(F.col("event_type") == "error", "D").otherwise("U").alias("op"), "event_id"))
    table = ChangeTable(spark, scratch_path(spark, name), ["user_id"], "ts")
    for batch in (2, 0, 2, 1):
        table.apply(ch.where(F.col("event_id") % 3 == batch).drop("event_id"), f"batch-{batch}")
        if batch == 0:
            table.compact()
    return table


def q_a16_merge_changes(spark, d):
    return _change_table(spark, d, "a16").live()


def q_a16_tombstones(spark, d):
    """Deletes that the state still remembers once those before the horizon are forgotten."""
    table = _change_table(spark, d, "a16t")
    table.compact(TOMBSTONE_HORIZON)
    return table.state().where("_deleted").select("user_id", "ts")


def q_a7_upsert_repeats(spark, d):
    """A batch with several rows per key, of which the latest counts."""
    ch = rawsrc.order_changes(spark, d)
    target = latest_per_key(ch.where(F.col("updated_at") < ts_literal(ORDERS_CUTOFF)), ["id"], ["updated_at"])
    return sinks.upsert(target, ch.where(F.col("updated_at") >= ts_literal(ORDERS_CUTOFF)), ["id"], order=["updated_at"])


def q_a3_append_after(spark, d):
    p = rawsrc.raw_payments(spark, d)
    target = p.where(F.col("created_at") < ts_literal(ORDERS_OVERLAP_FROM))
    return sinks.append_after(target, p, "created_at")


def q_e2_log_staging(spark, d):
    """Incremental log staging: one payment per id, overlapping loads add only new ids."""
    p = rawsrc.raw_payments(spark, d)
    early = scd.dedup_latest(p.where(F.col("created_at") < ts_literal(ORDERS_CUTOFF)), ["id"], ["created_at"]).select(*p.columns)
    late = scd.dedup_latest(p.where(F.col("created_at") >= ts_literal(ORDERS_OVERLAP_FROM)), ["id"], ["created_at"]).select(*p.columns)
    return early.unionByName(late.join(early.select("id"), "id", "left_anti").select(*p.columns))


def q_b9_lookback(spark, d):
    return scd.lookback_filter(rawsrc.raw_orders_current(spark, d), True, "updated_at", LOOKBACK_AS_OF, 7)


def q_b8_newer_than(spark, d):
    o = rawsrc.raw_orders_current(spark, d)
    return scd.newer_than(o, o.where(F.col("placed_at") < ts_literal(ORDERS_CUTOFF)), "updated_at")


def q_b11_lookback_from_max(spark, d):
    o = rawsrc.raw_orders_current(spark, d)
    return scd.lookback_from_max(o, o.where(F.col("placed_at") < ts_literal(ORDERS_CUTOFF)), "updated_at", 3)


def q_e5_history_safe_totals(spark, d):
    o = rawsrc.raw_orders_current(spark, d).select("id", "customer_id", "placed_at", "amount")
    return agg.history_safe_totals(o, "customer_id", "placed_at", "amount")


def q_e6_order_gaps(spark, d):
    return agg.order_gaps(rawsrc.raw_orders_current(spark, d), "customer_id", "placed_at", "id")


def q_e7_daily_baseline(spark, d):
    b = agg.daily_baseline(_t(spark, d, "events"), "ts")
    return (b.withColumn("baseline_avg", F.round("baseline_avg", 6))
            .withColumn("baseline_std", F.round("baseline_std", 6)))


def q_q8_check_volume(spark, d):
    b = quality.check_volume(_t(spark, d, "events"), "ts", 7, 0.05)
    return b.select("day", "n_rows", "is_anomaly")


def q_d7_rfm(spark, d):
    return agg.rfm(rawsrc.raw_orders_current(spark, d), "customer_id", "id", "placed_at", "amount",
                   ORDERS_AS_OF, status="status")


def q_d8_daily_totals(spark, d):
    return agg.daily_totals(rawsrc.raw_payments(spark, d), "created_at", {"amount": "amount"})


def q_d9_metric_revenue(spark, d):
    m = Metric("revenue", "sum", "amount", "created_at", filters=["status = 'success'"], cast="decimal(18,2)")
    return evaluate(m, rawsrc.raw_payments(spark, d), ["method"], "month")


def q_d9_metric_median(spark, d):
    m = Metric("median_amount", "median", "CAST(amount AS DOUBLE)", "placed_at", cast="decimal(18,3)")
    return evaluate(m, rawsrc.raw_orders_current(spark, d), ["status"], "year")


def q_d10_semi_additive(spark, d):
    m = Metric("open_amount", "sum", "amount", "updated_at", additive=False, entity="id",
               cast="decimal(18,2)")
    return evaluate(m, rawsrc.order_changes(spark, d), ["status"], "year")


def q_d10_carried_balance(spark, d):
    """Amount of all orders by status at the end of every month; an order counts in months without a change too."""
    m = Metric("open_amount", "sum", "amount", "updated_at", additive=False, entity="id", cast="decimal(18,2)", carry=True)
    return evaluate(m, rawsrc.order_changes(spark, d), ["status"], "month")


def q_d10_carried_count(spark, d):
    """Active user states at the end of each week: a state ends where the next one starts, an error ends the user."""
    from kairos.operators.metrics import carried_balance

    h = scd.scd2_from_changes(_status_changes(spark, d), "user_id", "ts", ["event_type"])
    return carried_balance(h.where("event_type != 'error'"), "user_id", "valid_from", "1", ["event_type"], "week", "n_states", until="valid_to")


def _order_metrics(spark, d):
    """Day-level state of the orders, loaded in two parts of which the second replaces its days."""
    from kairos.operators.partials import Measure, MetricTable

    measures = [Measure("orders", "count", "id"), Measure("revenue", "sum", "amount", cast="decimal(18,2)"),
                Measure("smallest", "min", "amount"), Measure("largest", "max", "amount"), Measure("customers", "distinct", "customer_id"),
                Measure("avg_order", "ratio", "revenue", over="orders")]
    table = MetricTable(spark, scratch_path(spark, "d9-days"), measures, "placed_at", ["status"])
    o = rawsrc.raw_orders_current(spark, d)
    table.load(o.where(F.col("placed_at") < ts_literal(ORDERS_CUTOFF)))
    table.load(o.where(F.col("placed_at") >= ts_literal(ORDERS_OVERLAP_FROM)))
    return table


def q_d9_rollup_quarter(spark, d):
    return _order_metrics(spark, d).read("quarter")


def q_d9_rollup_month(spark, d):
    """Months over all states: distinct customers merge across days and states."""
    return _order_metrics(spark, d).read("month", [])


def _daily_event_profile(spark, d):
    from kairos.operators.profiles import null_rates, value_shares

    ev = (_t(spark, d, "events").select(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "event_type",
                                        F.when(F.col("event_type") == "purchase", F.col("value")).alias("purchase_value"),
                                        F.when(F.col("value") > 50, F.col("user_id")).alias("large_user")))
    return null_rates(ev, ["purchase_value", "large_user"], ["day"]), value_shares(ev, ["event_type"], ["day"])


def q_q10_null_history(spark, d):
    """Null rates of every day against the median and spread of the seven days before."""
    from kairos.operators.profiles import judge

    nulls, _ = _daily_event_profile(spark, d)
    out = judge(nulls, "day", ["column_name"], past=7, min_runs=5, k=2.0, floor=0.002)
    return out.select("day", "column_name", "n_rows", *[F.round(c, 9).alias(c) for c in ("rate", "median", "spread")], "status")


def q_q11_share_history(spark, d):
    """Shares of event types of every day against the seven days before."""
    from kairos.operators.profiles import judge, with_missing

    _, shares = _daily_event_profile(spark, d)
    out = judge(with_missing(shares, "day"), "day", ["column_name", "value"], past=7, min_runs=5, k=2.0, floor=0.002)
    return out.select("day", "value", *[F.round(c, 9).alias(c) for c in ("rate", "median", "spread")], "status")


def q_d11_periodic_snapshot(spark, d):
    h = scd.scd2_from_changes(_status_changes(spark, d), "user_id", "ts", ["event_type"])
    return agg.periodic_snapshot(h, "user_id", "2024-01-01 00:00:00", "2024-01-30 00:00:00", ["event_type"])


def q_d11_weekly_snapshot(spark, d):
    h = scd.scd2_from_changes(_status_changes(spark, d), "user_id", "ts", ["event_type"])
    return agg.periodic_snapshot(h, "user_id", "2024-01-03 12:00:00", "2024-01-30 00:00:00", ["event_type"], step="7 days")


def q_d12_accumulating_snapshot(spark, d):
    return agg.accumulating_snapshot(rawsrc.order_changes(spark, d), "id", "status", "updated_at",
                                     [s for s, _ in rawsrc.ORDER_STAGES])


def q_d13_state_at(spark, d):
    return agg.state_at(_models(spark, d).stg_customers, EVENTS_MIDPOINT, ["status"])


def q_c10_star_query(spark, d):
    li = _t(spark, d, "lineitem")
    o = _t(spark, d, "orders")
    c = _t(spark, d, "customer")
    n = _t(spark, d, "nation")
    r = _t(spark, d, "region")
    rev = F.col("l_extendedprice").cast("decimal(18,2)") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    j = (li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey))
    return j.groupBy("r_name", F.year("o_orderdate").alias("order_year")).agg(
        F.sum(rev).cast("decimal(18,4)").alias("revenue"), F.count_distinct("o_orderkey").alias("n_orders"))


def q_c14_snowflake(spark, d):
    s = _t(spark, d, "supplier")
    n = _t(spark, d, "nation")
    r = _t(spark, d, "region")
    j = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.groupBy("r_name").agg(F.count(F.lit(1)).alias("n_suppliers"),
                                   F.sum(F.col("s_acctbal").cast("decimal(18,2)")).cast("decimal(18,2)")
                                   .alias("total_acctbal"))


def q_q1_check_unique(spark, d):
    return quality.check_unique(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_q2_check_not_null(spark, d):
    return quality.check_not_null(_models(spark, d).customer_features, "avg_days_between_orders").select(
        "customer_id", "total_orders")


def q_q3_check_accepted(spark, d):
    return quality.check_accepted(rawsrc.raw_orders_current(spark, d), "status",
                                  ["placed", "shipped", "completed"]).select("id", "status")


def q_q4_check_freshness(spark, d):
    return quality.check_freshness(_t(spark, d, "events"), "ts", EVENTS_AS_OF, 12, 24)


def q_q5_check_reconcile(spark, d):
    return quality.check_reconcile(rawsrc.raw_order_items(spark, d), rawsrc.raw_orders_current(spark, d))


def q_q6_check_relationship(spark, d):
    return quality.check_relationship(_t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"),
                                      "l_suppkey", _t(spark, d, "supplier"), "s_suppkey")


def q_q7_check_rule(spark, d):
    f = _models(spark, d, SHARED_LAYERS["fct_orders"]).fct_orders
    rule = ((F.col("paid_amount") > F.col("order_amount") * F.lit(1.01).cast("decimal(4,2)"))
            | (F.col("order_amount") < 0)
            | ((F.col("order_status") == "completed") & (F.col("payment_attempts") == 0)))
    return quality.check_rule(f, rule).select("order_id", "order_status", "order_amount", "paid_amount")


def q_q7_first_order_in_future(spark, d):
    """Customers whose first order lies after the time of the check."""
    rule = F.col("first_order_at") > ts_literal(ORDERS_CUTOFF)
    return quality.check_rule(_models(spark, d).dim_customers, rule).select("customer_id", "first_order_at")


def q_q7_payments_sum_to_total(spark, d):
    """Paid orders whose successful payments don't sum to the order's amount."""
    rule = F.col("is_paid") & (F.abs(F.col("paid_amount") - F.col("order_amount")) > F.lit(0.01).cast("decimal(4,2)"))
    return quality.check_rule(_models(spark, d, SHARED_LAYERS["fct_orders"]).fct_orders, rule).select("order_id", "order_amount", "paid_amount")


def q_q10_null_profile(spark, d):
    return quality.null_profile(_models(spark, d).dim_customers,
                                ["first_order_at", "last_order_at", "country", "email"])


def q_q11_category_profile(spark, d):
    ev = _t(spark, d, "events")
    mid = ts_literal(EVENTS_MIDPOINT)
    return quality.category_profile(ev.where(F.col("ts") >= mid), ev.where(F.col("ts") < mid), "event_type", 0.01)


def q_q12_check_range(spark, d):
    return quality.check_range(_t(spark, d, "lineitem"), "l_quantity", 1, 45).select(
        "l_orderkey", "l_linenumber", "l_quantity")


def q_q13_check_contract(spark, d):
    c = quality.Contract(
        fields={"id": "string", "order_id": "bigint", "method": "string", "status": "string",
                "amount": "decimal(18,2)", "created_at": "timestamp_ntz", "currency": "string"},
        required=["id", "order_id", "amount"], unique=["id"],
        accepted={"status": ["success", "failed"], "method": ["credit_card", "debit_card", "bank_transfer",
                                                              "gift_card"]},
        freshness_col="created_at", freshness_hours=24)
    return quality.check_contract(rawsrc.raw_payments(spark, d), c, ORDERS_AS_OF)


def q_contract_suite(spark, d):
    """Every declared check of the sources and models; the failing clauses."""
    from kairos.plans import contracts

    # no check and no reader here needs the links of staged payments and items: as plans they are scans, as layers two exchanges each
    m = _models(spark, d, ("stg_orders", "stg_products", "dim_customers", "fct_orders"))
    latest = lambda df: latest_per_key(df, ["id"], ["updated_at"])  # noqa: E731  the sources hold one row per id
    tables = {"customers": latest(rawsrc.customer_changes(spark, d)), "products": latest(rawsrc.product_changes(spark, d)),
              "orders": rawsrc.raw_orders_current(spark, d), "payments": rawsrc.raw_payments(spark, d),
              "order_items": rawsrc.raw_order_items(spark, d)}
    return contracts.suite(tables | {n: getattr(m, n) for n in contracts.MODELS}, ORDERS_AS_OF)


def _checked_lines(spark, d):
    from kairos.operators.quality import Contract
    from kairos.sources.checked import checked_write

    contract = Contract({}, required=["l_orderkey", "l_returnflag"], accepted={"l_returnflag": ["A", "N"]}, ranges={"l_quantity": (1, 48)},
                        unique=["l_partkey"])
    return checked_write(_t(spark, d, "lineitem"), scratch_path(spark, "q14"), contract, on_error="quarantine",
                         severity={"unique:l_partkey": "warn"})


def q_q14_quarantine(spark, d):
    """Lines kept out of a layer while it is written, with the clauses they break."""
    out = _checked_lines(spark, d).quarantine(spark)
    return out.select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", F.array_join("failed_clauses", ", ").alias("clauses"))


def q_q14_checked_layer(spark, d):
    """The layer itself and how many rows broke each clause, from the pass that wrote it."""
    layer = _checked_lines(spark, d)
    rows = layer.layer(spark).groupBy(F.lit("kept").alias("clause")).agg(F.count("*").alias("n_rows"))
    return rows.unionByName(spark.createDataFrame(sorted(layer.failed.items()), "clause string, n_rows long"))


def q_a15_compare_frames(spark, d):
    ch = rawsrc.order_changes(spark, d)
    before = latest_per_key(ch.where(F.col("updated_at") < ts_literal(ORDERS_CUTOFF)), ["id"], ["updated_at"])
    after = latest_per_key(ch, ["id"], ["updated_at"])
    return sinks.compare_frames(before.select("id", "status", "amount"), after.select("id", "status", "amount"),
                                ["id"])


def q_a15_compare_summary(spark, d):
    ch = rawsrc.order_changes(spark, d)
    before = latest_per_key(ch.where(F.col("updated_at") < ts_literal(ORDERS_CUTOFF)), ["id"], ["updated_at"])
    after = latest_per_key(ch, ["id"], ["updated_at"])
    return sinks.compare_summary(before.select("id", "status", "amount"), after.select("id", "status", "amount"),
                                 ["id"])


def q_g8_surrogate_key(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    return li.select("l_orderkey", "l_linenumber", surrogate_key("l_orderkey", "l_linenumber").alias("line_key"))


def q_g12_recency_status(spark, d):
    o = rawsrc.raw_orders_current(spark, d)
    last = o.groupBy("customer_id").agg(F.max("placed_at").alias("last_order_at"))
    return last.withColumn("recency_status", recency_status("last_order_at", ts_literal(ORDERS_AS_OF)))


def q_a21_mask_columns(spark, d):
    return sinks.mask_columns(_t(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"), ["c_name"])


def q_g7_payment_ids(spark, d):
    return rawsrc.raw_payments(spark, d).select("id", "order_id", "method", "status", "amount")


# --- write paths: each writes under the shared checkpoint folder and reads back

ROLLING_AS_OF = "2001-08-01 00:00:00"


def q_a2_load_replace(spark, d):
    path = scratch_path(spark, "a2-orders")
    src = rawsrc.raw_orders_current(spark, d)
    sinks.load_replace(src, path)
    sinks.load_replace(src, path)  # second run replaces, never duplicates
    return spark.read.parquet(path)


def q_a6_write_table(spark, d):
    path = scratch_path(spark, "a6-daily")
    sinks.write_table(agg.daily_totals(rawsrc.raw_payments(spark, d), "created_at", {"amount": "amount"}), path)
    return spark.read.parquet(path)


def q_a11_write_partitioned(spark, d):
    path = scratch_path(spark, "a11-payments")
    sinks.write_partitioned(rawsrc.raw_payments(spark, d), path, ["method"])
    # partition pruning: only the gift_card directory is listed and read
    return spark.read.parquet(path).where(F.col("method") == "gift_card")


def q_a12_write_clustered(spark, d):
    path = scratch_path(spark, "a12-orders")
    sinks.write_clustered(rawsrc.raw_orders_current(spark, d), path, ["status"], ["placed_at"])
    return spark.read.parquet(path)


def q_a13_compact(spark, d):
    small = scratch_path(spark, "a13-small")
    rawsrc.raw_payments(spark, d).repartition(64).write.parquet(small)
    return spark.read.parquet(sinks.compact(spark, small, scratch_path(spark, "a13-compacted"), 128))


def q_a14_backfill(spark, d):
    ev = _t(spark, d, "events")
    path = scratch_path(spark, "a14-weekly")
    weekly = (ev.groupBy(F.date_trunc("week", "ts").cast("timestamp_ntz").cast("string").alias("week_start"), "event_type")
              .agg(F.count(F.lit(1)).alias("n_rows")))
    sinks.backfill(weekly, path, "week_start")
    last = ev.agg(F.date_trunc("week", F.max("ts")).cast("timestamp_ntz").cast("string")).first()[0]
    sinks.backfill(weekly, path, "week_start", parts=[last])  # re-run one: idempotent
    out = spark.read.parquet(path)
    return out.withColumn("week_start", F.col("week_start").cast("timestamp_ntz"))


def q_a13_compact_small(spark, d):
    """Payments by month of loading, in files of which the small ones are packed in place: rows and layout stay."""
    from kairos.sources.compaction import compact_small

    path = scratch_path(spark, "a13-months")
    pay = rawsrc.raw_payments(spark, d).withColumn("month", F.date_format("created_at", "yyyy-MM"))
    pay.repartition(6).write.partitionBy("month").parquet(path)
    compact_small(spark, path, target_mb=1)
    per = spark.read.parquet(path).groupBy("month").agg(F.count("*").alias("n_rows"), F.sum("amount").cast("decimal(18,2)").alias("amount"),
                                                        F.count_distinct("_metadata.file_path").alias("_files"))
    return per.select("month", "n_rows", "amount", F.col("_files").alias("n_files"))


def _monthly_payments(rows):
    return (rows.groupBy(F.date_format("created_at", "yyyy-MM").alias("month"), "method")
            .agg(F.count("*").alias("n_rows"), F.sum("amount").cast("decimal(18,2)").alias("amount")))


def _published_payments(spark, d):
    """Monthly totals with duplicate payments counted, live; the totals of one row per id staged as a backfill."""
    from kairos.sources.published import PublishedTable, Rules

    pay = rawsrc.raw_payments(spark, d)
    table = PublishedTable(spark, scratch_path(spark, "a15"), "month", ["method"])
    table.backfill(_monthly_payments(pay), "first")
    fixed = _monthly_payments(scd.dedup_latest(pay, ["id"], ["created_at"]))
    return table, fixed, Rules(sums={"amount": 0.02, "n_rows": 0.02}, must_hold="amount >= 0")


def q_a15_partition_report(spark, d):
    table, fixed, rules = _published_payments(spark, d)
    return table.report("one-per-id", table.stage(fixed, "one-per-id"), rules)


def q_a15_promote(spark, d):
    """What readers see after a good backfill, a repeat of it and one that loses a method's rows and is refused."""
    from kairos.sources.published import PromotionRefused, Rules

    table, fixed, _ = _published_payments(spark, d)
    wide = Rules(sums={"amount": 0.5, "n_rows": 0.5})
    table.backfill(fixed, "one-per-id", wide)
    table.backfill(fixed, "one-per-id", wide)
    try:
        table.backfill(fixed.where("method != 'gift_card'"), "lossy", wide)
    except PromotionRefused:
        return table.read()
    raise AssertionError("a backfill without gift cards was promoted")


def q_a18_write_as(spark, d):
    src = rawsrc.raw_orders_current(spark, d)
    out = None
    for fmt, codec in (("csv", "gzip"), ("json", "gzip"), ("parquet", "zstd"), ("orc", "zstd")):
        path = sinks.write_as(src, scratch_path(spark, f"a18-{fmt}"), fmt, codec)
        back = sinks.read_as(spark, path, src.schema, fmt).withColumn("fmt", F.lit(fmt))
        out = back if out is None else out.unionByName(back)
    return out


def q_a19_scd1(spark, d):
    ch = rawsrc.order_changes(spark, d)
    target = latest_per_key(ch.where(F.col("updated_at") < ts_literal(ORDERS_CUTOFF)), ["id"], ["updated_at"])
    batch = ch.where(F.col("updated_at") >= ts_literal(ORDERS_CUTOFF))
    return scd.scd1(target, batch, ["id"], ["updated_at"])


def q_b17_rolling_filter(spark, d):
    o = rawsrc.raw_orders_current(spark, d)
    return o.where(F.col("placed_at") >= F.date_sub(F.to_date(ts_literal(ROLLING_AS_OF)), 90).cast("timestamp_ntz"))


def q_d9_dashboard(spark, d):
    from kairos.operators.metrics import evaluate_many

    ms = [Metric("order_volume", "count", "id", "placed_at"),
          Metric("revenue", "sum", "amount", "placed_at", cast="decimal(18,2)"),
          Metric("customers", "count_distinct", "customer_id", "placed_at")]
    return evaluate_many(ms, rawsrc.raw_orders_current(spark, d), ["status"], "quarter")


INC_CUTOFFS = ["1997-01-01 00:00:00", "2024-01-15 00:00:00", "2100-01-01 00:00:00"]


def q_inc_daily_run(spark, d):
    """Three incremental loads (snapshot -> key maps -> staging, new generation each), the
    state reopened from storage before each, orders through the lookback filter; the
    staging orders must equal a full refresh over the same loads."""
    from kairos.plans import incremental as inc

    changes = {"customers": rawsrc.customer_changes(spark, d), "products": rawsrc.product_changes(spark, d),
               "orders": rawsrc.order_changes(spark, d)}
    base = scratch_path(spark, "inc-run")
    for cut in INC_CUTOFFS:
        # each load holds every row changed before its cut-off; the run reduces it to one row per id
        load = inc.Load(**{k: v.where(F.col("updated_at") < ts_literal(cut)) for k, v in changes.items()})
        inc.run_load(spark, inc.load_state(spark, base), load, cut, base, mapping=rawsrc.read_id_mapping(spark))
    return inc.load_state(spark, base)["stg_orders"]


LATE_LOG_CUTOFFS = ["1999-01-01 00:00:00", "2024-01-15 00:00:00", "2100-01-01 00:00:00"]


def _late_parents_run(spark, d):
    """Three loads whose logs run ahead of the orders: the first brings logs of two years whose orders, or
    order versions, come with the second; the third brings no logs at all."""
    from kairos.plans import incremental as inc

    changes = {"customers": rawsrc.customer_changes(spark, d), "products": rawsrc.product_changes(spark, d),
               "orders": rawsrc.order_changes(spark, d)}
    logs = {"payments": rawsrc.raw_payments(spark, d), "items": rawsrc.raw_order_items(spark, d)}
    base = scratch_path(spark, "inc-late")
    for i, (cut, log_cut) in enumerate(zip(INC_CUTOFFS, LATE_LOG_CUTOFFS)):
        load = inc.Load(**{k: v.where(F.col("updated_at") < ts_literal(cut)) for k, v in changes.items()},
                        **({k: v.where(F.col("created_at") < ts_literal(log_cut)) for k, v in logs.items()} if i < 2 else {}))
        inc.run_load(spark, inc.load_state(spark, base), load, cut, base, mapping=rawsrc.read_id_mapping(spark))
    return inc.load_state(spark, base)


def q_inc_late_payments(spark, d):
    return _late_parents_run(spark, d)["stg_payments"]


def q_inc_late_items(spark, d):
    return _late_parents_run(spark, d)["stg_order_items"]


def q_inc_late_fct_orders(spark, d):
    """The orders mart over payments that came before their orders: none stays unpaid for it."""
    from kairos.operators.aggregates import order_payments
    from kairos.plans import models as M

    state = _late_parents_run(spark, d)
    return M.fct_orders(state["stg_orders"], order_payments(state["stg_payments"], packed=True))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{n: _model(n) for n in MODEL_NAMES},
    "s1_scd2_snapshot": q_s1_scd2_snapshot,
    "s1_snapshot_ties": q_s1_snapshot_ties,
    "s5_scd2_from_changes": q_s5_scd2_from_changes,
    "s5_spliced_history": q_s5_spliced_history,
    "s6_scd6": q_s6_scd6,
    "a9_additive_schema": q_a9_additive_schema,
    "c5_fk_enrich_asof": q_c5_fk_enrich_events,
    "c5_fk_enrich_join": q_c5_fk_enrich_join,
    "c2_pit_join": q_c2_pit_join,
    "c2_pit_join_range": q_c2_pit_join_range,
    "c12_pit_features": q_c12_pit_features,
    "c11_scd_between_join": q_c11_scd_between_join,
    "c11_between_join_range": q_c11_between_join_range,
    "c7_canonicalise": q_c7_canonicalise,
    "s4_sk_map_incremental": q_s4_sk_map_incremental,
    "c9_new_entities": q_c9_new_entities,
    "a7_upsert": q_a7_upsert,
    "e2_dedup_latest": q_e2_dedup_latest,
    "e2_log_staging": q_e2_log_staging,
    "a16_apply_changes": q_a16_apply_changes,
    "a16_merge_changes": q_a16_merge_changes,
    "a16_tombstones": q_a16_tombstones,
    "a7_upsert_repeats": q_a7_upsert_repeats,
    "a3_append_after": q_a3_append_after,
    "b8_newer_than": q_b8_newer_than,
    "b9_lookback_filter": q_b9_lookback,
    "b11_lookback_from_max": q_b11_lookback_from_max,
    "e5_history_safe_totals": q_e5_history_safe_totals,
    "e6_order_gaps": q_e6_order_gaps,
    "e7_daily_baseline": q_e7_daily_baseline,
    "q8_check_volume": q_q8_check_volume,
    "d7_rfm": q_d7_rfm,
    "d8_daily_totals": q_d8_daily_totals,
    "d9_metric_revenue": q_d9_metric_revenue,
    "d9_metric_median": q_d9_metric_median,
    "d10_semi_additive": q_d10_semi_additive,
    "d10_carried_balance": q_d10_carried_balance,
    "d10_carried_count": q_d10_carried_count,
    "d11_periodic_snapshot": q_d11_periodic_snapshot,
    "d11_weekly_snapshot": q_d11_weekly_snapshot,
    "d12_accumulating_snapshot": q_d12_accumulating_snapshot,
    "d13_state_at": q_d13_state_at,
    "c10_star_query": q_c10_star_query,
    "c14_snowflake": q_c14_snowflake,
    "q1_check_unique": q_q1_check_unique,
    "q2_check_not_null": q_q2_check_not_null,
    "q3_check_accepted": q_q3_check_accepted,
    "q4_check_freshness": q_q4_check_freshness,
    "q5_check_reconcile": q_q5_check_reconcile,
    "q6_check_relationship": q_q6_check_relationship,
    "q7_check_rule": q_q7_check_rule,
    "q7_first_order_in_future": q_q7_first_order_in_future,
    "q7_payments_sum_to_total": q_q7_payments_sum_to_total,
    "q10_null_profile": q_q10_null_profile,
    "q11_category_profile": q_q11_category_profile,
    "q12_check_range": q_q12_check_range,
    "q13_check_contract": q_q13_check_contract,
    "q_contract_suite": q_contract_suite,
    "q14_quarantine": q_q14_quarantine,
    "q14_checked_layer": q_q14_checked_layer,
    "a15_compare_frames": q_a15_compare_frames,
    "a15_compare_summary": q_a15_compare_summary,
    "g7_md5_uuid": q_g7_payment_ids,
    "g8_surrogate_key": q_g8_surrogate_key,
    "g12_recency_status": q_g12_recency_status,
    "a21_mask_columns": q_a21_mask_columns,
    "a2_load_replace": q_a2_load_replace,
    "a6_write_table": q_a6_write_table,
    "a11_write_partitioned": q_a11_write_partitioned,
    "a12_write_clustered": q_a12_write_clustered,
    "a13_compact": q_a13_compact,
    "a13_compact_small": q_a13_compact_small,
    "a14_backfill": q_a14_backfill,
    "a15_partition_report": q_a15_partition_report,
    "a15_promote": q_a15_promote,
    "a18_write_as": q_a18_write_as,
    "a19_scd1": q_a19_scd1,
    "b17_rolling_filter": q_b17_rolling_filter,
    "d9_dashboard": q_d9_dashboard,
    "d9_rollup_quarter": q_d9_rollup_quarter,
    "d9_rollup_month": q_d9_rollup_month,
    "q10_null_history": q_q10_null_history,
    "q11_share_history": q_q11_share_history,
    "inc_daily_run": q_inc_daily_run,
    "inc_late_payments": q_inc_late_payments,
    "inc_late_items": q_inc_late_items,
    "inc_late_fct_orders": q_inc_late_fct_orders,
    **STREAM_QUERIES,
}
