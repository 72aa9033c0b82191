"""Incremental runs equal the full refresh (traps T1/T2), on the driver tables."""

from pyspark.sql import functions as F

from kairos.operators.scd import scd2_from_loads
from kairos.operators.sequence import latest_per_key
from kairos.plans import incremental as I
from kairos.plans import models as M
from kairos.session import scratch_path
from kairos.sources import raw as R

SF = "/root/testdata/sf0.001"
CUTOFFS = ["1997-01-01 00:00:00", "2024-01-15 00:00:00", "2100-01-01 00:00:00"]


def _load_index(col="updated_at"):
    e = F.lit(len(CUTOFFS))
    for i, c in reversed(list(enumerate(CUTOFFS))):
        e = F.when(F.col(col) < F.lit(c).cast("timestamp_ntz"), F.lit(i)).otherwise(e)
    return e


def _rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_incremental_equals_full_refresh(spark):
    changes = {"customers": R.customer_changes(spark, SF), "products": R.product_changes(spark, SF),
               "orders": R.order_changes(spark, SF)}
    mapping = R.read_id_mapping(spark)
    base = scratch_path(spark, "inc")
    state = None
    for c in CUTOFFS:
        cut = F.lit(c).cast("timestamp_ntz")
        load = I.Load(**{k: latest_per_key(v.where(F.col("updated_at") < cut), ["id"], ["updated_at"])
                         for k, v in changes.items()})
        state = I.run_load(spark, state, load, c, base, mapping=mapping)
    assert state.gen == len(CUTOFFS) - 1

    snaps = {k: scd2_from_loads(v.withColumn("_load", _load_index()), "id", "updated_at", "_load")
             for k, v in changes.items()}
    full_c = M.stg_customers(snaps["customers"], mapping)
    full_p = M.stg_products(snaps["products"])
    full_o = M.stg_orders(snaps["orders"], full_c, M.sk_map(snaps["customers"], "id", mapping))
    assert _rows(state["customers_snapshot"]) == _rows(snaps["customers"])
    assert _rows(state["stg_customers"]) == _rows(full_c)
    assert _rows(state["stg_products"]) == _rows(full_p)
    assert _rows(state["stg_orders"]) == _rows(full_o)
    cur = state["stg_orders"].where("is_current").groupBy("order_id").count().where("count > 1")
    assert cur.count() == 0


def test_marts_from_incremental_state_equal_full_refresh(spark):
    """Marts rebuilt from the incremental state equal the marts of a full refresh over
    the same loads.  Customer features also equal the daily full pipeline, because every
    customer's first version (version 0) is captured the same way there; an order's
    master key is its first *captured* version, so it depends on load granularity."""
    changes = {"customers": R.customer_changes(spark, SF), "products": R.product_changes(spark, SF),
               "orders": R.order_changes(spark, SF)}
    mapping = R.read_id_mapping(spark)
    base = scratch_path(spark, "marts")
    state = None
    for c in CUTOFFS:
        cut = F.lit(c).cast("timestamp_ntz")
        load = I.Load(**{k: latest_per_key(v.where(F.col("updated_at") < cut), ["id"], ["updated_at"])
                         for k, v in changes.items()})
        state = I.run_load(spark, state, load, c, base, lookback_days=None, mapping=mapping)
    pay, items = R.raw_payments(spark, SF), R.raw_order_items(spark, SF)
    inc = I.marts(spark, state, pay, items, M.DEFAULT_AS_OF)

    snaps = {k: scd2_from_loads(v.withColumn("_load", _load_index()), "id", "updated_at", "_load")
             for k, v in changes.items()}
    cmap = M.sk_map(snaps["customers"], "id", mapping)
    full_c = M.stg_customers(snaps["customers"], mapping)
    tables = {"stg_customers": full_c, "stg_products": M.stg_products(snaps["products"]),
              "stg_orders": M.stg_orders(snaps["orders"], full_c, cmap),
              "dim_order_sk_map": M.sk_map(snaps["orders"], "id"),
              "dim_product_sk_map": M.sk_map(snaps["products"], "id")}
    full = I.marts(spark, I.State(base, -1, tables), pay, items, M.DEFAULT_AS_OF)
    for name in ("customer_features", "order_features", "fct_orders", "dim_customers"):
        assert _rows(inc[name]) == _rows(full[name]), name
    daily = M.Models(spark, SF, layer_mode="checkpoint")
    assert _rows(inc["customer_features"]) == _rows(daily.customer_features)


def _loads(spark, n_orders, changed):
    """A first load of n_orders orders and a second one in which ``changed`` of them move on."""
    ts = lambda d: F.lit(d).cast("timestamp_ntz")
    cust = spark.range(20).select("id", F.lit("n").alias("name"), F.lit("e").alias("email"), F.lit("c").alias("country"),
                                  F.lit("active").alias("status"), ts("2024-01-01").alias("created_at"), ts("2024-01-01").alias("updated_at"))
    prod = spark.range(5).select("id", F.lit("p").alias("name"), F.lit("k").alias("category"), F.lit(1).cast("decimal(18,2)").alias("price"),
                                 F.lit(True).alias("is_active"), ts("2024-01-01").alias("created_at"), ts("2024-01-01").alias("updated_at"))
    order = spark.range(n_orders).select("id", (F.col("id") % 20).alias("customer_id"), F.lit("placed").alias("status"),
                                         F.lit(2).cast("decimal(18,2)").alias("amount"), ts("2024-01-02").alias("placed_at"),
                                         ts("2024-01-02").alias("updated_at"))
    moved = order.withColumn("status", F.when(F.col("id") < changed, "shipped").otherwise(F.col("status"))).withColumn(
        "updated_at", F.when(F.col("id") < changed, ts("2024-01-03")).otherwise(F.col("updated_at")))
    pay = spark.range(40).select(F.col("id").cast("string").alias("id"), F.col("id").alias("order_id"), F.lit("card").alias("method"),
                                 F.lit("success").alias("status"), F.lit(2).cast("decimal(18,2)").alias("amount"),
                                 ts("2024-01-02").alias("created_at"))
    return (I.Load(cust, prod, order, payments=pay.where("id < 30").unionByName(pay.where("id < 3"))),
            I.Load(cust, prod, moved, payments=pay.where("id >= 20")))


def test_a_run_writes_what_changed_and_a_new_process_goes_on(spark):
    import pytest

    base = scratch_path(spark, "inc-delta")
    first, second = _loads(spark, 1000, 10)
    I.run_load(spark, None, first, "2024-01-02 06:00:00", base)
    with pytest.raises(ValueError, match="load_state"):
        I.run_load(spark, None, second, "2024-01-03 06:00:00", base)  # a fresh process must not start over
    state = I.run_load(spark, I.load_state(spark, base), second, "2024-01-03 06:00:00", base)
    for name in ("orders_snapshot", "stg_orders"):
        written = spark.read.parquet(f"{base}/{name}/gen=000001").count()
        assert written == 20  # ten closed, ten opened, of 1000
    again = I.load_state(spark, base)
    assert again.gen == state.gen == 1 and again.as_of == "2024-01-03 06:00:00"
    assert _rows(again["stg_orders"]) == _rows(state["stg_orders"])
    assert again["stg_orders"].count() == 1010 and again["stg_orders"].where("is_current").count() == 1000
    pay = again["stg_payments"]
    assert pay.count() == pay.select("payment_id").distinct().count() == 40  # repeats and overlaps give one row per id
    # a run that wrote but did not commit is overwritten by the next one
    spark.createDataFrame([(1,)], "junk int").write.parquet(f"{base}/orders_snapshot/gen=000002/_kind=opened")
    third = I.run_load(spark, again, second, "2024-01-04 06:00:00", base)
    assert third.gen == 2 and _rows(third["orders_snapshot"]) == _rows(again["orders_snapshot"])


def test_compaction_keeps_the_table(spark):
    from kairos.operators.scd import scd2_changes, scd2_snapshot
    from kairos.sources.versions import VersionStore

    schema = "id long, v string, updated_at timestamp_ntz"
    hist, store = None, None
    for day in range(1, 8):
        at = F.lit(f"2024-01-0{day}").cast("timestamp_ntz")
        load = spark.range(12).where((F.col("id") % day == 0) & (F.col("id") < 4 + day)).select("id", F.lit(str(day)).alias("v"), at.alias("updated_at"))
        rows = scd2_changes(store.open_rows(day - 2) if store else None, load, "id")
        store = store or VersionStore(spark, scratch_path(spark, "versions"), "id", rows.drop("_kind").schema, compact_every=3)
        store.write(day - 1, rows)
        hist = scd2_snapshot(hist, load, "id")
        assert _rows(store.table(day - 1)) == _rows(hist), (day, schema)
