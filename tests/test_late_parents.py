"""Facts that come before their parents, and versions that come after the facts they cover."""

import datetime as dt

from pyspark.sql import functions as F

from kairos.operators.scd import dedup_latest, scd2_from_loads
from kairos.plans import incremental as I
from kairos.plans import models as M
from kairos.session import hadoop_path, scratch_path

AS_OF = "2024-02-01 00:00:00"


def ts(s):
    return dt.datetime.fromisoformat(s)


def _rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.select(*sorted(df.columns)).collect())


def _customers(spark):
    rows = [(i, f"n{i}", "e", "c", "active", ts("2024-01-01"), ts("2024-01-01")) for i in range(4)]
    return spark.createDataFrame(rows, "id long, name string, email string, country string, status string, created_at timestamp_ntz, updated_at timestamp_ntz")


def _products(spark, ids):
    rows = [(i, f"p{i}", "k", True, ts("2024-01-01"), ts("2024-01-01")) for i in ids]
    return (spark.createDataFrame(rows, "id long, name string, category string, is_active boolean, created_at timestamp_ntz, updated_at timestamp_ntz")
            .select("id", "name", "category", F.lit(3).cast("decimal(18,2)").alias("price"), "is_active", "created_at", "updated_at"))


def _orders(spark, states):
    rows = [(i, i % 4, status, ts("2024-01-02"), ts(at)) for i, status, at in states]
    return (spark.createDataFrame(rows, "id long, customer_id long, status string, placed_at timestamp_ntz, updated_at timestamp_ntz")
            .select("id", "customer_id", "status", F.lit(5).cast("decimal(18,2)").alias("amount"), "placed_at", "updated_at"))


def _payments(spark, rows):
    return (spark.createDataFrame([(p, o, "card", "success", ts(at)) for p, o, at in rows],
                                  "id string, order_id long, method string, status string, created_at timestamp_ntz")
            .select("id", "order_id", "method", "status", F.lit(5).cast("decimal(18,2)").alias("amount"), "created_at"))


def _items(spark, rows):
    return (spark.createDataFrame([(p, o, k, 2, ts(at)) for p, o, k, at in rows],
                                  "id string, order_id long, product_id long, quantity long, created_at timestamp_ntz")
            .select("id", "order_id", "product_id", "quantity", F.lit(3).cast("decimal(18,2)").alias("unit_price"), "created_at"))


def test_late_parents_equal_a_full_build_and_rewrite_little(spark):
    noon = "2024-01-02 12:00:00"
    placed = [(i, "placed", "2024-01-02") for i in range(40)]

    def at(changes):
        now = {i: (i, s, t) for i, s, t in placed}
        now.update({c[0]: c for c in changes})
        return list(now.values())

    pay0 = [(f"a{i}", i, noon) for i in range(40)] + [
        ("late3", 3, "2024-01-04"),     # order 3 gets a version of January 3 a run later
        ("early9", 9, "2024-01-01"),    # before its order's first version: linked to the current one
        ("null", None, noon), ("never", 999, noon)]
    item0 = [(f"i{i}", i, i % 6, noon) for i in range(40)]
    moved1, moved2 = [(3, "shipped", "2024-01-03"), (9, "shipped", "2024-01-03")], [
        (3, "shipped", "2024-01-03"), (9, "shipped", "2024-01-03"), (7, "shipped", "2024-01-02 06:00:00")]
    loads = [
        I.Load(_customers(spark), _products(spark, range(5)), _orders(spark, placed[:20]), _payments(spark, pay0), _items(spark, item0)),
        I.Load(_customers(spark), _products(spark, range(6)), _orders(spark, at(moved1)), _payments(spark, [("b1", 1, noon), ("a1", 1, "2024-01-05")]), None),
        # a run without logs: order 7 turns out to have shipped before its payment at noon
        I.Load(_customers(spark), _products(spark, range(6)), _orders(spark, at(moved2))),
        I.Load(_customers(spark), _products(spark, range(6)), _orders(spark, at(moved2)))]
    base = scratch_path(spark, "late")
    for day, load in enumerate(loads):
        I.run_load(spark, I.load_state(spark, base), load, f"2024-01-0{3 + day} 06:00:00", base)
    state = I.load_state(spark, base)

    # a full build over the same loads
    def snapshot(name):
        logs = [getattr(x, name).withColumn("_load", F.lit(i)) for i, x in enumerate(loads)]
        out = logs[0]
        for x in logs[1:]:
            out = out.unionByName(x)
        return scd2_from_loads(out, "id", "updated_at", "_load")

    snaps = {n: snapshot(n) for n in ("customers", "products", "orders")}
    cmap, omap, pmap = (M.sk_map(snaps[n], "id") for n in ("customers", "orders", "products"))
    customers, products = M.stg_customers(snaps["customers"], None), M.stg_products(snaps["products"])
    orders = M.stg_orders(snaps["orders"], customers, cmap)
    late = loads[1].payments.where("id != 'a1'")  # an id counts as it was staged first
    pay = dedup_latest(loads[0].payments.unionByName(late), ["id"], ["created_at"])
    tables = {"stg_customers": customers, "stg_products": products, "stg_orders": orders, "dim_order_sk_map": omap, "dim_product_sk_map": pmap}
    full = I.marts(spark, I.State(base, -1, tables), pay, loads[0].items, AS_OF)
    got = I.marts(spark, state, None, None, AS_OF)
    for name in ("stg_payments", "stg_order_items", "fct_orders", "dim_customers", "customer_features", "order_features"):
        assert _rows(got[name]) == _rows(full[name]), name
    by = {r["payment_id"]: r for r in got["stg_payments"].collect()}
    shipped = {r["order_id"]: r["sk"] for r in orders.where("status = 'shipped'").collect()}
    assert by["late3"]["order_sk"] == shipped[3] and by["early9"]["order_sk"] == shipped[9] and by["a7"]["order_sk"] == shipped[7]
    assert all(by[f"a{i}"]["order_sk"] is not None for i in range(40))
    assert by["never"]["order_sk"] is None and by["null"]["order_master_sk"] is None

    # what is rewritten follows the changes: 20 orders and two versions, then one version, then nothing
    def again(name, gen):
        rows = spark.read.parquet(f"{base}/{name}/gen={gen:06d}")
        return rows.where("_set = 'again'").count() if "_set" in rows.columns else 0

    assert [again("stg_payments", 1), again("stg_payments", 2)] == [22, 1]
    assert again("stg_order_items", 1) == len({i for i in range(40) if i >= 20 or i % 6 == 5})
    store = state.facts["stg_payments"]
    assert store.affected(3, {"order_id": state["stg_orders"].limit(0).selectExpr("order_id", "valid_from as _from")}) is None
    assert store.ids(3).count() == store.table(3).count() == len(pay0) + 1


def test_a_retried_run_links_the_same(spark):
    """A run that wrote its facts but did not commit is run again with the same result."""
    first = I.Load(_customers(spark), _products(spark, range(2)), _orders(spark, [(0, "placed", "2024-01-02")]),
                   _payments(spark, [("a", 0, "2024-01-02 12:00:00"), ("b", 1, "2024-01-02 12:00:00")]))
    second = I.Load(_customers(spark), _products(spark, range(2)), _orders(spark, [(0, "placed", "2024-01-02"), (1, "placed", "2024-01-02")]))
    base = scratch_path(spark, "late-retry")
    I.run_load(spark, None, first, "2024-01-03 06:00:00", base)
    before = I.load_state(spark, base)
    once = _rows(I.run_load(spark, before, second, "2024-01-04 06:00:00", base)["stg_payments"])
    fs, p = hadoop_path(spark, f"{base}/_commits/000001.json")
    fs.delete(p, False)  # as if the process had died just before its commit
    again = I.run_load(spark, I.load_state(spark, base), second, "2024-01-04 06:00:00", base)
    assert _rows(again["stg_payments"]) == once and all("None" not in r for r in once)
