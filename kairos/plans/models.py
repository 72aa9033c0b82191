"""The model set M1-M18: raw -> snapshots -> key maps -> staging ->
intermediate -> marts -> features, as lazy DataFrame functions.

``Models`` wires the layers with memoised properties, so every downstream
model reuses the same upstream DataFrame objects.  ``materialize`` writes
chosen layers as Parquet under a shared folder and reads them back: the
layered pipeline the reference runs (views for cheap layers, tables for
marts), with lineage cut at every written layer.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairos.functions.scalars import as_of as _as_of
from kairos.functions.scalars import day_diff, packed_key, ratio_if, safe_ratio, text_packed, text_unpacked, unpacked_key
from kairos.operators.aggregates import customer_orders, order_items_summary, order_payments
from kairos.operators.keys import sk_map, surrogate_keys
from kairos.operators.pit import fk_enrich
from kairos.operators.scd import current, lookback_filter, scd2_from_loads, scd2_snapshot
from kairos.sources import raw as rawsrc

# Evaluation time of the feature tables unless given (features must not read the clock).
DEFAULT_AS_OF = "2001-12-31 00:00:00"
ORDER_LOOKBACK_DAYS = 7


def snapshot_from_changes(changes: DataFrame, key: str = "id", few: bool = False) -> DataFrame:
    """M1-M3 (full rebuild): replay daily loads of a change log through S1 (``few``: a handful of rows per key)."""
    return scd2_from_loads(changes.withColumn("_load", rawsrc.load_day("updated_at")), key, "updated_at", "_load", few)


def lookback_days_since(as_of: str, last_as_of: str | None, days: int = ORDER_LOOKBACK_DAYS) -> int:
    """Days to look back from ``as_of`` so that ``days`` before the last run are covered, however long ago it was."""
    if last_as_of is None:
        return days
    gap = (dt.datetime.fromisoformat(as_of).date() - dt.datetime.fromisoformat(last_as_of).date()).days
    return days + max(0, gap)


def orders_snapshot_incremental(history: DataFrame | None, raw_orders: DataFrame, as_of, last_as_of=None) -> DataFrame:
    """M3 daily run: lookback filter (B9) then one S1 step.

    ``last_as_of``, the time of the previous run, widens the window over missed runs."""
    days = lookback_days_since(as_of, last_as_of)
    src = lookback_filter(raw_orders, history is not None, "updated_at", as_of, days)
    return scd2_snapshot(history, src, "id", "updated_at", lookback_filtered=history is not None)


def stg_customers(snapshot: DataFrame, mapping: DataFrame | None, previous=None, sk_map_df=None) -> DataFrame:
    if previous is not None:
        previous = previous.withColumnRenamed("customer_id", "source_id")
    k = surrogate_keys(snapshot, "id", sk_map_df=sk_map_df, mapping=mapping, previous=previous)
    return k.select("sk", "master_sk", F.col("source_id").alias("customer_id"), "canonical_id", "name",
                    "email", "country", "status", "created_at", "updated_at", "valid_from", "valid_to",
                    "is_current")


def stg_products(snapshot: DataFrame, previous=None, sk_map_df=None) -> DataFrame:
    if previous is not None:
        previous = previous.withColumnRenamed("product_id", "source_id").withColumnRenamed("product_name", "name")
    k = surrogate_keys(snapshot, "id", sk_map_df=sk_map_df, previous=previous, few=True)
    return k.select("sk", "master_sk", F.col("source_id").alias("product_id"), "canonical_id",
                    F.col("name").alias("product_name"), "category", "price", "is_active", "created_at",
                    "updated_at", "valid_from", "valid_to", "is_current")


def stg_orders(snapshot: DataFrame, customers: DataFrame, customer_map: DataFrame | None,
               previous=None, sk_map_df=None, strategy: str = "asof") -> DataFrame:
    # a customer has any number of versions: as-of, cut by year against hot customers
    k = surrogate_keys(snapshot, "id", sk_map_df=sk_map_df, previous=previous, few=True)
    e = fk_enrich(k, "customer_id", "placed_at", customers, "customer_id", "customer",
                  sk_map=customer_map, strategy=strategy, slice_unit="year")
    return e.select("sk", "master_sk", F.col("source_id").alias("order_id"), "canonical_id", "customer_id",
                    "customer_sk", "customer_master_sk", "status", "amount", "placed_at", "updated_at",
                    "valid_from", "valid_to", "is_current")


def stg_payments(payments: DataFrame, orders: DataFrame, order_map: DataFrame | None,
                 strategy: str = "merge", settled: str | None = None, keep=(), packed: bool = False) -> DataFrame:
    """M11.  ``settled`` names a column: whether the order's version is one valid at the payment; ``keep``: columns passed on;
    ``packed``: the order's keys as ``packed_key``."""
    # an order has at most one version per stage: facts and versions of an order meet in one sort
    e = fk_enrich(payments, "order_id", "created_at", orders, "order_id", "order", sk_map=order_map,
                  strategy=strategy, mark=settled, packed=packed)
    return e.select(F.col("id").alias("payment_id"), "order_id", "order_sk", "order_master_sk",
                    F.col("method").alias("payment_method"), F.col("status").alias("payment_status"),
                    "amount", "created_at", *keep, *([settled] if settled else []))


def payments_as_loaded(staged: DataFrame, keep=()) -> DataFrame:
    """The log rows behind staged payments (to link them again)."""
    return staged.select(F.col("payment_id").alias("id"), "order_id", F.col("payment_method").alias("method"),
                         F.col("payment_status").alias("status"), "amount", "created_at", *keep)


def stg_order_items(items: DataFrame, orders: DataFrame, order_map, products: DataFrame, product_map,
                    strategy: str = "merge", settled: str | None = None, keep=()) -> DataFrame:
    """M12.  ``settled`` names a column: whether both versions are valid at the item's time; ``keep``: columns passed on."""
    # few versions per order and product, as for payments; orders last, as readers group by order
    marks = ("_order_settled", "_product_settled") if settled else (None, None)
    master = F.col("product_master_sk")
    e = (items.transform(lambda d: fk_enrich(d, "product_id", "created_at", products, "product_id", "product",
                                             sk_map=product_map, strategy=strategy, mark=marks[1], packed=True))
         # a first version's key is its master too: it crosses the next exchange once (a packed key is never empty)
         .withColumn("product_master_sk", F.when(master.eqNullSafe(F.col("product_sk")), F.lit(b"")).otherwise(master))
         .transform(lambda d: fk_enrich(d, "order_id", "created_at", orders, "order_id", "order",
                                        sk_map=order_map, strategy=strategy, mark=marks[0]))
         .withColumn("product_master_sk", unpacked_key(F.when(master == F.lit(b""), F.col("product_sk")).otherwise(master)))
         .withColumn("product_sk", unpacked_key("product_sk")))
    return e.select(F.col("id").alias("order_item_id"), "order_id", "order_sk", "order_master_sk",
                    "product_id", "product_sk", "product_master_sk", "quantity", "unit_price", "created_at",
                    (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)").alias("line_total"), *keep,
                    *([(F.col(marks[0]) & F.col(marks[1])).alias(settled)] if settled else []))


def items_as_loaded(staged: DataFrame, keep=()) -> DataFrame:
    """The log rows behind staged order items (to link them again)."""
    return staged.select(F.col("order_item_id").alias("id"), "order_id", "product_id", "quantity", "unit_price", "created_at", *keep)


def dim_customers(customers: DataFrame, co: DataFrame) -> DataFrame:
    c = current(customers)
    j = c.join(co, c.master_sk == co.customer_master_sk, "left")
    zero_money = F.lit(0).cast("decimal(18,2)")
    return j.select("sk", "master_sk", "customer_id", "name", "email", "country", "status", "created_at",
                    "updated_at", "valid_from", "first_order_at", "last_order_at",
                    F.coalesce("total_orders", F.lit(0).cast("bigint")).alias("total_orders"),
                    F.coalesce("total_spent", zero_money).alias("total_spent"),
                    F.coalesce("completed_orders", F.lit(0).cast("bigint")).alias("completed_orders"),
                    F.coalesce("returned_orders", F.lit(0).cast("bigint")).alias("returned_orders"))


def fct_orders(orders: DataFrame, op: DataFrame) -> DataFrame:
    # keys cross the join packed; the one it joins on where ``op`` has it packed (``order_payments``)
    keys = ["sk", "customer_sk", "customer_master_sk"]
    if op.schema["order_master_sk"].dataType.typeName() == "binary":
        keys.append("master_sk")
    o = current(orders).withColumns({k: packed_key(k) for k in keys})
    j = o.join(op, o.master_sk == op.order_master_sk, "left").withColumns({k: unpacked_key(k) for k in keys})
    paid = F.coalesce(F.col("paid_amount"), F.lit(0).cast("decimal(18,2)"))
    return j.select(F.col("sk").alias("order_sk"), F.col("master_sk").alias("order_master_sk"), "order_id",
                    "customer_id", F.col("status").alias("order_status"), F.col("amount").alias("order_amount"),
                    "placed_at", "updated_at", "customer_sk", "customer_master_sk",
                    F.coalesce("payment_attempts", F.lit(0).cast("bigint")).alias("payment_attempts"),
                    paid.alias("paid_amount"),
                    F.coalesce("is_paid", F.lit(False)).alias("is_paid"),
                    F.coalesce("failed_payments", F.lit(0).cast("bigint")).alias("failed_payments"),
                    F.coalesce("refunded_payments", F.lit(0).cast("bigint")).alias("refunded_payments"),
                    (F.col("status") == "returned").alias("is_returned"),
                    (F.col("amount") - paid).cast("decimal(18,2)").alias("unpaid_amount"))


def customer_features(dc: DataFrame, as_of=None) -> DataFrame:
    now = _as_of(as_of)
    return dc.where(F.col("last_order_at").isNotNull()).select(
        F.col("sk").alias("customer_sk"), "master_sk", "customer_id",
        F.col("status").alias("customer_status"), "country",
        F.col("completed_orders").alias("order_frequency"),
        F.col("total_spent").alias("lifetime_value"),
        "total_orders",
        day_diff("last_order_at", now).alias("days_since_last_order"),
        safe_ratio("returned_orders", "total_orders").alias("return_rate"),
        safe_ratio("total_spent", "total_orders").alias("avg_order_value"),
        day_diff("first_order_at", now).alias("customer_tenure_days"),
        ratio_if(day_diff("first_order_at", "last_order_at"), F.col("total_orders") - 1,
                 F.col("total_orders") >= 2).alias("avg_days_between_orders"))


def order_features(fo: DataFrame, items: DataFrame, cf: DataFrame) -> DataFrame:
    oi = order_items_summary(items, few=True)
    c = cf.select(F.col("customer_id").alias("_cf_id"), F.col("lifetime_value").alias("customer_ltv_at_order"),
                  F.col("order_frequency").alias("customer_order_frequency"),
                  F.col("return_rate").alias("customer_return_rate"))
    p = text_packed(fo)
    j = text_unpacked(p.join(oi, "order_id", "left").join(c, F.col("customer_id") == F.col("_cf_id"), "left"), fo.schema)
    return j.select(
        "order_sk", "order_master_sk", "order_id", "customer_id", "customer_sk", "customer_master_sk",
        "order_status", "order_amount", "is_paid", "is_returned", "payment_attempts", "failed_payments",
        "unpaid_amount", "customer_ltv_at_order", "customer_order_frequency", "customer_return_rate",
        "placed_at",
        safe_ratio("failed_payments", "payment_attempts").alias("payment_failure_rate"),
        F.coalesce("item_count", F.lit(0).cast("bigint")).alias("item_count"),
        F.coalesce("total_quantity", F.lit(0).cast("bigint")).alias("total_quantity"),
        F.coalesce("unique_products", F.lit(0).cast("bigint")).alias("unique_products"),
        F.coalesce("avg_unit_price", F.lit(0.0)).alias("avg_unit_price"))


class Models:
    """All models over the driver tables of one scale factor (full refresh)."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = DEFAULT_AS_OF,
                 materialize_dir: str | None = None, layer_mode: str | None = None, gated: bool = False,
                 shared=(), unread=()):
        """``layer_mode``: ``lazy`` (plain plans), ``checkpoint`` (the customer layers
        and those named in ``shared`` written as Parquet under ``spark.checkpoint.dir`` and
        read back, so layers with several readers are computed once and lineage is cut;
        a layer with one reader passes to it without being written, and so does one in ``unread``, which the result
        doesn't read) or ``write`` (every model written under ``materialize_dir``).
        ``gated``: a layer that fails its declared checks stops the build."""
        self.gated = gated
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self.materialize_dir = materialize_dir
        self.shared = (self._SHARED | set(shared)) - set(unread)
        self.layer_mode = layer_mode or ("write" if materialize_dir else "lazy")

    _SHARED = {"customers_snapshot", "dim_customer_sk_map", "stg_customers"}

    def _mat(self, name: str, df: DataFrame) -> DataFrame:
        out = self._layer(name, df)
        if self.gated:
            from kairos.plans.contracts import gate

            return gate(name, out, self.as_of)
        return out

    def _layer(self, name: str, df: DataFrame) -> DataFrame:
        if self.layer_mode == "write":
            path = f"{self.materialize_dir.rstrip('/')}/{name}"
            df.write.mode("overwrite").parquet(path)
            return self.spark.read.parquet(path)
        if self.layer_mode == "checkpoint" and name in self.shared:
            from kairos.session import cut_lineage

            return cut_lineage(df)
        return df

    # raw
    @functools.cached_property
    def id_mapping(self):  # M4
        return rawsrc.read_id_mapping(self.spark)

    # snapshots
    @functools.cached_property
    def customers_snapshot(self):  # M1
        return self._mat("customers_snapshot", snapshot_from_changes(rawsrc.customer_changes(self.spark, self.sf_dir)))

    @functools.cached_property
    def products_snapshot(self):  # M2
        return self._mat("products_snapshot", snapshot_from_changes(rawsrc.product_changes(self.spark, self.sf_dir), few=True))

    @functools.cached_property
    def orders_snapshot(self):  # M3
        return self._mat("orders_snapshot", snapshot_from_changes(rawsrc.order_changes(self.spark, self.sf_dir), few=True))

    # key maps
    @functools.cached_property
    def dim_customer_sk_map(self):  # M5
        return self._mat("dim_customer_sk_map", sk_map(self.customers_snapshot, "id", self.id_mapping))

    @functools.cached_property
    def dim_product_sk_map(self):  # M6
        return self._mat("dim_product_sk_map", sk_map(self.products_snapshot, "id"))

    @functools.cached_property
    def dim_order_sk_map(self):  # M7
        return self._mat("dim_order_sk_map", sk_map(self.orders_snapshot, "id"))

    # staging
    @functools.cached_property
    def stg_customers(self):  # M8
        return self._mat("stg_customers", stg_customers(self.customers_snapshot, self.id_mapping))

    @functools.cached_property
    def stg_products(self):  # M9
        return self._mat("stg_products", stg_products(self.products_snapshot))

    @functools.cached_property
    def stg_orders(self):  # M10
        return self._mat("stg_orders", stg_orders(self.orders_snapshot, self.stg_customers,
                                                  self.dim_customer_sk_map))

    @functools.cached_property
    def stg_payments(self):  # M11
        return self._mat("stg_payments", stg_payments(rawsrc.raw_payments(self.spark, self.sf_dir),
                                                      self.stg_orders, self.dim_order_sk_map))

    @functools.cached_property
    def stg_order_items(self):  # M12
        return self._mat("stg_order_items", stg_order_items(
            rawsrc.raw_order_items(self.spark, self.sf_dir), self.stg_orders, self.dim_order_sk_map,
            self.stg_products, self.dim_product_sk_map))

    # intermediate
    @functools.cached_property
    def int_customer_orders(self):  # M13
        return customer_orders(self.stg_orders)

    @functools.cached_property
    def _payments_to_sum(self):
        """Staged payments for ``order_payments``: where they are no layer, what it doesn't read stays out of the link."""
        if self.layer_mode == "write" or self.gated or "stg_payments" in self.shared:
            return self.stg_payments
        # it counts ids without reading them, and never reads the key of an order's version
        seen = rawsrc.raw_payments(self.spark, self.sf_dir).withColumn("id", F.when(F.col("id").isNotNull(), F.lit("")))
        return stg_payments(seen, self.stg_orders.withColumn("sk", F.lit("")), self.dim_order_sk_map, packed=True)

    @functools.cached_property
    def int_order_payments(self):  # M14
        return order_payments(self._payments_to_sum)

    # marts
    @functools.cached_property
    def dim_customers(self):  # M15
        return self._mat("dim_customers", dim_customers(self.stg_customers, self.int_customer_orders))

    @functools.cached_property
    def fct_orders(self):  # M16
        return self._mat("fct_orders", fct_orders(self.stg_orders, order_payments(self._payments_to_sum, packed=True)))

    @functools.cached_property
    def customer_features(self):  # M17
        return self._mat("customer_features", customer_features(self.dim_customers, self.as_of))

    @functools.cached_property
    def order_features(self):  # M18
        return self._mat("order_features", order_features(self.fct_orders, self.stg_order_items,
                                                          self.customer_features))


MODEL_NAMES = [
    "customers_snapshot", "products_snapshot", "orders_snapshot", "dim_customer_sk_map",
    "dim_product_sk_map", "dim_order_sk_map", "stg_customers", "stg_products", "stg_orders",
    "stg_payments", "stg_order_items", "int_customer_orders", "int_order_payments", "dim_customers",
    "fct_orders", "customer_features", "order_features",
]
