"""Sources: raw table scans (A1), the id-mapping seed (A4), and the adapters
that present the driver's star-schema tables as the pipeline's raw layer.

Raw layer (columns as the loader would land them):

* customers  - mutable entity, change log keyed by ``id``
* products   - mutable entity, keyed by ``id``
* orders     - mutable entity, change log keyed by ``id`` (status transitions)
* payments   - append-only log (may repeat ids)
* order_items- append-only log (may repeat ids)

Mutable entities are given as *change logs* (every state the full-replace
table ever showed, with its ``updated_at``); replaying them load by load is
what the SCD-2 snapshot consumes.  All adapters are narrow projections or
explodes (no shuffle) except the customer attribute join, a plain equi-join.
"""

from __future__ import annotations

import csv
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairos.functions.scalars import md5_uuid, money, shift_days, ts_literal

# Fixed values of the adapter world (documented in README):
# creation time of every customer and product version 0, before any order.
ENTITY_EPOCH = "1994-01-01 00:00:00"
# customer status per event type of the driver's events table
EVENT_STATUS = {"signup": "active", "click": "active", "view": "at_risk", "error": "churned"}
# order stage order and its offset in days after o_orderdate
ORDER_STAGES = [("placed", 0), ("shipped", 1), ("completed", 7), ("returned", 30)]
# payment status per l_returnflag
PAYMENT_STATUS = {"N": "success", "A": "failed", "R": "refunded"}
# payment methods, picked by l_linenumber
PAYMENT_METHODS = ["credit_card", "debit_card", "bank_transfer", "gift_card"]

SEED_DIR = os.path.join(os.path.dirname(os.path.dirname(__file__)), "seeds")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_raw(spark: SparkSession, sf_dir: str, name: str, schema=None) -> DataFrame:
    """A1: scan one raw table; the schema is the given one, else that of the Parquet footers."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(table_path(sf_dir, name))


def read_id_mapping(spark: SparkSession, path: str | None = None) -> DataFrame:
    """A4/M4: the old_id -> new_id seed, header CSV cast to INTEGER.

    ``path`` names a file that all executors reach.  Without it the packaged seed,
    a few rows, is parsed on the driver: executors don't see the driver's package.
    """
    schema = "old_id int, new_id int"
    if path:
        return spark.read.option("header", True).schema(schema).csv(path)
    with open(os.path.join(SEED_DIR, "customer_id_mapping.csv"), newline="", encoding="utf-8") as f:
        return spark.createDataFrame([(int(r["old_id"]), int(r["new_id"])) for r in csv.DictReader(f)], schema)


def _map(c, mapping: dict, default=None):
    e = None
    for k, v in mapping.items():
        e = F.when(c == k, v) if e is None else e.when(c == k, v)
    return e.otherwise(default) if default is not None else e


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of raw customers.

    Version 0 of every customer comes from ``customer`` x ``nation`` at the
    entity epoch; every non-purchase event of user ``u`` is a later state of
    customer ``u`` with the status taken from the event type.
    """
    cust = read_raw(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = read_raw(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation has 25 rows by definition of the schema; Spark broadcasts it from file stats.
    base = (cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
            .select(F.col("c_custkey").alias("id"),
                    F.col("c_name").alias("name"),
                    F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@example.com")).alias("email"),
                    F.col("n_name").alias("country")))
    epoch = ts_literal(ENTITY_EPOCH)
    v0 = base.select("*", F.lit("active").alias("status"),
                     epoch.alias("created_at"), epoch.alias("updated_at"))
    ev = (read_raw(spark, sf_dir, "events")
          .where(F.col("event_type") != "purchase")
          .select(F.col("user_id").alias("id"), F.col("ts").alias("updated_at"),
                  _map(F.col("event_type"), EVENT_STATUS).alias("status")))
    later = (ev.join(base, "id", "inner")
             .select("id", "name", "email", "country", "status",
                     epoch.alias("created_at"), "updated_at"))
    return v0.unionByName(later)


def product_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of raw products: one state per part at the entity epoch."""
    epoch = ts_literal(ENTITY_EPOCH)
    return (read_raw(spark, sf_dir, "part")
            .select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                    F.col("p_type").alias("category"), money("p_retailprice").alias("price"),
                    F.lit(True).alias("is_active"),
                    epoch.alias("created_at"), epoch.alias("updated_at")))


def order_final_status() -> F.Column:
    return (F.when(F.col("o_orderkey") % 10 == 0, "returned")
            .when(F.col("o_orderstatus") == "F", "completed")
            .when(F.col("o_orderstatus") == "O", "shipped")
            .otherwise("placed"))


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of raw orders: placed -> shipped -> completed -> returned,
    each stage reached at a fixed day offset from the order date, up to the
    order's final status.  A narrow explode, no shuffle."""
    o = read_raw(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", order_final_status().alias("_final"))
    rank = {s: i for i, (s, _) in enumerate(ORDER_STAGES)}
    stages = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(s).alias("status"), F.lit(d).alias("days"))
                       for i, (s, d) in enumerate(ORDER_STAGES)])
    final_rank = _map(F.col("_final"), rank)
    return (o.select("*", F.explode(F.filter(stages, lambda st: st["rank"] <= final_rank)).alias("st"))
            .select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"),
                    F.col("st.status").alias("status"), money("o_totalprice").alias("amount"),
                    F.col("o_orderdate").alias("placed_at"),
                    (F.col("o_orderdate") + F.make_dt_interval(F.col("st.days"))).alias("updated_at")))


def raw_orders_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full-replace raw orders table as it looks after the last load."""
    o = read_raw(spark, sf_dir, "orders")
    final = order_final_status()
    offset = F.lit(0)
    for s, d in ORDER_STAGES:
        offset = F.when(final == s, F.lit(d)).otherwise(offset)
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"),
                    final.alias("status"), money("o_totalprice").alias("amount"),
                    F.col("o_orderdate").alias("placed_at"),
                    (F.col("o_orderdate") + F.make_dt_interval(offset)).alias("updated_at"))


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only payments log from lineitem (one payment per line)."""
    li = read_raw(spark, sf_dir, "lineitem")
    # precision stays <= 18 digits so Spark keeps decimals in longs (fast path)
    amount = F.round(F.col("l_extendedprice").cast("decimal(12,2)")
                     * (F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)")), 2)
    methods = F.array(*[F.lit(m) for m in PAYMENT_METHODS])
    return li.select(
        md5_uuid(F.lit("pay-"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.element_at(methods, (F.col("l_linenumber") % len(PAYMENT_METHODS) + 1).cast("int")).alias("method"),
        _map(F.col("l_returnflag"), PAYMENT_STATUS).alias("status"),
        amount.cast("decimal(18,2)").alias("amount"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_shipdate").alias("_loaded_at"))


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only order-items log from lineitem."""
    li = read_raw(spark, sf_dir, "lineitem")
    return li.select(
        md5_uuid(F.lit("item-"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        money("l_extendedprice").alias("unit_price"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_shipdate").alias("_loaded_at"))


def load_day(c="updated_at") -> F.Column:
    """The daily load that first sees a change made at time ``c``."""
    return F.to_date(F.col(c))


__all__ = [
    "ENTITY_EPOCH", "EVENT_STATUS", "ORDER_STAGES", "customer_changes", "load_day",
    "order_changes", "product_changes", "raw_order_items", "raw_orders_current",
    "raw_payments", "read_id_mapping", "read_raw", "shift_days",
]
