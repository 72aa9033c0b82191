"""The declared checks of sources and models, and a gate between layers.

``suite`` evaluates every contract in one aggregate pass per table (plus one
aggregate per unique key); ``gate`` stops a build when a layer fails its own.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kairos.operators.quality import Contract, check_contract, require

# Accepted codes, keys, required columns and age limits (hours until error) by table.
CUSTOMER_STATUS = ["active", "churned", "at_risk"]
ORDER_STATUS = ["placed", "shipped", "completed", "returned"]
PAYMENT_STATUS = ["success", "failed", "refunded"]

SOURCES = {
    "customers": Contract({}, required=["id", "email"], unique=["id"], accepted={"status": CUSTOMER_STATUS},
                          freshness_col="updated_at", freshness_hours=24),
    "products": Contract({}, required=["id"], unique=["id"], freshness_col="updated_at", freshness_hours=48),
    "orders": Contract({}, required=["id", "customer_id"], unique=["id"], accepted={"status": ORDER_STATUS},
                       freshness_col="updated_at", freshness_hours=24),
    "payments": Contract({}, required=["id", "order_id"], accepted={"status": PAYMENT_STATUS},
                         freshness_col="created_at", freshness_hours=24),
    "order_items": Contract({}, required=["id", "order_id", "product_id"], freshness_col="created_at", freshness_hours=24),
}
MODELS = {
    "stg_customers": Contract({}, required=["sk", "master_sk", "customer_id", "is_current", "email"], unique=["sk"],
                              accepted={"status": CUSTOMER_STATUS}),
    "stg_products": Contract({}, required=["sk", "master_sk", "product_id", "is_current", "price"], unique=["sk"]),
    "stg_orders": Contract({}, required=["sk", "master_sk", "order_id", "customer_id", "is_current"], unique=["sk"],
                           accepted={"status": ORDER_STATUS}),
    "stg_payments": Contract({}, required=["payment_id", "order_id"], unique=["payment_id"], accepted={"payment_status": PAYMENT_STATUS}),
    "stg_order_items": Contract({}, required=["order_item_id", "order_id"], unique=["order_item_id"]),
    "dim_customers": Contract({}, required=["sk", "master_sk", "customer_id", "email", "total_orders", "total_spent"], unique=["sk"],
                              accepted={"status": CUSTOMER_STATUS}),
    "fct_orders": Contract({}, required=["order_sk", "order_master_sk", "order_id", "customer_id", "customer_sk", "customer_master_sk", "is_paid"],
                           unique=["order_sk"], accepted={"order_status": ORDER_STATUS}),
    "customer_features": Contract({}, required=["customer_id", "days_since_last_order", "order_frequency", "lifetime_value", "return_rate",
                                                "avg_order_value"], unique=["customer_id"]),
    "order_features": Contract({}, required=["order_id", "customer_id", "payment_failure_rate"], unique=["order_id"]),
}
CONTRACTS = SOURCES | MODELS


def suite(tables: dict[str, DataFrame], as_of=None, contracts: dict[str, Contract] = CONTRACTS) -> DataFrame:
    """One row per failed clause of the given tables: table_name, clause, detail, n_failed."""
    parts = [check_contract(df, contracts[name], as_of).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()]
    return functools.reduce(DataFrame.unionByName, parts)


def gate(name: str, df: DataFrame, as_of=None) -> DataFrame:
    """``df`` itself, after its contract (if any) held; raises QualityError otherwise."""
    if name in CONTRACTS:
        require({name: check_contract(df, CONTRACTS[name], as_of)})
    return df
