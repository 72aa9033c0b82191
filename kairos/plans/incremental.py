"""Incremental daily run: one load applied to the stored state.

State under ``base`` (a shared folder):

* snapshots and staging: version tables (``sources/versions.py``) to which a run
  adds the versions it opened and closed, so that writing and enriching follow
  the changes, not the entities or the history;
* key maps: ``{name}/gen=N`` holds only the entities first seen in run N;
* logs: fact stores (``sources/facts.py``): the payments and items new in run N, one per id,
  and those linked again because a parent came late;
* ``_commits/N.json``, written last: the run's ``as_of`` and the tables' schemas.
  A generation without it doesn't count; the next run overwrites it.  Entity loads may gain nullable
  columns and wider types: older files are read in the newer schema; other changes stop the run.

A new process goes on with ``load_state``; a run that brings no state to a base
with commits is refused.  Staging keys take master_sk from the key map, so the
result equals the full refresh (tests/test_incremental.py, query
``inc_daily_run``); an order's customer key is that of the run that wrote the
version.  Payments and items may come before their order or product, and versions after
the facts they cover: a run links the facts again that its versions touch, so the staged
logs equal a full build over the same loads (``inc_late_payments``, ``inc_late_items``,
``inc_late_fct_orders``).  Marts and features are rebuilt from staging.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StringType, StructField, StructType

from kairos.functions.scalars import text_packed, text_unpacked
from kairos.operators.keys import canonicalise, first_version, new_entities
from kairos.operators.quality import conformed, evolved
from kairos.operators.scd import SCD_COLS, dedup_latest, lookback_filter, normalise_history, scd2_changes
from kairos.plans import models as M
from kairos.session import LAYER_CODEC
from kairos.sources.commits import commit, committed, read_note
from kairos.sources.facts import SETTLED, WAS_PENDING, FactStore
from kairos.sources.versions import COMPACT_EVERY, VersionStore

SNAPSHOTS = {"customers": "customers_snapshot", "products": "products_snapshot", "orders": "orders_snapshot"}
STAGING = {"customers": ("stg_customers", "customer_id"), "products": ("stg_products", "product_id"),
           "orders": ("stg_orders", "order_id")}
MAPS = {"customers": "dim_customer_sk_map", "products": "dim_product_sk_map", "orders": "dim_order_sk_map"}
LOGS = {"payments": "stg_payments", "items": "stg_order_items"}
LOG_ID = {"payments": "payment_id", "items": "order_item_id"}


@dataclass
class Load:
    """One day's input: full-replace entity tables (one row per id) and, if any, log rows."""
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    payments: DataFrame | None = None
    items: DataFrame | None = None


@dataclass
class State:
    base: str
    gen: int
    tables: dict[str, DataFrame]
    as_of: str | None = None
    stores: dict[str, VersionStore] = field(default_factory=dict)
    facts: dict[str, FactStore] = field(default_factory=dict)
    schemas: dict[str, dict] = field(default_factory=dict)

    def __getitem__(self, k: str) -> DataFrame:
        return self.tables[k]


# --- commits ----------------------------------------------------------------

def load_state(spark: SparkSession, base: str) -> State | None:
    """The state after the last committed run under ``base`` (None: no run yet)."""
    done = committed(spark, base)
    if not done:
        return None
    note = read_note(spark, base, done[-1])
    return _state(spark, base, done[-1], note["as_of"], note["schemas"], note["compact_every"])


def _state(spark: SparkSession, base: str, gen: int, as_of: str | None, schemas: dict, compact_every: int) -> State:
    state = State(base, gen, {}, as_of, schemas=schemas)
    for ent, name in SNAPSHOTS.items():
        for table, key in ((name, "id"), STAGING[ent]):
            state.stores[table] = VersionStore(spark, os.path.join(base, table), key, StructType.fromJson(schemas[table]), compact_every)
            state.tables[table] = state.stores[table].table(gen)
    for name in MAPS.values():
        state.tables[name] = _appended(spark, base, name, gen, StructType.fromJson(schemas[name]))
    for ent, name in LOGS.items():
        if name in schemas:
            state.facts[name] = _fact_store(spark, base, ent, StructType.fromJson(schemas[name]))
            state.tables[name] = state.facts[name].table(gen)
    return state


def _fact_store(spark: SparkSession, base: str, ent: str, schema: StructType) -> FactStore:
    return FactStore(spark, os.path.join(base, LOGS[ent]), LOG_ID[ent], "created_at", schema)


# --- append-only tables -------------------------------------------------------

def _appended(spark: SparkSession, base: str, name: str, gen: int, schema: StructType) -> DataFrame:
    full = StructType(list(schema.fields)).add("gen", IntegerType())
    return spark.read.schema(full).parquet(os.path.join(base, name)).where(F.col("gen") <= gen).drop("gen")


def _append(spark: SparkSession, base: str, name: str, gen: int, rows: DataFrame) -> DataFrame:
    rows.write.mode("overwrite").option("compression", LAYER_CODEC).parquet(os.path.join(base, name, f"gen={gen:06d}"))
    return _appended(spark, base, name, gen, rows.schema)


def _new_map_rows(touched: DataFrame, previous_map: DataFrame | None, mapping) -> DataFrame:
    """Entities first seen in this run: their first version is among the touched rows."""
    base = normalise_history(touched, "id").select("sk", "source_id", "valid_from")
    return new_entities(first_version(canonicalise(base, "source_id", mapping)), previous_map)


# --- the run ------------------------------------------------------------------

def run_load(spark: SparkSession, state: State | None, load: Load, as_of: str, base: str,
             lookback_days: int | None = M.ORDER_LOOKBACK_DAYS, mapping: DataFrame | None = None,
             strategy: str = "asof", compact_every: int = COMPACT_EVERY) -> State:
    """Apply one load and commit it; returns the new state (generation ``state.gen + 1``).

    ``lookback_days`` limits the orders read to those updated since that many days
    before the previous run (None: all), so a missed run loses nothing.
    """
    done = committed(spark, base)
    if state is None and done:
        raise ValueError(f"{base} holds {len(done)} committed runs: continue with load_state")
    if state is not None and state.gen != (done[-1] if done else None):
        raise ValueError(f"state is generation {state.gen}, the base is at {done[-1] if done else None}")
    gen = 0 if state is None else state.gen + 1
    schemas: dict[str, dict] = {}
    stores: dict[str, VersionStore] = {}

    def store(name: str, key: str, rows: DataFrame) -> DataFrame:
        """Write a run's changes and return them as stored."""
        schema = rows.drop("_kind").schema
        stores[name] = VersionStore(spark, os.path.join(base, name), key, schema, compact_every)
        schemas[name] = schema.jsonValue()
        stores[name].write(gen, rows)
        return stores[name].touched(gen).drop("_kind")

    # snapshots (S1) applied to the open versions; orders through the lookback filter
    touched: dict[str, DataFrame] = {}
    for ent, name in SNAPSHOTS.items():
        incoming = getattr(load, ent)
        if ent == "orders" and lookback_days is not None and state is not None:
            incoming = lookback_filter(incoming, True, "updated_at", as_of, M.lookback_days_since(as_of, state.as_of, lookback_days))
        open_rows = None
        if state is not None:
            # new nullable columns and wider types go on, what breaks the stored history stops the run
            held = StructType([f for f in state.stores[name].schema.fields if f.name not in SCD_COLS])
            shape = evolved(held, incoming.schema)
            incoming = conformed(incoming, shape)
            full = StructType(list(shape.fields) + [f for f in state.stores[name].schema.fields if f.name in SCD_COLS])
            open_rows = replace(state.stores[name], schema=full).open_rows(state.gen)
        touched[ent] = store(name, "id", scd2_changes(open_rows, incoming, "id"))

    # key maps (S4): append the entities first seen now
    tables: dict[str, DataFrame] = {}
    for ent, name in MAPS.items():
        fresh = _new_map_rows(touched[ent], None if state is None else state[name], mapping if ent == "customers" else None)
        tables[name] = _append(spark, base, name, gen, fresh)
        schemas[name] = fresh.schema.jsonValue()

    # staging (S3) for the touched versions only, master_sk from the maps
    def kind(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_kind", F.when(F.col("is_current"), "opened").otherwise("closed"))

    store("stg_customers", "customer_id", kind(M.stg_customers(touched["customers"], mapping, sk_map_df=tables["dim_customer_sk_map"])))
    store("stg_products", "product_id", kind(M.stg_products(touched["products"], sk_map_df=tables["dim_product_sk_map"])))
    customers = stores["stg_customers"].table(gen)
    store("stg_orders", "order_id", kind(M.stg_orders(touched["orders"], customers, tables["dim_customer_sk_map"],
                                                      sk_map_df=tables["dim_order_sk_map"], strategy=strategy)))

    # logs (E2): one row per id, only ids not stored yet; facts whose parents came late are linked again
    orders, products = stores["stg_orders"].table(gen), stores["stg_products"].table(gen)

    def opened(table: str, key: str) -> DataFrame:
        """Parents touched in this run and the start of the earliest version opened for them."""
        rows = stores[table].touched(gen).where(F.col("_kind") != "closed")
        return rows.groupBy(key).agg(F.min("valid_from").alias("_from"))

    def link(ent: str, rows: DataFrame, keep=()) -> DataFrame:
        if ent == "payments":
            return M.stg_payments(rows, orders, tables["dim_order_sk_map"], settled=SETTLED, keep=keep)
        return M.stg_order_items(rows, orders, tables["dim_order_sk_map"], products, tables["dim_product_sk_map"], settled=SETTLED, keep=keep)

    parents = {"payments": {"order_id": "stg_orders"}, "items": {"order_id": "stg_orders", "product_id": "stg_products"}}
    for ent, name in LOGS.items():
        rows = getattr(load, ent)
        known = state.facts.get(name) if state is not None else None
        if rows is None and known is None:
            continue
        again = None
        if known is not None:
            stale = known.affected(state.gen, {fk: opened(table, fk) for fk, table in parents[ent].items()}, packed=True)
            if stale is not None:
                again = _relinked(ent, stale, known.schema, link)
        if rows is None:
            known.write(gen, known.table(state.gen).limit(0).withColumn(SETTLED, F.lit(True)), again)
            schemas[name] = state.schemas[name]
            continue
        # ids cross the shuffles of this and of the links packed
        new = dedup_latest(_id_packed(rows, "id"), ["id"], ["created_at"])
        if known is not None:
            new = new.join(_id_packed(known.ids(state.gen).withColumnRenamed(LOG_ID[ent], "id"), "id"), "id", "left_anti")
        out = _as_text(link(ent, new.select(*rows.columns)), {LOG_ID[ent]: rows.schema["id"].dataType})
        schema = out.drop(SETTLED).schema
        _fact_store(spark, base, ent, schema).write(gen, out, again)
        schemas[name] = schema.jsonValue()

    commit(spark, base, gen, {"as_of": str(as_of), "schemas": schemas, "compact_every": compact_every})
    return _state(spark, base, gen, str(as_of), schemas, compact_every)


def _id_packed(df: DataFrame, c: str) -> DataFrame:
    return text_packed(df, keep=[x for x in df.columns if x != c])


def _as_text(df: DataFrame, types: dict) -> DataFrame:
    """``df`` with its packed columns that are text in ``types`` as text."""
    packed = StructType([f for f in df.schema.fields if f.dataType == BinaryType() and types.get(f.name) == StringType()])
    return text_unpacked(df, StructType([StructField(f.name, StringType()) for f in packed.fields]))


def _relinked(ent: str, stale: DataFrame, schema: StructType, link) -> DataFrame:
    """``stale`` facts (texts packed) linked anew: those whose links, or their being settled, differ from what is stored."""
    cols = schema.names
    links = [c for c in cols if c.endswith("_sk")]
    old = stale.withColumns({f"_old_{c}": F.col(c) for c in links}).withColumn(f"_old_{SETTLED}", F.col("_link") == "settled")
    keep = [WAS_PENDING, *[f"_old_{c}" for c in [*links, SETTLED]]]
    loaded = (M.payments_as_loaded if ent == "payments" else M.items_as_loaded)(old, keep)
    types = {f.name: f.dataType for f in schema.fields}
    new = _as_text(link(ent, loaded, keep), types | {f"_old_{c}": types[c] for c in links})
    same = F.lit(True)
    for c in [*links, SETTLED]:
        same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    return new.where(~same).select(*cols, SETTLED, WAS_PENDING)


def marts(spark: SparkSession, state: State, payments: DataFrame | None, items: DataFrame | None, as_of) -> dict[str, DataFrame]:
    """Rebuild intermediate, marts and features from the state's staging tables.

    Logs given here are enriched whole; without them the state's staged logs are used.
    """
    from kairos.operators.aggregates import customer_orders, order_payments

    if payments is None:
        stg_pay, stg_items = state["stg_payments"], state["stg_order_items"]
    else:
        stg_pay = M.stg_payments(payments, state["stg_orders"], state["dim_order_sk_map"])
        stg_items = M.stg_order_items(items, state["stg_orders"], state["dim_order_sk_map"],
                                      state["stg_products"], state["dim_product_sk_map"])
    dc = M.dim_customers(state["stg_customers"], customer_orders(state["stg_orders"]))
    fo = M.fct_orders(state["stg_orders"], order_payments(stg_pay, packed=True))
    cf = M.customer_features(dc, as_of)
    return {"stg_payments": stg_pay, "stg_order_items": stg_items, "dim_customers": dc, "fct_orders": fo,
            "customer_features": cf, "order_features": M.order_features(fo, stg_items, cf)}
