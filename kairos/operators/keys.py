"""Surrogate and stable keys.

C7 canonicalise, C8 assign_master_sk, C9 new_entities, D5 first_version,
E1 master_sk (first sk per canonical id), S3 surrogate_keys, S4 sk_map.

The reference's FIRST_VALUE window over the whole entity is computed here as a
``min_by`` aggregate joined back: the aggregate pre-reduces map-side, so an
entity with a huge history never lands in one task, and the join back to a
one-row-per-key table is split by AQE's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from kairos.functions.scalars import packed_key, unpacked_key
from kairos.operators.scd import normalise_history

def canonicalise(df: DataFrame, id_col: str, mapping: DataFrame | None = None,
                 out_col: str = "canonical_id") -> DataFrame:
    """``COALESCE(map.old_id, id)`` where ``map.new_id = id`` (an equi-join; the planner picks its form by size)."""
    if mapping is None:
        return df.withColumn(out_col, F.col(id_col))
    m = mapping.select(F.col("old_id").alias("_old"), F.col("new_id").alias("_new"))
    return (df.join(m, F.col(id_col) == F.col("_new"), "left")
            .withColumn(out_col, F.coalesce(F.col("_old").cast(df.schema[id_col].dataType), F.col(id_col)))
            .drop("_old", "_new"))


def first_version(df: DataFrame, key: str = "canonical_id", ts: str = "valid_from",
                  sk: str = "sk", out: str = "master_sk") -> DataFrame:
    """Per key, the sk of the earliest version (ties broken by sk)."""
    return df.groupBy(key).agg(F.min(F.struct(F.col(ts).alias("t"), F.col(sk).alias("k")))["k"].alias(out))


def master_sk_window(df: DataFrame, key: str = "canonical_id", ts: str = "valid_from",
                     sk: str = "sk", out: str = "master_sk", few: bool = False) -> DataFrame:
    """Every row gets the first version's sk of its key.

    ``few`` says that a key has a handful of versions: a window in the exchange that brought them together."""
    if few:
        first = F.first(sk).over(Window.partitionBy(key).orderBy(ts, sk))
        return df.select(key, *[c for c in df.columns if c != key], F.when(F.col(key).isNotNull(), first).alias(out))
    return df.join(first_version(df, key, ts, sk, out), key, "left")


def assign_master_sk(df: DataFrame, sk_map: DataFrame, key: str = "canonical_id",
                     sk: str = "sk", out: str = "master_sk") -> DataFrame:
    """``COALESCE(map.master_sk, sk)``: new entities self-assign.  Text keys cross the join packed."""
    m = sk_map.select(F.col("canonical_id").alias("_mk"), F.col("master_sk").alias("_msk"))
    if not (df.schema[sk].dataType == sk_map.schema["master_sk"].dataType == StringType()):
        return (df.join(m, F.col(key) == F.col("_mk"), "left")
                .withColumn(out, F.coalesce(F.col("_msk"), F.col(sk))).drop("_mk", "_msk"))
    j = df.withColumn(sk, packed_key(sk)).join(m.withColumn("_msk", packed_key("_msk")), F.col(key) == F.col("_mk"), "left")
    return (j.withColumn(out, unpacked_key(F.coalesce(F.col("_msk"), F.col(sk)))).withColumn(sk, unpacked_key(sk)).drop("_mk", "_msk"))


def new_entities(first: DataFrame, previous_map: DataFrame | None, key: str = "canonical_id") -> DataFrame:
    """Rows of ``first`` whose key is not in ``previous_map`` (NOT IN -> anti join)."""
    if previous_map is None:
        return first
    return first.join(previous_map.select(key), key, "left_anti")


def sk_map(history: DataFrame, id_col: str = "id", mapping: DataFrame | None = None,
           previous: DataFrame | None = None) -> DataFrame:
    """Append-only ``canonical_id -> master_sk`` map read from the snapshot.

    Returns the whole map after this run: ``previous`` plus entities not seen before.
    """
    base = normalise_history(history, id_col).select("sk", "source_id", "valid_from")
    resolved = canonicalise(base, "source_id", mapping)
    firsts = first_version(resolved)
    added = new_entities(firsts, previous)
    return added if previous is None else previous.select("canonical_id", "master_sk").unionByName(added)


def _changed_versions(base: DataFrame, previous: DataFrame) -> DataFrame:
    """Rows of ``base`` whose (sk, valid_to) differ from what ``previous`` holds.

    Catches new versions *and* versions closed since the last run (trap T1),
    and unseen entities with old timestamps (trap T2).
    """
    p = previous.select(F.col("sk").alias("_psk"), F.col("valid_to").alias("_pvt"))
    cond = (F.col("sk") == F.col("_psk")) & F.col("valid_to").eqNullSafe(F.col("_pvt"))
    return base.join(p, cond, "left_anti")


def surrogate_keys(history: DataFrame, id_col: str = "id", sk_map_df: DataFrame | None = None,
                   mapping: DataFrame | None = None, previous: DataFrame | None = None, few: bool = False) -> DataFrame:
    """S3: normalise (S2) -> canonicalise (C7) -> master_sk.

    * full refresh (no ``previous``, no ``sk_map_df``): master_sk = first
      version's sk per canonical id (E1) over ``history`` (``few``: a handful of versions each);
    * rows of a run (no ``previous``, ``sk_map_df`` given): ``history`` holds
      only the versions a run touched; master_sk comes from the key map (C8);
    * upsert (``previous`` given): only versions whose (sk, valid_to) changed
      are processed and upserted into ``previous`` on ``sk``.
    """
    base = normalise_history(history, id_col)
    if previous is None:
        resolved = canonicalise(base, "source_id", mapping)
        return master_sk_window(resolved, few=few) if sk_map_df is None else assign_master_sk(resolved, sk_map_df)
    from kairos.sources.sinks import upsert

    batch = canonicalise(_changed_versions(base, previous), "source_id", mapping)
    if sk_map_df is not None:
        batch = assign_master_sk(batch, sk_map_df)
    else:
        batch = master_sk_window(batch)
    return upsert(previous, batch.select(*previous.columns), ["sk"])
