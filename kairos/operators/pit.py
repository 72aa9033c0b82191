"""Point-in-time joins and FK enrichment.

C2 pit_join          - version valid at the event time (half-open interval)
C3/C4/C5 fk_enrich   - PIT, then current-version fallback, then key-map lookup
C6 chained enrichment- ``df.transform(fk_enrich(...))`` twice
C11 scd_between_join - the documented closed-interval variant (double-matches!), linear as well
C12 pit_features     - feature rows valid at the event time, with their age

Physical strategies, same result on a well-formed history (versions of a
key do not overlap).  The caller names one:

``strategy="join"``  equi-join on the key with a range residual.  Cost per key is
                     facts x versions: for histories with few versions a key
                     (orders, products).  AQE splits a skewed key.
``strategy="asof"``  (default) facts and versions are unioned and a running
                     ``last(version, ignorenulls)`` is taken, so work is linear in
                     both: for histories with any number of versions a key.
                     ``slice_unit`` cuts every key into time slices, so that a
                     hot key is many tasks; a carry table with one row per key
                     and slice brings the version active at a slice's start and
                     the current version.  ``slice_unit=None`` makes one group of
                     a key (one shuffle less) where no key is hot.
``strategy="merge"`` (``fk_enrich``) ``asof`` with whole keys, for few versions a key as
                     ``join``: facts, versions and key map meet in one exchange, the
                     history is read once, and links that nobody reads cost nothing.
                     A version without a start covers nothing, as in ``join``.

Text keys cross the shuffles of ``asof`` and ``merge`` packed (``packed_key``).

Facts without a key match nothing; they pass by the joins, or the window in groups of
their own, so that they don't gather in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kairos.functions.scalars import packed_key, unpacked_key
from kairos.operators.sequence import time_slice


#: groups over which facts without a key are spread
KEYLESS_GROUPS = 4096


def _is_text(t) -> bool:
    return t.typeName() == "string"


def _facts_of(facts: DataFrame) -> list:
    """The columns of ``facts`` as ``_asof`` gives them back."""
    return [(unpacked_key(f"_f{i}") if _is_text(f.dataType) else F.col(f"_f{i}")).alias(f.name) for i, f in enumerate(facts.schema.fields)]


def _asof(facts: DataFrame, fk: str, t: str, history: DataFrame, id_col: str, take: list[str], slice_unit: str | None,
          valid_from: str = "valid_from", valid_to: str = "valid_to", sk_map: DataFrame | None = None,
          started: bool = False, packed: bool = False, keyless: bool = False) -> DataFrame:
    """(_f0.., _k, _t, _pit, _cur, _cand, _mapped): each fact with a key (its columns by ``_facts_of``, its key), its version valid at ``t``,
    its key's open version, the last version that starts at or before ``t`` and the master_sk of ``sk_map`` (one row a key).

    Facts are flat columns, so that those nobody reads don't travel; what is the key or the time travels once.  Where nobody
    reads a version, facts pass without an exchange.  ``started``: a version without a start is never valid.
    ``packed`` leaves the versions' texts and the map's as ``packed_key``.  ``keyless`` gives facts without a key as well, without a version.
    """
    if not keyless:
        facts = facts.where(F.col(fk).isNotNull())
    key_type = facts.schema[fk].dataType
    text = [c for c in take if _is_text(history.schema[c].dataType)]
    ver = F.struct(*[(packed_key(c) if c in text else F.col(c)).alias(c) for c in take],
                   F.col(valid_from).cast("timestamp_ntz").alias("_vf"), F.col(valid_to).cast("timestamp_ntz").alias("_vt"))
    ver_type = history.select(ver.alias("v")).schema["v"].dataType
    same = {} if _is_text(key_type) else {fk: "_k"}
    if facts.schema[t].dataType.typeName() == "timestamp_ntz":
        same.setdefault(t, "_t")
    carried = [(f"_f{i}", f) for i, f in enumerate(facts.schema.fields) if f.name not in same]
    fields = [(packed_key(f.name) if _is_text(f.dataType) else F.col(f.name)).alias(a) for a, f in carried]
    no_fact = [F.lit(None).cast("binary" if _is_text(f.dataType) else f.dataType).alias(a) for a, f in carried]
    no_time, no_ver, no_key = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast(ver_type), F.lit(None).cast("binary")
    # facts without a key meet no version; spread over groups of their own they don't gather in one task
    spread = F.when(F.col(fk).isNull(), F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.lit(KEYLESS_GROUPS)).cast("int")).otherwise(0)
    # what is the same in most rows stands together: it takes next to nothing in a shuffle's blocks
    f = facts.select(F.lit(1).alias("_kind"), spread.alias("_n"), no_ver.alias("_v"), no_key.alias("_m"),
                     F.col(fk).alias("_k"), F.col(t).cast("timestamp_ntz").alias("_t"), *fields)
    v = (history.where(F.col(id_col).isNotNull())
         .select(F.col(id_col).cast(key_type).alias("_k"), F.lit(0).alias("_n"), F.col(valid_from).cast("timestamp_ntz").alias("_t"),
                 F.lit(0).alias("_kind"), *no_fact, ver.alias("_v"), no_key.alias("_m")))
    m = None
    if sk_map is not None:
        m = sk_map.select(F.col("canonical_id").cast(key_type).alias("_k"), packed_key("master_sk").alias("_m")).where("_k is not null")
    order = ["_t", "_kind"]
    if slice_unit is None:
        w = Window.partitionBy("_k", "_n").orderBy(*order)
        if m is not None:  # without a time and of the least kind: before all that its key has
            v = v.unionByName(m.select("_k", F.lit(0).alias("_n"), no_time.alias("_t"), F.lit(-1).alias("_kind"), *no_fact, no_ver.alias("_v"), "_m"))
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = (f.unionByName(v)
               .withColumn("_cand", F.last("_v", ignorenulls=True).over(so_far))
               .withColumn("_mapped", F.last("_m", ignorenulls=True).over(so_far))
               .withColumn("_latest", F.last("_v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
               .where("_kind = 1"))
    else:
        sl = time_slice("_t", slice_unit)
        f, v = f.withColumn("_slice", sl), v.withColumn("_slice", sl)
        # 1) one row per key and slice that holds facts or versions: the last version before it, the key's latest and its map entry
        last_v = v.groupBy("_k", "_slice").agg(F.max_by("_v", "_t").alias("_last"), F.lit(1).alias("_isv"), no_key.alias("_m"))
        asked = f.where("_k is not null").groupBy("_k", "_slice").agg(no_ver.alias("_last"), F.lit(0).alias("_isv"), no_key.alias("_m"))
        wk = Window.partitionBy("_k").orderBy("_slice", "_isv")
        rows = last_v.unionByName(asked)
        if m is not None:
            rows = rows.unionByName(m.select("_k", no_time.alias("_slice"), no_ver.alias("_last"), F.lit(-1).alias("_isv"), "_m"))
        carry = (rows.withColumn("_start", F.last("_last", ignorenulls=True).over(wk.rowsBetween(Window.unboundedPreceding, -1)))
                 .withColumn("_mapped", F.last("_m", ignorenulls=True).over(wk.rowsBetween(Window.unboundedPreceding, -1)))
                 .withColumn("_latest", F.last("_last", ignorenulls=True).over(wk.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
                 .where("_isv = 0"))
        # 2) the running last version inside each (key, slice), from what its carry row brings
        w = Window.partitionBy("_k", "_n", "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        starts = carry.select("_k", F.lit(0).alias("_n"), no_time.alias("_t"), F.lit(-1).alias("_kind"), *no_fact,
                              F.col("_start").alias("_v"), F.col("_mapped").alias("_m"), "_slice", F.col("_latest").alias("_l"))
        out = (f.unionByName(v).select(no_ver.alias("_l"), "*").unionByName(starts)
               .withColumn("_cand", F.last("_v", ignorenulls=True).over(w))
               .withColumn("_mapped", F.last("_m", ignorenulls=True).over(w))
               .withColumn("_latest", F.last("_l", ignorenulls=True).over(w))
               .where("_kind = 1"))
    valid = F.col("_t").isNotNull() & (F.col("_cand._vt").isNull() | (F.col("_t") < F.col("_cand._vt")))
    if started:
        valid = valid & F.col("_cand._vf").isNotNull()

    def ver_of(c: str):
        plain = [(unpacked_key(F.col(c)[x]) if x in text and not packed else F.col(c)[x]).alias(x) for x in [*take, "_vf", "_vt"]]
        return F.when(F.col(c).isNotNull(), F.struct(*plain))

    cand, latest = ver_of("_cand"), ver_of("_latest")
    return out.select(*[F.col(same.get(c, f"_f{i}")).alias(f"_f{i}") for i, c in enumerate(facts.columns)], "_k", "_t", F.when(valid, cand).alias("_pit"),
                      F.when(F.col("_latest._vt").isNull(), latest).alias("_cur"), cand.alias("_cand"),
                      (F.col("_mapped") if packed else unpacked_key("_mapped")).alias("_mapped"))


def pit_join(facts: DataFrame, history: DataFrame, fk: str, t: str, id_col: str,
             take=("sk", "master_sk"), prefix: str = "pit_", how: str = "left",
             valid_from: str = "valid_from", valid_to: str = "valid_to",
             strategy: str = "asof", slice_unit: str | None = "month") -> DataFrame:
    """Each fact with the version for which ``valid_from <= t < valid_to`` (open end NULL).

    ``how``: left keeps facts without a version (NULLs), inner drops them."""
    take = list(take)
    if strategy == "join":
        h = history.select(F.col(id_col).alias("_hk"), F.col(valid_from).alias("_vf"),
                           F.col(valid_to).alias("_vt"), *[F.col(c).alias(prefix + c) for c in take])
        cond = ((F.col(fk) == F.col("_hk")) & (F.col(t) >= F.col("_vf"))
                & (F.col("_vt").isNull() | (F.col(t) < F.col("_vt"))))
        return facts.join(h, cond, how).drop("_hk", "_vf", "_vt")
    if strategy != "asof" or how not in ("left", "inner"):
        raise ValueError(f"unknown strategy {strategy!r} or join {how!r}")
    out = _asof(facts, fk, t, history, id_col, take, slice_unit, valid_from, valid_to, keyless=True)
    if how == "inner":
        out = out.where("_pit is not null")
    return out.select(*_facts_of(facts), *[F.col(f"_pit.{c}").alias(prefix + c) for c in take])


def pit_features(facts: DataFrame, features: DataFrame, fk: str, t: str, id_col: str, take,
                 prefix: str = "feat_", **options) -> DataFrame:
    """The feature row valid at the event time, plus ``{prefix}age_days`` since it became valid.

    ``features`` has ``valid_from`` / ``valid_to`` per key; a fact before the first row gets NULLs, never a later value.
    """
    from kairos.functions.scalars import day_diff

    out = pit_join(facts, features, fk, t, id_col, take=[*take, "valid_from"], prefix=prefix, **options)
    return out.withColumn(f"{prefix}age_days", day_diff(F.col(f"{prefix}valid_from"), F.col(t))).drop(f"{prefix}valid_from")


def scd_between_join(facts: DataFrame, history: DataFrame, fk: str, t: str, id_col: str,
                     take=("sk",), prefix: str = "scd_", today=None,
                     valid_from: str = "valid_from", valid_to: str = "valid_to",
                     strategy: str = "asof", slice_unit: str | None = "month") -> DataFrame:
    """C11: ``t BETWEEN valid_from AND COALESCE(valid_to, today)`` (closed; a fact at a
    version boundary matches two versions -- kept as documented, prefer C2).

    ``strategy="asof"`` is linear in facts and versions: the last version that starts at or before ``t``, and the one
    before it where that ends just at ``t``.  It expects versions of a key that don't overlap, and splits hot keys by
    ``slice_unit``.  ``strategy="join"`` compares every fact with every version of its key, on any history.
    """
    from kairos.functions.scalars import as_of
    from kairos.operators.sequence import with_neighbours

    take = list(take)
    if strategy == "join":
        h = history.select(F.col(id_col).alias("_hk"), F.col(valid_from).alias("_vf"),
                           F.coalesce(F.col(valid_to), as_of(today)).alias("_vt"),
                           *[F.col(c).alias(prefix + c) for c in take])
        cond = (F.col(fk) == F.col("_hk")) & F.col(t).between(F.col("_vf"), F.col("_vt"))
        return facts.join(h, cond, "left").drop("_hk", "_vf", "_vt")
    if strategy != "asof":
        raise ValueError(f"unknown strategy {strategy!r}")
    rows = history.where(F.col(id_col).isNotNull()).select(id_col, valid_from, valid_to, *[c for c in take if c not in (id_col, valid_from, valid_to)])
    rows = with_neighbours(rows, [id_col], [valid_from], [valid_to, *[c for c in take if c != valid_to]], slice_unit, prev_name="_prev", next_name="_n").drop("_n")
    out = _asof(facts, fk, t, rows, id_col, [*take, "_prev"], slice_unit, valid_from, valid_to, keyless=True)
    at, cand = F.col("_t"), F.col("_cand")
    fields = [cand[c].alias(prefix + c) for c in take]
    here = F.when(cand["_vf"].isNotNull() & (at <= F.coalesce(cand["_vt"], as_of(today))), F.struct(*fields))
    before = F.when(cand["_prev"][valid_to] == at, F.struct(*[cand["_prev"][c].alias(prefix + c) for c in take]))
    met = F.filter(F.array(before, here), lambda x: x.isNotNull())
    return out.select(*_facts_of(facts), F.explode_outer(met).alias("_m")).select(*facts.columns, "_m.*")


def _fk_enrich_join(facts, fk, t, entity, id_col, prefix, sk_map, mark):
    pit = entity.select(F.col(id_col).alias("_pk"), F.col("valid_from").alias("_pvf"),
                        F.col("valid_to").alias("_pvt"), F.col("sk").alias("_psk"),
                        F.col("master_sk").alias("_pmsk"))
    cur = entity.where(F.col("is_current")).select(F.col(id_col).alias("_ck"), F.col("sk").alias("_csk"),
                                                    F.col("master_sk").alias("_cmsk"))
    out = facts.join(pit, (F.col(fk) == F.col("_pk")) & (F.col(t) >= F.col("_pvf"))
                     & (F.col("_pvt").isNull() | (F.col(t) < F.col("_pvt"))), "left")
    out = out.join(cur, F.col("_psk").isNull() & (F.col(fk) == F.col("_ck")), "left")
    masters = [F.col("_pmsk"), F.col("_cmsk")]
    if sk_map is not None:
        out = out.join(sk_map.select(F.col("canonical_id").alias("_mk"), F.col("master_sk").alias("_mmsk")),
                       F.col(fk) == F.col("_mk"), "left")
        masters.append(F.col("_mmsk"))
    return out.select(*[F.col(c) for c in facts.columns],
                      F.coalesce(F.col("_psk"), F.col("_csk")).alias(f"{prefix}_sk"),
                      F.coalesce(*masters).alias(f"{prefix}_master_sk"),
                      *([F.col("_psk").isNotNull().alias(mark)] if mark else []))


def _fk_enrich_asof(facts, fk, t, entity, id_col, prefix, sk_map, slice_unit, mark, started=False, packed=False):
    out = _asof(facts, fk, t, entity, id_col, ["sk", "master_sk"], slice_unit, sk_map=sk_map, started=started, packed=True, keyless=True)
    open_ = F.col("_pit").isNull()
    links = [F.coalesce("_pit.sk", F.when(open_, F.col("_cur.sk"))), F.coalesce("_pit.master_sk", F.when(open_, F.col("_cur.master_sk")), "_mapped")]
    return out.select(*_facts_of(facts), *[(c if packed else unpacked_key(c)).alias(f"{prefix}_{n}") for c, n in zip(links, ("sk", "master_sk"))],
                      *([(F.col("_pit").isNotNull() | F.col("_k").isNull()).alias(mark)] if mark else []))


def fk_enrich(facts: DataFrame, fk: str, t: str, entity: DataFrame, id_col: str, prefix: str,
              sk_map: DataFrame | None = None, strategy: str = "asof", slice_unit: str | None = "month",
              mark: str | None = None, packed: bool = False) -> DataFrame:
    """Add ``{prefix}_sk`` (version valid at ``t``, else the current version)
    and ``{prefix}_master_sk`` (from that version, else the key map).

    ``mark`` names a further column: whether the version is one valid at ``t`` (true
    where the key is null: no version can change that).  ``packed`` gives both keys as
    ``packed_key``, for a further shuffle."""
    if strategy not in ("join", "asof", "merge"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy != "join":
        merge = strategy == "merge"
        return _fk_enrich_asof(facts, fk, t, entity, id_col, prefix, sk_map, None if merge else slice_unit, mark, merge, packed)
    out = _fk_enrich_join(facts.where(F.col(fk).isNotNull()), fk, t, entity, id_col, prefix, sk_map, mark)
    if packed:
        out = out.withColumns({c: packed_key(c) for c in (f"{prefix}_sk", f"{prefix}_master_sk")})
    none = [F.lit(None).cast(out.schema[f"{prefix}_{c}"].dataType).alias(f"{prefix}_{c}") for c in ("sk", "master_sk")]
    return out.unionByName(facts.where(F.col(fk).isNull()).select("*", *none, *([F.lit(True).alias(mark)] if mark else [])))
