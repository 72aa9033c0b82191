"""History operators.

S1 scd2_snapshot      - SCD-2 snapshot, timestamp strategy, one load at a time
   scd2_from_loads    - the same result for a whole archive of loads, in one pass
S2 normalise_history  - sk / source_id / valid_from / valid_to / is_current view
S5 scd2_from_changes  - SCD-2 from a change log, value-based change detection
S6 scd6               - current attribute copied on every historical row
A16 apply_changes     - CDC insert/update/delete rows applied to a target
A19 scd1              - overwrite current row (upsert on key)
E2 dedup_latest       - latest row per key (QUALIFY row_number() = 1)
B8/B9/B10/B11         - incremental and lookback filters
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kairos.functions.scalars import as_of as _as_of
from kairos.functions.scalars import packed_key, shift_days, unpacked_key, version_sk
from kairos.operators.sequence import latest_per_key, time_slice

SCD_ID = "scd_id"
SCD_UPDATED_AT = "scd_updated_at"
VALID_FROM = "scd_valid_from"
VALID_TO = "scd_valid_to"
SCD_COLS = [SCD_ID, SCD_UPDATED_AT, VALID_FROM, VALID_TO]


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Keep the latest row per key (greatest ``order``; ties by the other columns)."""
    return latest_per_key(df, keys, order, keep="last")


def _version_rows(df: DataFrame, key: str, updated_at: str) -> DataFrame:
    return df.select(*df.columns,
                     version_sk(key, updated_at).alias(SCD_ID),
                     F.col(updated_at).alias(SCD_UPDATED_AT),
                     F.col(updated_at).alias(VALID_FROM),
                     F.lit(None).cast("timestamp_ntz").alias(VALID_TO))


def scd2_snapshot(history: DataFrame | None, incoming: DataFrame, key: str,
                  updated_at: str = "updated_at", *, invalidate_hard_deletes: bool = False,
                  as_of=None, lookback_filtered: bool = False) -> DataFrame:
    """Apply one full-replace load to an SCD-2 history (timestamp strategy).

    unseen key -> insert; newer ``updated_at`` -> close open version at the new
    ``updated_at`` and insert; equal/older -> keep; key missing from the load ->
    stays open (or is closed at ``as_of`` with ``invalidate_hard_deletes``).

    Plan: one full outer join of open versions with the de-duplicated load on
    ``key``; each joined row emits up to two rows through one ``inline``.
    """
    if invalidate_hard_deletes and lookback_filtered:
        # A lookback-filtered load would mark every unseen row as deleted.
        raise ValueError("lookback filter cannot be combined with invalidate_hard_deletes")
    data_cols = [c for c in incoming.columns if c not in SCD_COLS]
    inc = latest_per_key(incoming.select(*data_cols), [key], [updated_at])
    new_rows = _version_rows(inc.select(*data_cols), key, updated_at)
    if history is None:
        return new_rows
    cols = data_cols + SCD_COLS
    hist = history.select(*cols)
    open_ = hist.where(F.col(VALID_TO).isNull())
    closed = hist.where(F.col(VALID_TO).isNotNull())

    h = open_.select(F.col(key).alias("_k"), F.struct(*cols).alias("_h"))
    n = new_rows.select(F.col(key).alias("_k"), F.struct(*[F.col(c) for c in cols]).alias("_n"))
    j = h.join(n, "_k", "full_outer")
    newer = F.col("_n").isNotNull() & (F.col("_h").isNull()
                                       | (F.col(f"_n.{SCD_UPDATED_AT}") > F.col(f"_h.{SCD_UPDATED_AT}")))
    close_at = F.when(F.col("_n").isNotNull() & newer, F.col(f"_n.{SCD_UPDATED_AT}"))
    if invalidate_hard_deletes:
        close_at = close_at.when(F.col("_n").isNull(), _as_of(as_of))
    kept = F.when(F.col("_h").isNotNull(),
                  F.col("_h").withField(VALID_TO, F.coalesce(close_at, F.col(f"_h.{VALID_TO}"))))
    added = F.when(newer, F.col("_n"))
    out = (j.select(F.explode(F.array(kept, added)).alias("_r"))
           .where(F.col("_r").isNotNull()).select("_r.*"))
    return closed.unionByName(out)


def scd2_changes(open_rows: DataFrame | None, incoming: DataFrame, key: str,
                 updated_at: str = "updated_at") -> DataFrame:
    """S1 as changes only: the versions that one load opens and closes (``_kind``).

    ``open_rows`` holds at most one open version per key.  Keys that the load doesn't
    change give no row, so what a run writes follows the changes, not the entities.
    """
    data_cols = [c for c in incoming.columns if c not in SCD_COLS]
    inc = latest_per_key(incoming.select(*data_cols), [key], [updated_at])
    new_rows = _version_rows(inc.select(*data_cols), key, updated_at)
    cols = data_cols + SCD_COLS
    if open_rows is None:
        return new_rows.select(*cols, F.lit("opened").alias("_kind"))
    # flat columns, the version's id packed: what a new row's id is made of crosses the join once, an open row has no end
    held = {c: f"_h{i}" for i, c in enumerate(cols) if c not in (key, VALID_TO)}
    as_text = open_rows.schema[SCD_ID].dataType.typeName() == "string"
    h = open_rows.select(F.col(key).alias("_hk"), *[(packed_key(c) if c == SCD_ID and as_text else F.col(c)).alias(a) for c, a in held.items()])
    j = (inc.select(*data_cols).join(h, F.col(key) == F.col("_hk"), "left")
         .where(F.col("_hk").isNull() | (F.col(updated_at) > F.col(held[SCD_UPDATED_AT]))))
    added = _version_rows(j, key, updated_at).select(F.struct(*cols).alias("_n"), "_hk", *held.values())
    old = [F.col(f"_n.{key}") if c == key else F.col(f"_n.{SCD_UPDATED_AT}") if c == VALID_TO
           else unpacked_key(held[c]) if c == SCD_ID and as_text else F.col(held[c]) for c in cols]
    opened = F.struct(F.col("_n").alias("r"), F.lit("opened").alias("_kind"))
    closed = F.when(F.col("_hk").isNotNull(), F.struct(F.struct(*[x.alias(c) for x, c in zip(old, cols)]).alias("r"), F.lit("closed").alias("_kind")))
    return (added.select(F.explode(F.array(opened, closed)).alias("_c")).where("_c is not null")
            .select("_c.r.*", "_c._kind"))


def scd2_from_loads(changes: DataFrame, key: str, updated_at: str = "updated_at",
                    load_col: str = "_load", few: bool = False) -> DataFrame:
    """Replay of S1 over every load in ``load_col`` order, computed in one pass.

    Each load contributes its latest row per key; a row opens a version when its
    ``updated_at`` is newer than everything the key showed in earlier loads;
    the version closes at the next version's ``updated_at``.  The per-key
    window runs after reducing to one row per (key, load), so even a hot key
    has at most one row per load there.  ``few`` says that a key has a handful of
    rows in all: they go to their key's task at once, one exchange for both steps.
    """
    data_cols = [c for c in changes.columns if c != load_col]
    if few:
        changes = changes.repartition(key)
    per_load = latest_per_key(changes, [key, load_col], [updated_at])
    w = Window.partitionBy(key).orderBy(load_col)
    prev_max = F.max(updated_at).over(w.rowsBetween(Window.unboundedPreceding, -1))
    kept = (per_load.withColumn("_prev_max", prev_max)
            .where(F.col("_prev_max").isNull() | (F.col(updated_at) > F.col("_prev_max"))))
    return (_version_rows(kept.select(*data_cols, load_col), key, updated_at)
            .withColumn(VALID_TO, F.lead(updated_at).over(w))
            .select(*data_cols, *SCD_COLS))


def normalise_history(history: DataFrame, id_col: str = "id") -> DataFrame:
    """Sk, source_id, valid_from, valid_to, is_current, then the other columns."""
    rest = [c for c in history.columns if c not in SCD_COLS and c != id_col]
    return history.select(F.col(SCD_ID).alias("sk"), F.col(id_col).alias("source_id"),
                          F.col(VALID_FROM).alias("valid_from"), F.col(VALID_TO).alias("valid_to"),
                          F.col(VALID_TO).isNull().alias("is_current"), *rest)


def scd2_from_changes(changes: DataFrame, key: str, ts: str, attrs: Sequence[str],
                      slice_unit: str | None = "month") -> DataFrame:
    """SCD-2 intervals from a change log in one pass.

    Rows of a key at the same ``ts`` are one change: the greatest by the remaining
    columns counts, so no version is empty and input order doesn't matter.  Rows
    whose ``attrs`` equal the previous row's are dropped (no change); the remaining
    rows get ``valid_from = ts`` and ``valid_to`` = next kept row's ts.  Keys are
    windowed per ``slice_unit`` slice (None: whole keys); only a slice's first and last
    kept row meet those of the key's other slices.
    """
    names = list(changes.columns)
    others = [F.col(c) for c in names if c not in (key, ts)]
    sliced = changes.withColumn("_slice", F.lit(0) if slice_unit is None else time_slice(ts, slice_unit))
    attr = F.struct(*[F.col(c) for c in attrs])
    # the same partitioning and order throughout: one exchange and one sort for all three steps
    w = Window.partitionBy(key, "_slice").orderBy(ts, *others)
    lone = (sliced.withColumn("_next", F.lead(F.struct(ts)).over(w))
            .where(F.col("_next").isNull() | ~F.col(f"_next.{ts}").eqNullSafe(F.col(ts))))
    moved = lone.withColumn("_p", F.lag(attr).over(w)).where(F.col("_p").isNull() | ~attr.eqNullSafe(F.col("_p")))
    kept = moved.withColumn("_first", F.col("_p").isNull()).withColumn("_n", F.lead(ts).over(w))
    if slice_unit is None:
        done = kept.withColumn("valid_to", F.col("_n"))
    else:
        inner = kept.where("not _first and _n is not null").withColumn("valid_to", F.col("_n"))
        # at most two rows of a key and slice; latest first, so that what follows a row comes before it
        wk = Window.partitionBy(key).orderBy(F.col(ts).desc())
        ends = (kept.where("_first or _n is null")
                .withColumn("_before", F.lead(attr).over(wk))
                .withColumn("_real", ~F.col("_first") | F.col("_before").isNull() | ~attr.eqNullSafe(F.col("_before")))
                .withColumn("_start", F.when(F.col("_real"), F.col(ts)).otherwise(F.col("_n")))
                .withColumn("valid_to", F.coalesce("_n", F.last("_start", ignorenulls=True).over(
                    wk.rowsBetween(Window.unboundedPreceding, -1))))
                .where("_real"))
        done = inner.unionByName(ends.select(*inner.columns))
    return (done.select(*names, F.col(ts).alias("valid_from"), "valid_to")
            .withColumn("is_current", F.col("valid_to").isNull()))


def scd6(history: DataFrame, key: str, attrs: Sequence[str], order: str = "valid_from",
         current_flag: str = "is_current") -> DataFrame:
    """Add ``current_<attr>`` = the attribute of the key's current version.

    The current row per key is picked by aggregate (map-side partial) and joined
    back, instead of a full-frame window that would gather a hot key in one task.
    """
    cur = latest_per_key(history.where(F.col(current_flag)).select(key, order, *attrs), [key], [order])
    cur = cur.select(key, *[F.col(a).alias(f"current_{a}") for a in attrs])
    return history.join(cur, key, "left")


def apply_changes(target: DataFrame | None, changes: DataFrame, keys: Sequence[str], seq: str,
                  op: str = "op", delete_value: str = "D") -> DataFrame:
    """Apply CDC rows: latest change per key wins; a delete removes the key.

    ``target`` rows whose key has no change are kept untouched, and so are rows whose
    ``seq`` is greater than the change's (a change that arrives late doesn't undo a newer one).
    ``target`` doesn't remember deleted keys, so batches must come in order of ``seq``: a late change older than
    a delete would bring its key back.  ``sources.changes`` keeps tombstones and takes batches in any order.
    """
    keys = list(keys)
    latest = dedup_latest(changes, keys, [seq])
    if target is None:
        return latest.where(F.col(op) != delete_value).drop(op)
    # a change older than the target's row of its key arrived late: the row stays
    held = target.select(*keys, F.col(seq).alias("_held"))
    latest = latest.join(held, keys, "left").where(F.col("_held").isNull() | (F.col(seq) >= F.col("_held"))).drop("_held")
    touched = latest.select(*keys)
    upserts = latest.where(F.col(op) != delete_value)
    return target.join(touched, keys, "left_anti").unionByName(upserts.select(*target.columns))


def scd1(target: DataFrame | None, batch: DataFrame, keys: Sequence[str],
         order: Sequence | None = None) -> DataFrame:
    """Overwrite the current row of each key with the batch row (upsert)."""
    from kairos.sources.sinks import upsert

    if order:
        batch = dedup_latest(batch, keys, order)
    return batch if target is None else upsert(target, batch, keys)


# --- incremental filters --------------------------------------------------

def newer_than(src: DataFrame, target: DataFrame | None, col: str, target_col: str | None = None) -> DataFrame:
    """``src.col > (SELECT MAX(target_col) FROM target)``; everything on first run.

    Written as a scalar subquery: computed once, no join with the source.
    """
    if target is None:
        return src
    mx = target.agg(F.max(target_col or col)).scalar()
    return src.where(mx.isNull() | (F.col(col) > mx))


def lookback_filter(src: DataFrame, history_exists: bool, col: str = "updated_at",
                    as_of=None, days: int = 7, invalidate_hard_deletes: bool = False) -> DataFrame:
    """Keep rows with ``col >= date(as_of) - days`` when history already exists."""
    if invalidate_hard_deletes:
        raise ValueError("lookback filter cannot be used with invalidate_hard_deletes=True")
    if not history_exists:
        return src
    start = F.date_sub(F.to_date(_as_of(as_of)), days).cast("timestamp_ntz")
    return src.where(F.col(col) >= start)


def lookback_from_max(src: DataFrame, target: DataFrame | None, col: str, days: int = 3,
                      target_col: str | None = None) -> DataFrame:
    """``src.col > MAX(target_col) - days`` (re-read a margin for late rows)."""
    if target is None:
        return src
    mx = target.agg(shift_days(F.max(target_col or col), -days)).scalar()
    return src.where(mx.isNull() | (F.col(col) > mx))


def current(df: DataFrame, flag: str = "is_current") -> DataFrame:
    """Keep current versions only."""
    return df.where(F.col(flag))


__all__ = [
    "SCD_COLS", "SCD_ID", "SCD_UPDATED_AT", "VALID_FROM", "VALID_TO", "apply_changes", "current",
    "dedup_latest", "lookback_filter", "lookback_from_max", "newer_than", "normalise_history",
    "scd1", "scd2_changes", "scd2_from_changes", "scd2_from_loads", "scd2_snapshot", "scd6",
]

