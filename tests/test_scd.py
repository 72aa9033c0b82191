import datetime as dt
import random

import pytest
from conftest import rows, ts
from pyspark.sql import Window
from pyspark.sql import functions as F

from kairos.operators import scd

SCHEMA = "id long, name string, updated_at timestamp_ntz"


def _df(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_first_run_opens_every_key(spark):
    h = scd.scd2_snapshot(None, _df(spark, [(1, "a", ts("2024-01-01")), (2, "b", ts("2024-01-02"))]), "id")
    out = rows(h, "id", "scd_valid_from", "scd_valid_to")
    assert out == [(1, ts("2024-01-01"), None), (2, ts("2024-01-02"), None)]


def test_change_keep_older_missing_new(spark):
    h0 = scd.scd2_snapshot(None, _df(spark, [(1, "a", ts("2024-01-01")), (2, "b", ts("2024-01-01")),
                                             (3, "c", ts("2024-01-05")), (4, "d", ts("2024-01-01"))]), "id")
    batch = _df(spark, [(1, "a2", ts("2024-01-03")),   # newer -> close + open
                        (2, "b", ts("2024-01-01")),    # same -> keep
                        (3, "c0", ts("2024-01-02")),   # older -> keep
                        (5, "e", ts("2024-01-01"))])   # new -> insert; 4 missing -> stays open
    h1 = scd.scd2_snapshot(h0, batch, "id")
    out = rows(h1, "id", "name", "scd_valid_from", "scd_valid_to")
    assert out == [
        (1, "a", ts("2024-01-01"), ts("2024-01-03")),
        (1, "a2", ts("2024-01-03"), None),
        (2, "b", ts("2024-01-01"), None),
        (3, "c", ts("2024-01-05"), None),
        (4, "d", ts("2024-01-01"), None),
        (5, "e", ts("2024-01-01"), None),
    ]


def test_same_batch_twice_is_idempotent(spark):
    b = _df(spark, [(1, "a", ts("2024-01-01")), (2, "b", ts("2024-01-02"))])
    h1 = scd.scd2_snapshot(None, b, "id")
    h2 = scd.scd2_snapshot(h1, b, "id")
    assert rows(h1) == rows(h2)


def test_hard_delete_and_lookback_guard(spark):
    h0 = scd.scd2_snapshot(None, _df(spark, [(1, "a", ts("2024-01-01")), (2, "b", ts("2024-01-01"))]), "id")
    h1 = scd.scd2_snapshot(h0, _df(spark, [(1, "a", ts("2024-01-01"))]), "id",
                           invalidate_hard_deletes=True, as_of="2024-01-10 00:00:00")
    assert rows(h1, "id", "scd_valid_to") == [(1, None), (2, ts("2024-01-10"))]
    with pytest.raises(ValueError):
        scd.scd2_snapshot(h0, h0.drop(*scd.SCD_COLS), "id", invalidate_hard_deletes=True, lookback_filtered=True)
    with pytest.raises(ValueError):
        scd.lookback_filter(h0, True, invalidate_hard_deletes=True)


def test_replay_equals_step_by_step(spark):
    data = [(1, "a", ts("2024-01-01 10:00"), 1), (1, "b", ts("2024-01-01 12:00"), 1),
            (1, "c", ts("2024-01-03 09:00"), 2), (2, "x", ts("2024-01-02 00:00"), 2),
            (2, "y", ts("2023-12-30 00:00"), 3),  # late, older: ignored
            (3, "z", ts("2024-01-04 00:00"), 3), (1, "d", ts("2024-01-05 00:00"), 3)]
    ch = spark.createDataFrame(data, SCHEMA + ", _load int")
    one_pass = scd.scd2_from_loads(ch, "id", "updated_at", "_load")
    h = None
    for load in (1, 2, 3):
        # full-replace table at this load: every key's row from its latest load
        latest = (ch.where(F.col("_load") <= load)
                  .withColumn("_m", F.max("_load").over(Window.partitionBy("id")))
                  .where(F.col("_load") == F.col("_m")).drop("_load", "_m"))
        h = scd.scd2_snapshot(h, latest, "id")
    assert rows(one_pass) == rows(h)


def test_lookback_boundaries(spark):
    src = _df(spark, [(1, "a", ts("2024-01-03 00:00:00")), (2, "b", ts("2024-01-02 23:59:59"))])
    kept = scd.lookback_filter(src, True, "updated_at", "2024-01-10 08:00:00", 7)
    assert rows(kept, "id") == [(1,)]
    assert rows(scd.lookback_filter(src, False, "updated_at", "2024-01-10 08:00:00", 7), "id") == [(1,), (2,)]


def test_scd2_from_changes_slices_agree(spark):
    data = []
    for i in range(200):  # key 1 is hot and spans several months
        data.append((i, 1, ts("2024-01-01") + dt.timedelta(days=i), ["a", "a", "b"][i % 3]))
    data += [(1000, 2, ts("2024-02-01"), "a"), (1001, 2, ts("2024-02-02"), "a")]
    df = spark.createDataFrame(data, "eid long, key long, t timestamp_ntz, s string")
    sliced = scd.scd2_from_changes(df, "key", "t", ["s"], slice_unit="month")  # key 1 spans slices
    plain = scd.scd2_from_changes(df, "key", "t", ["s"], slice_unit=None)
    assert rows(sliced) == rows(plain)
    assert sliced.count() == 1 + 2 * 66 + 1  # a,b alternations for key 1, one row for key 2


def test_scd2_from_changes_by_definition(spark):
    """Random changes with ties, null times and attributes, slices without a change: equal to a plain loop."""
    rng = random.Random(4)
    data = []
    for i in range(900):
        at = None if rng.random() < 0.01 else ts("2024-01-01") + dt.timedelta(hours=12 * rng.randrange(500))
        data.append((i, rng.choice([1, 1, 1, 2, 3, None]), at, rng.choice(["a", "a", "a", "a", "b", None])))
    df = spark.createDataFrame(data, "eid long, key long, t timestamp_ntz, s string")
    want = []
    for key in {r[1] for r in data}:
        one = {}
        for r in sorted((r for r in data if r[1] == key), key=lambda r: r[0]):
            one[r[2]] = r  # the greatest eid of a time
        kept = []
        for t in sorted(one, key=lambda t: t or dt.datetime.min):
            if not kept or kept[-1][3] != one[t][3]:
                kept.append(one[t])
        want += [(r[0], r[2], n[2] if n else None) for r, n in zip(kept, [*kept[1:], None])]
    for unit in ("month", "day", "year", None):
        got = scd.scd2_from_changes(df, "key", "t", ["s"], slice_unit=unit).select("eid", "valid_from", "valid_to").collect()
        assert sorted(got, key=lambda r: r.eid) == sorted(want, key=lambda r: r[0])


def test_scd2_from_changes_equal_times(spark):
    """Rows of a key at one time are one change, whatever their order in the input; no version is empty."""
    data = [(1, 1, ts("2024-01-01"), "a"), (2, 1, ts("2024-01-02"), "b"), (3, 1, ts("2024-01-02"), "c"), (4, 1, ts("2024-01-03"), "c")]
    schema = "eid long, key long, t timestamp_ntz, s string"
    out = [rows(scd.scd2_from_changes(spark.createDataFrame(d, schema).coalesce(1), "key", "t", ["s"]), "s", "valid_from", "valid_to")
           for d in (data, data[::-1])]
    assert out[0] == out[1] == [("a", ts("2024-01-01"), ts("2024-01-02")), ("c", ts("2024-01-02"), None)]


def test_late_change_does_not_undo_a_newer_row(spark):
    target = spark.createDataFrame([(1, "new", 9), (2, "old", 1)], "k long, v string, seq long")
    late = spark.createDataFrame([(1, "stale", 5, "U"), (2, "", 3, "D"), (3, "in", 1, "U")], "k long, v string, seq long, op string")
    assert rows(scd.apply_changes(target, late, ["k"], "seq"), "k", "v") == [(1, "new"), (3, "in")]


def test_dedup_latest_and_apply_changes(spark):
    df = spark.createDataFrame([("p1", 1.0, ts("2024-01-01")), ("p1", 2.0, ts("2024-01-02")),
                                ("p2", 3.0, ts("2024-01-01"))], "id string, amount double, _loaded_at timestamp_ntz")
    assert rows(scd.dedup_latest(df, ["id"], ["_loaded_at"]), "id", "amount") == [("p1", 2.0), ("p2", 3.0)]
    ch = spark.createDataFrame([(1, "x", 1, "U"), (1, "y", 2, "U"), (2, "z", 1, "U"), (2, "", 2, "D")],
                               "k long, v string, seq long, op string")
    assert rows(scd.apply_changes(None, ch, ["k"], "seq"), "k", "v") == [(1, "y")]


def test_scd6_current_attribute(spark):
    h = spark.createDataFrame([(1, "a", ts("2024-01-01"), False), (1, "b", ts("2024-01-02"), True)],
                              "k long, s string, valid_from timestamp_ntz, is_current boolean")
    assert rows(scd.scd6(h, "k", ["s"]), "s", "current_s") == [("a", "b"), ("b", "b")]


def test_orders_daily_run_lookback_and_missed_run(spark):
    """B9 in the daily run: changes within 7 days of as_of are applied; a change
    older than the lookback (a missed run, trap T16) is not."""
    from kairos.plans.models import orders_snapshot_incremental

    schema = "id long, status string, updated_at timestamp_ntz"
    day1 = spark.createDataFrame([(1, "placed", ts("2024-01-01")), (2, "placed", ts("2024-01-01"))], schema)
    h1 = orders_snapshot_incremental(None, day1, "2024-01-01 06:00:00")
    later = spark.createDataFrame([(1, "shipped", ts("2024-01-18")),   # inside 7 days of as_of
                                   (2, "shipped", ts("2024-01-05"))],  # outside: lost
                                  schema)
    h2 = orders_snapshot_incremental(h1, later, "2024-01-20 06:00:00")
    assert rows(h2, "id", "status", "scd_valid_to") == [
        (1, "placed", ts("2024-01-18")), (1, "shipped", None), (2, "placed", None)]
    # told when the last run was, the window covers the outage
    h3 = orders_snapshot_incremental(h1, later, "2024-01-20 06:00:00", last_as_of="2024-01-01 06:00:00")
    assert rows(h3, "id", "status", "scd_valid_to") == [
        (1, "placed", ts("2024-01-18")), (1, "shipped", None), (2, "placed", ts("2024-01-05")), (2, "shipped", None)]
