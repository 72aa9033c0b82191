"""Checks within the write, window counts in update mode, closed intervals in linear time."""

import datetime as dt
import random

import pytest

from kairos.operators.pit import scd_between_join
from kairos.operators.quality import Contract, QualityError, repeated_keys
from kairos.session import scratch_path
from kairos.sources.checked import checked_write
from kairos.streaming import micro_batch as S
from tests.conftest import rows

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id int, other int, status string, v double, at timestamp_ntz"
CONTRACT = Contract({}, required=["id"], accepted={"status": ["a", "b"]}, ranges={"v": (0, None)}, unique=["id", "other"],
                    freshness_col="at", freshness_hours=24)


def lines(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_checked_write_counts_and_quarantines_in_one_pass(spark):
    df = lines(spark, (1, 1, "a", 1.0, T0), (2, 1, "zz", -1.0, T0), (None, 2, None, None, T0), (3, 3, "b", -5.0, None))
    got = checked_write(df, scratch_path(spark, "chk"), CONTRACT, "2024-01-01 12:00:00", {"range:v": "warn"}, "quarantine")
    assert got.n_rows == 4 and got.failed == {"not_null:id": 1, "accepted:status": 1, "range:v": 2}
    assert rows(got.layer(spark), "id", "other") == [(1, 1), (3, 3)]
    bad = {r["other"]: r["failed_clauses"] for r in got.quarantine(spark).collect()}
    assert bad == {1: ["accepted:status"], 2: ["not_null:id"]}
    with pytest.raises(QualityError, match="accepted:status"):
        checked_write(df, scratch_path(spark, "chk"), CONTRACT, "2024-01-01 12:00:00")
    good = lines(spark, (1, 1, "a", 1.0, T0), (2, 2, None, 0.0, T0))
    got = checked_write(good, scratch_path(spark, "chk"), CONTRACT, "2024-01-02 00:00:00")
    assert got.failed == {} and got.quarantine(spark).count() == 0 and got.layer(spark).count() == 2


def test_checks_of_the_whole_table_stop_the_build(spark):
    twice = lines(spark, (1, 1, "a", 1.0, T0), (1, 2, "a", 1.0, T0), (2, 2, "a", 1.0, T0), (2, 2, "a", 1.0, T0))
    with pytest.raises(QualityError, match="unique:id.*unique:other"):
        checked_write(twice, scratch_path(spark, "chk"), CONTRACT, "2024-01-01 12:00:00", on_error="quarantine")
    got = checked_write(twice, scratch_path(spark, "chk"), CONTRACT, "2024-01-03 12:00:00",
                        {"unique:id": "warn", "unique:other": "warn", "freshness:at": "warn"})
    assert got.failed == {"unique:id": 2, "unique:other": 2, "freshness:at": 1}
    for df in (twice, twice.limit(0)):  # an empty layer has no age
        with pytest.raises(QualityError, match="freshness"):
            checked_write(df, scratch_path(spark, "chk"), Contract({}, freshness_col="at", freshness_hours=1), "2024-02-01 00:00:00", on_error="quarantine")
    with pytest.raises(QualityError, match="schema:missing"):
        checked_write(twice, scratch_path(spark, "chk"), Contract({"missing": "int"}))
    nulls = lines(spark, (None, 1, "a", 1.0, T0), (None, 1, "a", 1.0, T0), (1, 1, "a", 1.0, T0))
    assert rows(repeated_keys(nulls, ["id", "other"])) == [("id", 1), ("other", 2)]


def test_update_mode_equals_the_batch_and_forgets_closed_windows(spark):
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "updates")
    schema = "at timestamp_ntz, kind string"
    rng = random.Random(1)
    data = [(T0 + dt.timedelta(days=d, minutes=rng.randrange(1440)), rng.choice(["x", "y", None])) for d in range(30) for _ in range(20)]
    data.sort(key=lambda r: r[0])
    for i in range(0, len(data), 50):  # a file is a batch
        spark.createDataFrame(data[i:i + 50], schema).coalesce(1).write.mode("append").parquet(landing)
    states = []
    keys = ["window_start", "window_end", "kind"]

    def run():
        stream = S.stream_path(spark, landing, spark.read.parquet(landing).schema, max_files=1)
        return S.run_updates(S.windowed_counts(stream, "at", "1 day", "1 day", ["kind"]), out, out + "-ckpt", keys,
                             lambda p: states.append(sum(o["numRowsTotal"] for o in p["stateOperators"])))

    got = {(r["window_start"], r["kind"]): r["n_rows"] for r in run().collect()}
    want: dict = {}
    for at, kind in data:
        k = at.replace(hour=0, minute=0), kind
        want[k] = want.get(k, 0) + 1
    assert got == want and len(want) > 60
    assert max(states) <= 25  # windows of a few days, not of thirty
    # a restart without new data, then with more, and a batch that was written but is run again
    assert {(r["window_start"], r["kind"]): r["n_rows"] for r in run().collect()} == want
    more = [(T0 + dt.timedelta(days=30), "x"), (T0 + dt.timedelta(days=29, hours=23), "y")]
    spark.createDataFrame(more, schema).coalesce(1).write.mode("append").parquet(landing)
    spark.createDataFrame([(T0, T0, "junk", 1)], "window_start timestamp_ntz, window_end timestamp_ntz, kind string, n_rows long").write.parquet(
        f"{out}/gen={len(S.list_dir(spark, out)) - len([n for n in S.list_dir(spark, out) if not n.startswith('gen=')]):06d}")
    for at, kind in more:
        k = at.replace(hour=0, minute=0), kind
        want[k] = want.get(k, 0) + 1
    assert {(r["window_start"], r["kind"]): r["n_rows"] for r in run().collect()} == want


@pytest.mark.parametrize("unit", ["month", "day", None])
def test_closed_intervals_by_asof_equal_the_join(spark, unit):
    rng = random.Random(5)
    hist, facts = [], []
    for k in [*range(6), None]:
        at = T0
        for i in range(40 if k == 0 else rng.randrange(0, 6)):  # key 0 is hot
            end = at + dt.timedelta(hours=rng.choice([1, 5, 40]))
            hist.append((k, f"{k}-{i}", i, at, end))
            at = end + dt.timedelta(hours=rng.choice([0, 0, 3]))
        if k in (1, 2):
            hist.append((k, f"{k}-open", 99, at, None))
    edges = [h[3] for h in hist] + [h[4] for h in hist if h[4]]
    for i in range(400):
        t = rng.choice(edges) if i % 2 else T0 + dt.timedelta(hours=rng.randrange(-5, 900))
        facts.append((i, rng.choice([0, 0, *range(8), None]), t if i % 50 else None))
    h = spark.createDataFrame(hist, "key int, sk string, n int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    f = spark.createDataFrame(facts, "i int, fk int, t timestamp_ntz")
    a, b = (scd_between_join(f, h, "fk", "t", "key", take=("sk", "n"), today="2024-01-20 00:00:00", strategy=s, slice_unit=unit) for s in ("asof", "join"))
    key = lambda df: sorted((str(x) for x in df.select(*b.columns).collect()))
    assert key(a) == key(b) and b.groupBy("i").count().where("count = 2").count() > 10
