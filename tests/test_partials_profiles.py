"""Metric partials that roll up, and profile histories."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from kairos.operators.partials import Measure, MetricTable, NotAdditive, add_up
from kairos.operators.profiles import ProfileStore, judge, with_missing
from kairos.session import scratch_path

MEASURES = [Measure("n", "count", "v"), Measure("total", "sum", "v"), Measure("low", "min", "v"), Measure("high", "max", "v"),
            Measure("users", "distinct", "u"), Measure("items", "distinct", "i"), Measure("mean", "ratio", "total", over="n")]


def facts(rng, n):
    day = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(60 * 24 * 120))
    return [(day(), rng.choice(["a", "b", None]), rng.choice([None, *range(-5, 40)]), rng.choice([None, 1, -1, 32768, 40_000, 10**12]), rng.randrange(10**6))
            for _ in range(n)]


def brute(rows, period, by):
    groups = defaultdict(list)
    for r in rows:
        groups[(period(r[0]), r[1] if by else "-")].append(r)
    out = {}
    for k, rs in groups.items():
        v = [r[2] for r in rs if r[2] is not None]
        out[k] = (len(v), sum(v) if v else None, min(v, default=None), max(v, default=None), len({r[3] for r in rs} - {None}),
                  len({r[4] for r in rs}), sum(v) / len(v) if v else None)
    return out


@pytest.mark.parametrize("grain,by", [("month", True), ("month", False), ("week", True), ("day", False), ("year", False)])
def test_periods_from_days_equal_periods_from_rows(spark, grain, by):
    rng = random.Random(8)
    old, new = facts(rng, 400), facts(rng, 600)
    schema = "t timestamp_ntz, d string, v int, u long, i long"
    table = MetricTable(spark, scratch_path(spark, "metric"), MEASURES, "t", ["d"])
    table.load(spark.createDataFrame(old, schema))
    reloaded = [r for r in new if r[0].month in (2, 3)]  # every day of these that occurs is replaced
    table.load(spark.createDataFrame(reloaded, schema))
    if by:
        table.compact()
    days = {r[0].date() for r in reloaded}
    now = [r for r in old if r[0].date() not in days] + reloaded
    period = {"month": lambda t: dt.datetime(t.year, t.month, 1), "year": lambda t: dt.datetime(t.year, 1, 1),
              "day": lambda t: dt.datetime(t.year, t.month, t.day), "week": lambda t: dt.datetime(t.year, t.month, t.day) - dt.timedelta(days=t.weekday())}[grain]
    got = {(r["period"], r["d"] if by else "-"): tuple(r[m.name] for m in MEASURES) for r in table.read(grain, ["d"] if by else []).collect()}
    assert got == brute(now, period, by)


def test_what_cannot_be_added_up_is_refused(spark):
    df = spark.range(10).selectExpr("id", "timestamp_ntz'2024-01-01 00:00:00' as t", "string(id) as s")
    done = MetricTable(spark, scratch_path(spark, "refuse"), MEASURES[:4], "t")
    with pytest.raises(NotAdditive, match="users"):
        add_up(df, MEASURES, ["t"])
    with pytest.raises(ValueError, match="integer ids"):
        MetricTable(spark, scratch_path(spark, "refuse"), [Measure("x", "distinct", "s")], "t").load(df)
    with pytest.raises(ValueError, match="nothing was loaded"):
        done.read()
    with pytest.raises(ValueError, match="ratio"):
        MetricTable(spark, scratch_path(spark, "refuse"), [Measure("r", "ratio", "a", over="b")], "t").load(df)
    table = MetricTable(spark, scratch_path(spark, "refuse"), [Measure("n", "count", "id")], "t")
    table.load(df)
    with pytest.raises(ValueError, match="grain"):
        table.read("hour")
    with pytest.raises(ValueError, match="doesn't hold"):
        table.read("month", ["s"])
    assert add_up(table.read("day"), table.measures, []).first()["n"] == 10


def test_planted_spike_and_shift_are_flagged_and_steady_columns_are_not(spark):
    store = ProfileStore(spark, scratch_path(spark, "profile"), ["a", "b", "c"], ["kind"])
    assert store.alerts("none").count() == 0
    rng = random.Random(2)
    for run in range(12):
        spiked = run == 10
        data = [(None if rng.random() < 0.05 else 1, None if rng.random() < (0.4 if spiked else 0.05) else 2, 3,
                 rng.choice(["x", "x", "x", "new" if spiked else "y"])) for _ in range(1500)]
        store.record(spark.createDataFrame(data, "a int, b int, c int, kind string"), f"2024-01-{run + 1:02d}")
    found = {(r["what"], r["column_name"], r["value"], r["status"]) for r in store.alerts("2024-01-11", floor=0.03).collect()}
    assert found == {("null rate", "b", None, "spike"), ("share", "kind", "new", "spike"), ("share", "kind", "y", "drop")}
    for run in range(6, 10):
        assert store.alerts(f"2024-01-{run:02d}", floor=0.03).count() == 0
    assert {r["status"] for r in store.null_history().where("run < '2024-01-06'").collect()} == {"new"}
    store.record(spark.createDataFrame([(1, 2, 3, "x")], "a int, b int, c int, kind string"), "2024-01-12")  # a run again
    assert store.null_history().where("run = '2024-01-12'").count() == 3
    # an empty load has no rates
    store.record(spark.createDataFrame([], "a int, b int, c int, kind string"), "2024-01-13")
    assert store.null_history().where("run = '2024-01-13'").count() == 0


def test_judge_uses_the_middle_of_an_even_past(spark):
    df = spark.createDataFrame([(i, "c", r) for i, r in enumerate([0.1, 0.3, 0.2, 0.4, 0.9])], "run int, s string, rate double")
    got = judge(df, "run", ["s"], min_runs=4).orderBy("run").collect()
    assert got[4]["median"] == pytest.approx(0.25) and got[4]["spread"] == pytest.approx(0.1) and got[4]["status"] == "spike"
    assert got[0]["median"] is None and [r["status"] for r in got[:4]] == ["new"] * 4
    shares = spark.createDataFrame([(1, "k", "a", 1.0), (2, "k", None, 1.0)], "run int, column_name string, value string, rate double")
    full = {(r["run"], r["value"]): r["rate"] for r in with_missing(shares, "run").collect()}
    assert full == {(1, "a"): 1.0, (2, "a"): 0.0, (1, None): 0.0, (2, None): 1.0}
