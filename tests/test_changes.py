"""Order-free change rows, unique upserts and carried balances."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from kairos.operators.metrics import Metric, carried_balance, evaluate
from kairos.session import scratch_path
from kairos.sources import changes as C
from kairos.sources import sinks
from tests.conftest import rows

SCHEMA = "k int, seq int, v string, op string"


def test_every_order_of_the_same_changes_gives_one_state(spark):
    data = [(1, 1, "a", "I"), (1, 5, "x", "D"), (1, 3, "late", "U"),  # the late update must not bring key 1 back
            (2, 2, "b", "I"), (2, 2, "c", "U"), (3, 4, None, "D"), (3, 4, "tie", "U"), (4, 1, "d", None)]
    one = C.as_state(spark.createDataFrame(data, SCHEMA), ["k"], "seq")
    want = rows(one.select("k", "seq", F.coalesce("v", F.lit("-")), "_deleted"))
    assert rows(C.live(one)) == [(2, 2, "c"), (4, 1, "d")]
    for order in itertools.islice(itertools.permutations(range(4)), 0, 24, 5):
        state = None
        for i in [*order, order[0]]:  # a batch comes twice
            batch = C.as_state(spark.createDataFrame(data[2 * i:2 * i + 2], SCHEMA), ["k"], "seq")
            state = C.merge(state, batch, ["k"], "seq")
        assert rows(state.select("k", "seq", F.coalesce("v", F.lit("-")), "_deleted")) == want


def test_change_table_batches_compaction_and_horizon(spark):
    table = C.ChangeTable(spark, scratch_path(spark, "changes"), ["k"], "seq")
    assert table.state() is None and table.late() is None
    df = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    table.apply(df((1, 5, "x", "D"), (2, 6, "b", "U")), "one")
    table.apply(df((1, 9, "again", "U")), "one")  # the same batch name: already there
    table.apply(df((1, 3, "late", "U"), (3, 1, "c", "I")))
    assert rows(table.live()) == [(2, 6, "b"), (3, 1, "c")]
    table.compact()
    table.apply(df((3, 2, "c2", "U")))
    assert rows(table.live()) == [(2, 6, "b"), (3, 2, "c2")] and table.state().where("_deleted").count() == 1
    table.compact("6")  # the delete of key 1 is forgotten, so changes before 6 can't be judged any more
    assert table.state().where("_deleted").count() == 0
    table.apply(df((1, 4, "too late", "U"), (None, 7, "n", "U"), (4, 6, "d", "U")))
    assert rows(table.live().where("k is not null")) == [(2, 6, "b"), (3, 2, "c2"), (4, 6, "d")]
    assert rows(table.late()) == [(1, 4, "too late", "U")]
    with pytest.raises(ValueError, match="horizon"):
        table.compact("5")
    # a batch that was written but not committed doesn't count
    spark.createDataFrame([(9, 9, "zz", False)], "k int, seq int, v string, _deleted boolean").write.parquet(table._dir(99, "delta"))
    assert table.live().where("k = 9").count() == 0


def test_upsert_refuses_or_reduces_repeated_keys(spark):
    t = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, at int, v string")
    twice = spark.createDataFrame([(2, 2, "x"), (2, 3, "y"), (None, 1, "n"), (None, 1, "m")], "k int, at int, v string")
    with pytest.raises(Exception, match="repeated key"):
        sinks.upsert(t, twice, ["k"]).collect()
    with pytest.raises(Exception, match="repeated key"):
        sinks.upsert(None, twice, ["k"]).collect()
    got = sinks.upsert(t, twice, ["k"], order=["at"]).collect()
    assert sorted((r["k"] or 0, r["v"]) for r in got) == [(0, "m"), (0, "n"), (1, "a"), (2, "y")]
    only_keys = spark.createDataFrame([(1,), (3,)], "k int")
    assert rows(sinks.upsert(spark.createDataFrame([(1,)], "k int"), only_keys, ["k"])) == [(1,), (3,)]


def brute_balance(data, until):
    """Balance per (period, dimension) by looking up every entity in every period."""
    month = lambda t: (t.year, t.month)
    data = [r for r in data if r[0] is not None and r[1] is not None]
    first, last = min(month(r[1]) for r in data), max(month(r[1]) for r in data)
    out, p = {}, first
    while p <= last:
        for e in {r[0] for r in data}:
            upto = [r for r in data if r[0] == e and month(r[1]) <= p]
            if not upto:
                continue
            _, _, dim, v, end = max(upto, key=lambda r: (r[1], r[2] is not None, r[2] or "", r[3], r[4] is not None, r[4] or dt.datetime.min))
            if until and end is not None and month(end) <= p:
                continue
            s, n = out.get((p, dim), (0, 0))
            out[p, dim] = s + v, n + 1
        p = (p[0] + p[1] // 12, p[1] % 12 + 1)
    return out


@pytest.mark.parametrize("until", [None, "ends"])
def test_carried_balance_equals_looking_up_every_entity(spark, until):
    rng = random.Random(7)
    data = []
    for i in range(200):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 400))
        end = at + dt.timedelta(days=rng.randrange(1, 300)) if rng.random() < 0.4 else None
        data.append((rng.choice([*range(25), None]), at, rng.choice(["a", "b", None]), rng.randrange(-5, 50), end))
    data += [(1, None, "a", 5, None)]
    df = spark.createDataFrame(data, "e int, t timestamp_ntz, dim string, v int, ends timestamp_ntz")
    got = {((r["period"].year, r["period"].month), r["dim"]): (r["balance"], r["n_entities"])
           for r in carried_balance(df, "e", "t", "v", ["dim"], until=until).collect()}
    assert got == brute_balance(data, until)


def test_an_entity_without_a_row_in_a_period_still_counts(spark):
    df = spark.createDataFrame([(1, "2024-01-05", 10.0), (2, "2024-03-01", 5.5)], "id int, t string, v double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    m = Metric("open", "sum", "v", "t", additive=False, entity="id", cast="decimal(10,2)", carry=True)
    got = [(r["period"].month, float(r["open"])) for r in evaluate(m, df).orderBy("period").collect()]
    assert got == [(1, 10.0), (2, 10.0), (3, 15.5)]
    with pytest.raises(ValueError, match="exact"):
        carried_balance(df, "id", "t", "v")
    with pytest.raises(ValueError, match="sum or a count"):
        evaluate(Metric("x", "avg", "v", "t", additive=False, entity="id", carry=True), df)
    assert carried_balance(df.limit(0), "id", "t", "1").count() == 0
