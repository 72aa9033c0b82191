"""Late change rows spliced into a history, and schemas that grow."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kairos.operators.quality import conformed, evolved
from kairos.operators.scd import scd2_from_changes
from kairos.plans import incremental as I
from kairos.session import scratch_path
from kairos.sources.sinks import SchemaChangeError
from kairos.sources.spliced import SplicedHistory
from tests.test_incremental import _loads, _rows

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "k int, ts timestamp_ntz, v string, w int"


@pytest.mark.parametrize("unit", ["month", None])
def test_shuffled_arrival_equals_the_one_pass_history(spark, unit):
    rng = random.Random(9)
    data = [(rng.choice([0, 0, 0, 1, 2, 3, None]), T0 + dt.timedelta(hours=rng.randrange(2000)) if rng.random() < 0.98 else None,
             rng.choice(["a", "b", None]), rng.randrange(3)) for _ in range(300)]
    data += data[:20]  # repeats, and rows at one key and time that differ
    data += [(0, data[0][1] or T0, "zz", 1), (0, data[0][1] or T0, "zy", 2)]
    store = SplicedHistory(spark, scratch_path(spark, "splice"), "k", "ts", ["v"], unit)
    assert store.history() is None
    rng.shuffle(data)
    parts = [data[i::4] for i in range(4)]
    for n, part in enumerate([*parts, parts[1], []]):
        store.apply(spark.createDataFrame(part, SCHEMA))
        if n == 2:
            store.compact()
    known = spark.createDataFrame([r for r in data if r[0] is not None and r[1] is not None], SCHEMA)
    want = scd2_from_changes(known, "k", "ts", ["v"], None)
    assert _rows(store.history().select(*[F.col(c).cast("string") for c in want.columns]).na.fill("-")) == \
        _rows(want.select(*[F.col(c).cast("string") for c in want.columns]).na.fill("-"))


def test_a_late_change_splits_and_merges_versions_of_its_key_only(spark):
    path = scratch_path(spark, "splice")
    store = SplicedHistory(spark, path, "k", "ts", ["v"])
    at = lambda d: dt.datetime(2024, 1, d)
    store.apply(spark.createDataFrame([(1, at(1), "A", 0), (1, at(3), "A", 0), (1, at(5), "B", 0), (2, at(1), "X", 0)], SCHEMA))
    store.apply(spark.createDataFrame([(1, at(2), "C", 0)], SCHEMA))  # A until 2, C, then A again from 3 on
    hist = lambda k: [(r["v"], r["valid_from"].day, r["valid_to"].day if r["valid_to"] else None) for r in
                      store.history().where(f"k = {k}").orderBy("valid_from").collect()]
    assert hist(1) == [("A", 1, 2), ("C", 2, 3), ("A", 3, 5), ("B", 5, None)] and hist(2) == [("X", 1, None)]
    assert {r["k"] for r in spark.read.parquet(f"{path}/versions/gen=000001").collect()} == {1}
    store.apply(spark.createDataFrame([(1, at(2), "D", 0), (1, at(4), "B", 0)], SCHEMA))  # at 2 the greater value counts; B starts earlier
    assert hist(1) == [("A", 1, 2), ("D", 2, 3), ("A", 3, 4), ("B", 4, None)]
    store.apply(spark.createDataFrame([(1, at(9), "Z", 0)], SCHEMA), number=1)  # a stream's batch that was committed
    assert hist(1)[-1] == ("B", 4, None)


def test_evolved_schemas(spark):
    s = lambda ddl: StructType.fromDDL(ddl)
    assert evolved(s("a int, b string"), s("a bigint, b string, c date")).simpleString() == "struct<a:bigint,b:string,c:date>"
    assert evolved(s("a bigint, b decimal(10,2)"), s("b decimal(12,2), a int")).simpleString() == "struct<a:bigint,b:decimal(12,2)>"
    for new, why in (("a int", "b removed"), ("a string, b string", "a type int->string"), ("a int, b string, c int not null", "c added")):
        with pytest.raises(SchemaChangeError, match=why):
            evolved(s("a int, b string"), s(new))
    row = conformed(spark.createDataFrame([(1,)], "a int"), s("a bigint, b string")).first()
    assert (row["a"], row["b"]) == (1, None)


def test_a_daily_run_goes_on_with_additive_changes_and_stops_at_breaking_ones(spark):
    base = scratch_path(spark, "schema")
    first, second = _loads(spark, 60, 4)
    narrow = I.Load(first.customers, first.products, first.orders.withColumn("customer_id", F.col("customer_id").cast("int")), first.payments)
    I.run_load(spark, None, narrow, "2024-01-02 06:00:00", base)
    priority = F.when(F.col("id") < 2, F.lit("high"))  # nullable
    wider = I.Load(second.customers.withColumn("note", F.when(F.col("id") < 3, "n")), second.products,
                   second.orders.withColumn("priority", priority), second.payments)
    state = I.run_load(spark, I.load_state(spark, base), wider, "2024-01-03 06:00:00", base)
    snap = state["orders_snapshot"]
    assert snap.schema["customer_id"].dataType.simpleString() == "bigint" and snap.count() == 64
    assert {(r["id"], r["priority"]) for r in snap.where("priority is not null").collect()} == {(0, "high"), (1, "high")}
    assert state["stg_orders"].where("is_current").count() == 60 and state["stg_orders"].where("customer_sk is null").count() == 0
    gone = I.Load(second.customers.drop("email"), second.products, second.orders, second.payments)
    with pytest.raises(SchemaChangeError, match="removed"):
        I.run_load(spark, I.load_state(spark, base), gone, "2024-01-04 06:00:00", base)
    # the stopped run changed nothing: the next one goes on
    again = I.run_load(spark, I.load_state(spark, base), I.Load(wider.customers, second.products, wider.orders), "2024-01-04 06:00:00", base)
    assert again.gen == 2 and _rows(again["orders_snapshot"].select("id", "status")) == _rows(snap.select("id", "status"))
