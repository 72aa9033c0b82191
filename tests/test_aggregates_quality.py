import datetime as dt

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from kairos.functions import scalars as S
from kairos.operators import aggregates as agg
from kairos.operators import quality as Q
from kairos.operators.metrics import Metric, evaluate
from kairos.plans import models as M


def test_payment_rollup(spark):
    pay = spark.createDataFrame([
        ("p1", "o1", "success", 10), ("p2", "o2", "failed", 10),
        ("p3", "o3", "success", 10), ("p4", "o3", "refunded", 10)],
        "payment_id string, order_master_sk string, payment_status string, amount int")
    pay = pay.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    op = agg.order_payments(pay)
    orders = spark.createDataFrame([(f"o{i}", f"o{i}", i, 1, "c", "c", "placed", 10, True) for i in range(1, 5)],
                                   "sk string, master_sk string, order_id long, customer_id long, customer_sk string,"
                                   " customer_master_sk string, status string, amount int, is_current boolean")
    orders = (orders.withColumn("amount", F.col("amount").cast("decimal(18,2)"))
              .withColumn("placed_at", F.lit(None).cast("timestamp_ntz"))
              .withColumn("updated_at", F.lit(None).cast("timestamp_ntz")))
    f = M.fct_orders(orders, op)
    assert rows(f, "order_id", "is_paid", "payment_attempts") == [(1, True, 1), (2, False, 1), (3, False, 2),
                                                                  (4, False, 0)]


def test_feature_ratios(spark):
    dc = spark.createDataFrame([
        ("s0", "m0", 0, "active", "X", 0, 0, 0, 0, None, None),
        ("s1", "m1", 1, "active", "X", 1, 10, 1, 0, ts("2001-01-01"), ts("2001-01-01")),
        ("s2", "m2", 2, "active", "X", 2, 30, 2, 1, ts("2001-01-01"), ts("2001-01-11")),
    ], "sk string, master_sk string, customer_id long, status string, country string, total_orders long,"
       " total_spent int, completed_orders long, returned_orders long, first_order_at timestamp_ntz,"
       " last_order_at timestamp_ntz")
    dc = dc.withColumn("total_spent", F.col("total_spent").cast("decimal(18,2)"))
    cf = M.customer_features(dc, "2001-12-31 00:00:00")
    assert rows(cf, "customer_id", "avg_days_between_orders", "return_rate", "avg_order_value") == [
        (1, None, 0.0, 10.0), (2, 10.0, 0.5, 15.0)]


def test_day_diff_counts_boundaries(spark):
    df = spark.createDataFrame([(ts("2024-01-01 23:59"), ts("2024-01-02 00:01"))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(S.day_diff("a", "b")).first()[0] == 1


def test_freshness_levels(spark):
    now = dt.datetime(2024, 1, 10, 12, 0, 0)
    out = []
    for age in (dt.timedelta(hours=11), dt.timedelta(hours=12, minutes=1), dt.timedelta(hours=24, minutes=1)):
        df = spark.createDataFrame([(now - age,)], "t timestamp_ntz")
        out.append(Q.check_freshness(df, "t", now.isoformat(sep=" "), 12, 24).first()["status"])
    assert out == ["pass", "warn", "error"]


def test_check_kinds(spark):
    df = spark.createDataFrame([(1, None, 10), (1, "x", 11), (2, "bad", 99)], "k long, s string, fk long")
    assert Q.check_accepted(df, "s", ["x"]).count() == 1  # NULL passes, 'bad' fails
    assert rows(Q.check_unique(df, "k")) == [(1, 2)]
    parent = spark.createDataFrame([(10,), (11,)], "id long")
    assert rows(Q.check_relationship(df, "fk", parent, "id"), "fk") == [(99,)]
    c = Q.Contract(fields={"k": "bigint", "s": "string"}, required=["s"], unique=["k"])
    assert rows(Q.check_contract(df, c), "clause", "n_failed") == [("not_null", 1), ("unique", 1)]
    try:
        Q.require({"dup": Q.check_unique(df, "k")})
        raised = False
    except Q.QualityError:
        raised = True
    assert raised


def test_history_safe_totals_exclude_ties(spark):
    df = spark.createDataFrame([(1, "c", ts("2024-01-01"), 10), (2, "c", ts("2024-01-01"), 20),
                                (3, "c", ts("2025-03-01"), 5)], "id long, k string, t timestamp_ntz, v int")
    out = agg.history_safe_totals(df, "k", "t", "v")
    assert rows(out, "id", "prior_count") == [(1, 0), (2, 0), (3, 2)]
    assert rows(agg.history_safe_totals(df, "k", "t", "v", slice_unit=None)) == rows(out)
    gaps = agg.order_gaps(df.withColumnRenamed("id", "oid"), "k", "t", "oid")
    assert rows(gaps) == rows(agg.order_gaps(df.withColumnRenamed("id", "oid"), "k", "t", "oid", slice_unit=None))


def test_metric_semi_additive(spark):
    df = spark.createDataFrame([(1, ts("2024-01-01"), 5), (1, ts("2024-01-20"), 7), (2, ts("2024-01-03"), 1)],
                               "acct long, t timestamp_ntz, bal int")
    m = Metric("balance", "sum", "bal", "t", additive=False, entity="acct")
    assert rows(evaluate(m, df, [], "month"), "balance") == [(8,)]
    moved = spark.createDataFrame([(1, ts("2024-01-01"), 5, "open"), (1, ts("2024-01-20"), 7, "closed"), (2, ts("2024-01-03"), 1, "open")],
                                  "acct long, t timestamp_ntz, bal int, state string")
    # an account that changes its state in the month counts once, under its last state
    assert rows(evaluate(m, moved, ["state"], "month"), "state", "balance") == [("closed", 7), ("open", 1)]


def test_grouped_median_equals_sorting(spark):
    import random
    import statistics

    from kairos.operators.metrics import grouped_median

    rnd = random.Random(3)
    data = [("same", 4.0)] * 50 + [("even", float(x)) for x in range(40)] + [("odd", float(x * x)) for x in range(41)]
    data += [("skew", 7.0)] * 500 + [("skew", rnd.gauss(0, 50)) for _ in range(499)] + [(None, 2.0), (None, 3.0), ("one", -1.5)]
    data += [("rand", rnd.random()) for _ in range(1001)] + [("even", None)]
    got = {r.g: r.median for r in grouped_median(spark.createDataFrame(data, "g string, v double"), ["g"], "v").collect()}
    want = {g: statistics.median([v for k, v in data if k == g and v is not None]) for g in {k for k, _ in data}}
    assert got == want


def test_weekly_grid_is_anchored_at_start(spark):
    h = spark.createDataFrame([(1, "a", ts("2024-01-02 10:00:00"), ts("2024-01-10")), (1, "b", ts("2024-01-10"), None),
                               (2, "c", ts("2024-01-16"), None)], "k long, s string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    out = agg.periodic_snapshot(h, "k", "2024-01-01 00:00:00", "2024-01-22 00:00:00", ["s"], step="7 days")
    assert rows(out, "k", "s", "snapshot_at") == [(1, "a", ts("2024-01-08")), (1, "b", ts("2024-01-15")), (1, "b", ts("2024-01-22")),
                                                  (2, "c", ts("2024-01-22"))]


def test_schema_diff():
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    old = StructType([StructField("a", LongType()), StructField("b", StringType())])
    new = StructType([StructField("a", StringType()), StructField("c", StringType())])
    kinds = {(d["column"], d["breaking"]) for d in Q.schema_diff(old, new)}
    assert kinds == {("a", True), ("b", True), ("c", False)}
    from pyspark.sql.types import DecimalType, IntegerType
    wide = StructType([StructField("i", LongType()), StructField("d", DecimalType(20, 2)), StructField("r", LongType(), True)])
    narrow = StructType([StructField("i", IntegerType()), StructField("d", DecimalType(18, 2)), StructField("r", LongType(), False)])
    assert not any(d["breaking"] for d in Q.schema_diff(narrow, wide)) and len(Q.schema_diff(narrow, wide)) == 3
    assert all(d["breaking"] for d in Q.schema_diff(wide, narrow))


def test_contract_on_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], "k long, t timestamp_ntz")
    c = Q.Contract({"k": "bigint"}, freshness_col="t", freshness_hours=24, closed=True)
    assert rows(Q.check_contract(empty, c, "2024-01-01 00:00:00"), "clause", "detail") == [
        ("freshness", "freshness:t"), ("schema", "unexpected column t")]


def test_declared_checks_gate_a_layer(spark):
    from kairos.plans import contracts

    good = spark.createDataFrame([("p", 1, "success")], "payment_id string, order_id long, payment_status string")
    bad = good.unionByName(spark.createDataFrame([("p", None, "lost")], good.schema))
    assert contracts.gate("stg_payments", good) is good
    with pytest.raises(Q.QualityError):
        contracts.gate("stg_payments", bad)
    failed = contracts.suite({"stg_payments": bad})
    assert rows(failed, "clause", "detail") == [("accepted", "accepted:payment_status"), ("not_null", "not_null:order_id"),
                                                ("unique", "unique:payment_id")]
    assert len(contracts.SOURCES) == 5 and all(c.freshness_hours for c in contracts.SOURCES.values())


def test_a_day_without_rows_is_reported(spark):
    days = [(ts("2024-01-01") + dt.timedelta(days=d),) for d in range(12) for _ in range(10) if d != 8]
    out = Q.check_volume(spark.createDataFrame(days, "t timestamp_ntz"), "t", 7, 0.2)
    assert rows(out, "day", "n_rows")[0] == (dt.date(2024, 1, 9), 0)
    assert [r[1] for r in rows(agg.daily_baseline(spark.createDataFrame(days, "t timestamp_ntz"), "t"), "day", "n_rows")] == [10] * 8 + [0] + [10] * 3


def test_observability_checks(spark):
    days = [(ts("2024-01-01") + dt.timedelta(days=d),) for d in range(8) for _ in range(10)]
    days += [(ts("2024-01-09"),)] * 30  # day 9: 30 rows against a 7-day mean of 10
    df = spark.createDataFrame(days, "t timestamp_ntz")
    assert rows(Q.check_volume(df, "t", 7, 0.2), "n_rows") == [(30,)]
    n = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "b")], "k long, v string")
    assert rows(Q.null_profile(n, ["k", "v"]), "column_name", "null_rate") == [("k", 0.0), ("v", 0.5)]
    now = spark.createDataFrame([("a",), ("a",), ("c",)], "x string")
    before = spark.createDataFrame([("a",), ("b",)], "x string")
    assert rows(Q.category_profile(now, before, "x", 0.1), "value", "status") == [
        ("a", "shifted"), ("b", "missing"), ("c", "unexpected")]


def test_periodic_snapshot_points_by_arithmetic_equal_the_filtered_grid(spark):
    """Versions that start or end on, just before and just after grid points, before the start and after the end."""
    from datetime import datetime, timedelta

    start, end = datetime(2024, 1, 3, 12), datetime(2024, 2, 1, 11, 59, 59)
    edges = [start + timedelta(days=d, microseconds=u) for d in (-9, 0, 7, 14, 28, 29, 60) for u in (-1, 0, 1)]
    data = [(i * 100 + j, a, b) for i, a in enumerate(edges) for j, b in enumerate([*edges, None]) if b is None or b > a]
    h = spark.createDataFrame(data, "k int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    for step, width in (("7 days", timedelta(days=7)), ("1 week", timedelta(days=7)), ("36 hours", timedelta(hours=36)), ("1 day", timedelta(days=1))):
        points, p = [], start
        while p <= end:
            points.append(p)
            p += width
        want = sorted((k, p) for k, a, b in data for p in points if a <= p and (b is None or p < b))
        got = agg.periodic_snapshot(h, "k", str(start), str(end), [], step=step)
        assert sorted((r["k"], r["snapshot_at"]) for r in got.collect()) == want
