import datetime as dt
import random

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from kairos.operators import keys, pit, scd

ENT = "order_id long, sk string, master_sk string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"


def _entity(spark):
    return spark.createDataFrame([
        (1, "v1", "v1", ts("2024-01-10"), ts("2024-01-20"), False),
        (1, "v2", "v1", ts("2024-01-20"), None, True),
    ], ENT)


@pytest.mark.parametrize("strategy", ["asof", "join"])
def test_pit_boundaries_and_fallback(spark, strategy):
    facts = spark.createDataFrame([("a", 1, ts("2024-01-09")), ("b", 1, ts("2024-01-10")),
                                   ("c", 1, ts("2024-01-19 23:59:59")), ("d", 1, ts("2024-01-20")),
                                   ("e", 7, ts("2024-01-15")), ("f", 1, None)],
                                  "id string, order_id long, created_at timestamp_ntz")
    skm = spark.createDataFrame([(1, "v1"), (7, "m7")], "canonical_id long, master_sk string")
    out = pit.fk_enrich(facts, "order_id", "created_at", _entity(spark), "order_id", "order", sk_map=skm,
                        strategy=strategy)
    assert rows(out, "id", "order_sk", "order_master_sk") == [
        ("a", "v2", "v1"), ("b", "v1", "v1"), ("c", "v1", "v1"), ("d", "v2", "v1"),
        ("e", None, "m7"), ("f", "v2", "v1")]
    no_map = pit.fk_enrich(facts, "order_id", "created_at", _entity(spark), "order_id", "order", strategy=strategy)
    assert rows(no_map.where("id = 'e'"), "order_sk", "order_master_sk") == [(None, None)]


def test_asof_equals_join_with_hot_key(spark):
    rnd = random.Random(7)
    ents, facts = [], []
    for k in range(1, 6):
        n = 300 if k == 1 else 3  # key 1 is hot in both facts and versions
        t = [ts("2023-01-01") + dt.timedelta(hours=rnd.randint(0, 24 * 400)) for _ in range(n)]
        t = sorted(set(t))
        for i, a in enumerate(t):
            b = t[i + 1] if i + 1 < len(t) else None
            ents.append((k, f"s{k}-{i}", f"s{k}-0", a, b, b is None))
    for i in range(2000):
        k = 1 if i % 3 else rnd.randint(1, 8)
        facts.append((i, k, ts("2022-12-01") + dt.timedelta(hours=rnd.randint(0, 24 * 430))))
    e = spark.createDataFrame(ents, ENT)
    f = spark.createDataFrame(facts, "id long, order_id long, created_at timestamp_ntz")
    a = pit.fk_enrich(f, "order_id", "created_at", e, "order_id", "order", strategy="asof", slice_unit="month")
    for unit in ("week", None):
        assert rows(pit.fk_enrich(f, "order_id", "created_at", e, "order_id", "order", slice_unit=unit)) == rows(a)
    skm = spark.createDataFrame([(k, f"m{k}") for k in range(1, 10)], "canonical_id long, master_sk string")
    a_map = pit.fk_enrich(f, "order_id", "created_at", e, "order_id", "order", sk_map=skm, slice_unit="month")
    j_map = pit.fk_enrich(f, "order_id", "created_at", e, "order_id", "order", sk_map=skm, strategy="join")
    assert rows(a_map) == rows(j_map)
    j = pit.fk_enrich(f, "order_id", "created_at", e, "order_id", "order", strategy="join")
    assert a.count() == f.count()
    assert rows(a) == rows(j)


def test_chained_enrichment_keeps_rows(spark):
    items = spark.createDataFrame([("i1", 1, 5, ts("2024-01-15")), ("i2", 1, 6, ts("2024-01-25"))],
                                  "id string, order_id long, product_id long, created_at timestamp_ntz")
    prod = spark.createDataFrame([(5, "p5", "p5", ts("2024-01-01"), None, True)],
                                 ENT.replace("order_id", "product_id"))
    out = (items.transform(lambda d: pit.fk_enrich(d, "order_id", "created_at", _entity(spark), "order_id", "order"))
           .transform(lambda d: pit.fk_enrich(d, "product_id", "created_at", prod, "product_id", "product")))
    assert rows(out, "id", "order_sk", "product_sk") == [("i1", "v1", "p5"), ("i2", "v2", None)]


def _history(spark, data):
    return spark.createDataFrame(data, "id long, name string, updated_at timestamp_ntz, scd_id string, "
                                       "scd_updated_at timestamp_ntz, scd_valid_from timestamp_ntz, "
                                       "scd_valid_to timestamp_ntz")


def test_id_migration_shares_master_sk(spark):
    h = _history(spark, [(100, "old", ts("2024-01-01"), "a", ts("2024-01-01"), ts("2024-01-01"), None),
                         (999, "new", ts("2024-02-01"), "b", ts("2024-02-01"), ts("2024-02-01"), None)])
    mapping = spark.createDataFrame([(100, 999)], "old_id int, new_id int")
    k = keys.surrogate_keys(h, "id", mapping=mapping)
    assert rows(k, "source_id", "canonical_id", "master_sk") == [(100, 100, "a"), (999, 100, "a")]
    m = keys.sk_map(h, "id", mapping)
    assert rows(m) == [(100, "a")]


def test_key_map_is_append_only(spark):
    h1 = _history(spark, [(1, "x", ts("2024-01-05"), "late", ts("2024-01-05"), ts("2024-01-05"), None)])
    m1 = keys.sk_map(h1, "id")
    h2 = _history(spark, [(1, "x", ts("2024-01-01"), "early", ts("2024-01-01"), ts("2024-01-01"), ts("2024-01-05")),
                          (1, "x", ts("2024-01-05"), "late", ts("2024-01-05"), ts("2024-01-05"), None),
                          (2, "y", ts("2024-01-01"), "two", ts("2024-01-01"), ts("2024-01-01"), None)])
    m2 = keys.sk_map(h2, "id", previous=m1)
    assert rows(m2) == [(1, "late"), (2, "two")]


def test_incremental_surrogate_keys_equal_full(spark):
    """A run that closes an old version and adds an unseen key with an old
    timestamp gives the same staging table as a full refresh."""
    b1 = spark.createDataFrame([(1, "a", ts("2024-01-05")), (2, "b", ts("2024-01-05"))],
                               "id long, name string, updated_at timestamp_ntz")
    b2 = spark.createDataFrame([(1, "a2", ts("2024-01-06")), (2, "b", ts("2024-01-05")),
                                (3, "c", ts("2024-01-01"))], "id long, name string, updated_at timestamp_ntz")
    h1 = scd.scd2_snapshot(None, b1, "id")
    h2 = scd.scd2_snapshot(h1, b2, "id")
    stg1 = keys.surrogate_keys(h1, "id")
    map2 = keys.sk_map(h2, "id", previous=keys.sk_map(h1, "id"))
    inc = keys.surrogate_keys(h2, "id", sk_map_df=map2, previous=stg1)
    full = keys.surrogate_keys(h2, "id")
    assert rows(inc.select(*full.columns)) == rows(full)
    assert inc.where(F.col("is_current")).groupBy("source_id").count().where("count > 1").count() == 0


def test_canonicalise_and_new_entities(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    mapping = spark.createDataFrame([(1, 3)], "old_id int, new_id int")
    assert rows(keys.canonicalise(df, "id", mapping), "id", "canonical_id") == [(1, 1), (2, 2), (3, 1)]
    first = spark.createDataFrame([(1, "a"), (2, "b")], "canonical_id long, master_sk string")
    prev = spark.createDataFrame([(1, "a")], "canonical_id long, master_sk string")
    assert rows(keys.new_entities(first, prev)) == [(2, "b")]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_pit_join_strategies_agree(spark, how):
    rnd = random.Random(11)
    ents, facts = [], []
    for k in range(1, 4):
        t = sorted({ts("2023-01-01") + dt.timedelta(days=rnd.randint(0, 300)) for _ in range(20)})
        ents += [(k, f"s{k}-{i}", f"s{k}-0", x, y, y is None) for i, (x, y) in enumerate(zip(t, t[1:] + [None]))][:-1]  # no open version
    for i in range(300):
        facts.append((i, rnd.choice([1, 2, 3, 4, None]), rnd.choice([None, ts("2022-12-01") + dt.timedelta(days=rnd.randint(0, 360))])))
    e = spark.createDataFrame(ents, ENT)
    f = spark.createDataFrame(facts, "id long, order_id long, created_at timestamp_ntz")
    got = [pit.pit_join(f, e, "order_id", "created_at", "order_id", how=how, strategy=s, slice_unit=u)
           for s, u in (("join", None), ("asof", None), ("asof", "month"))]
    assert rows(got[0]) == rows(got[1]) == rows(got[2])
    feats = pit.pit_features(f, e, "order_id", "created_at", "order_id", take=["sk"])
    assert feats.columns == ["id", "order_id", "created_at", "feat_sk", "feat_age_days"]
    assert all(r.feat_age_days is None or r.feat_age_days >= 0 for r in feats.collect())


def test_facts_without_key_do_not_gather(spark):
    """Half of the facts have no key: no task of the window gets more than 1.5 times the mean."""
    n = 40_000
    facts = spark.range(n).select("id", F.when(F.col("id") % 2 == 0, F.col("id") % 997).alias("order_id"),
                                  (F.lit(ts("2024-01-01")) + F.make_dt_interval(F.col("id") % 300)).cast("timestamp_ntz").alias("created_at"))
    e = spark.createDataFrame([(k, f"s{k}", f"s{k}", ts("2023-01-01"), None, True) for k in range(997)], ENT)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        window = pit._asof(facts, "order_id", "created_at", e, "order_id", ["sk", "master_sk"], "month")
        sizes = [r["n"] for r in window.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert sum(sizes) == n // 2 and max(sizes) < 1.5 * sum(sizes) / len(sizes)
    out = pit.fk_enrich(facts, "order_id", "created_at", e, "order_id", "order")
    assert out.count() == n and out.where("order_sk is null").count() == n // 2
