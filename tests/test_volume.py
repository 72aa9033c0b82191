"""What a build shuffles and writes: histories read once, keys packed, layers with one reader not written."""

import os
import datetime as dt

from pyspark.sql import functions as F

from kairos.functions.scalars import md5_uuid, packed_key, unpacked_key
from kairos.operators import keys, pit
from kairos.operators.aggregates import order_items_summary
from kairos.plans import models as M
from kairos.session import checkpoint_dir

T = dt.datetime(2024, 1, 1)


def _exchanges(spark, df):
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    return plan.count("Exchange hashpartitioning")


def _rows(df):
    return sorted(map(str, df.collect()))


def test_packed_keys_come_back(spark):
    texts = [None, "", "a", "é", "0" * 32, "F" * 32, "g" * 32, "ab" * 16, "--" * 18, "0123456789abcdef0123456789abcdef"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("u", md5_uuid("t"))
    out = df.select("t", "u", unpacked_key(packed_key("t")).alias("t2"), unpacked_key(packed_key("u")).alias("u2"),
                    F.length(packed_key("u")).alias("n")).collect()
    assert all(r.t == r.t2 and r.u == r.u2 for r in out) and {r.n for r in out if r.u} == {17}


def test_merge_equals_join_in_one_exchange(spark):
    orders = spark.createDataFrame([(1, "a" * 32, "a" * 32, T, T + dt.timedelta(9), False), (1, "b" * 32, "a" * 32, T + dt.timedelta(9), None, True),
                                    (2, "c", "c", None, None, True), (None, "d", "d", T, None, True)],
                                   "order_id long, sk string, master_sk string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    omap = spark.createDataFrame([(1, "a" * 32), (2, "c"), (3, "m")], "canonical_id long, master_sk string")
    pays = spark.createDataFrame([(f"p{i}", k, "card", "success", T + dt.timedelta(d) if d is not None else None)
                                  for i, (k, d) in enumerate([(1, -1), (1, 0), (1, 8), (1, 9), (1, None), (2, 5), (3, 1), (4, 1), (None, 1)])],
                                 "id string, order_id long, method string, status string, created_at timestamp_ntz").withColumn("amount", F.lit(1))
    join, merge = (M.stg_payments(pays, orders, omap, strategy=s, settled="ok") for s in ("join", "merge"))
    assert _rows(join) == _rows(merge) == _rows(M.stg_payments(pays, orders, omap, settled="ok"))
    assert _exchanges(spark, M.stg_payments(pays, orders, omap)) == 1


def test_links_that_nobody_reads_cost_no_exchange(spark):
    h = spark.range(9).select("id", F.lit("x").alias("sk"), F.lit("x").alias("master_sk"), F.lit(T).cast("timestamp_ntz").alias("valid_from"),
                              F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"))
    f = spark.range(50).select("id", (F.col("id") % 9).alias("k"), F.lit(T).cast("timestamp_ntz").alias("at"))
    out = pit.fk_enrich(f, "k", "at", h, "id", "p", strategy="merge").select("id")
    assert _exchanges(spark, out) == 0 and out.count() == 50


def test_few_versions_need_one_exchange(spark):
    ch = spark.createDataFrame([(k, s, T + dt.timedelta(hours=h)) for k in (1, 2, None) for s, h in (("a", 0), ("b", 5), ("b", 5), ("c", 50), ("a", 30))],
                               "id long, status string, updated_at timestamp_ntz")
    few, plain = M.snapshot_from_changes(ch, few=True), M.snapshot_from_changes(ch)
    assert _rows(few) == _rows(plain) and few.columns == plain.columns
    k = keys.surrogate_keys(few, "id", few=True)
    assert _rows(k) == _rows(keys.surrogate_keys(plain, "id")) and _exchanges(spark, k) == 1


def test_items_of_an_order_meet_once(spark):
    items = spark.createDataFrame([(i % 4 if i % 5 else None, i % 3, i) for i in range(40)], "order_id long, product_id long, quantity long")
    items = items.withColumn("unit_price", F.lit(2).cast("decimal(18,2)"))
    few, plain = order_items_summary(items, few=True), order_items_summary(items)
    assert _rows(few) == _rows(plain) and _exchanges(spark, few) == 1


def test_a_layer_with_one_reader_is_not_written(spark):
    layers = os.path.join(checkpoint_dir(spark), "kairos")
    count = lambda: len([n for n in os.listdir(layers) if n.startswith("layer-")]) if os.path.isdir(layers) else 0
    before = count()
    M.Models(spark, "/root/testdata/sf0.001", layer_mode="checkpoint").customer_features  # noqa: B018
    assert count() - before == 3


def _facts_base(spark, tmp_path):
    """A fact store of two generations: f2 and f4 linked again, one fact without an id."""
    from kairos.sources.facts import FactStore

    cols = "fact_id string, order_id string, order_sk string, created_at timestamp_ntz"
    first = spark.createDataFrame([(f"{i:032x}" if i else None, f"o{i}", f"{i + 50:032x}" if i % 3 else None, T + dt.timedelta(i), bool(i % 2)) for i in range(6)],
                                  cols + ", _settled boolean")
    again = spark.createDataFrame([(f"{i:032x}", f"o{i}", f"{i + 90:032x}", T + dt.timedelta(i), True) for i in (2, 4)], cols + ", _settled boolean")
    store = FactStore(spark, str(tmp_path / "facts"), "fact_id", "created_at", first.drop("_settled").schema)
    store.write(0, first)
    store.write(1, first.limit(0), again)
    return store


def test_stored_facts_cross_their_joins_packed(spark, tmp_path):
    store = _facts_base(spark, tmp_path)
    out = store.table(1)
    assert {r.order_id: r.order_sk for r in out.collect()} == {"o0": None, "o1": f"{51:032x}", "o2": f"{92:032x}", "o3": None, "o4": f"{94:032x}", "o5": f"{55:032x}"}
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in store.schema.fields]
    assert {f.name for f in store._current(1).schema.fields if f.dataType.typeName() == "string"} == {"_link"}
    hit = store.affected(1, {"order_id": spark.createDataFrame([("o1", T), ("o2", T + dt.timedelta(9)), ("o3", T + dt.timedelta(9))], "order_id string, _from timestamp_ntz")})
    assert {(r.fact_id, r.order_id, r._link) for r in hit.collect()} == {(f"{1:032x}", "o1", "settled")}


def test_paid_totals_leave_ids_and_version_keys_behind(spark):
    lazy, kept = M.Models(spark, "/root/testdata/sf0.001"), M.Models(spark, "/root/testdata/sf0.001", shared=("stg_payments",))
    assert _rows(lazy.int_order_payments) == _rows(kept.int_order_payments) and _rows(lazy.fct_orders) == _rows(kept.fct_orders)
    assert lazy._payments_to_sum.schema["order_master_sk"].dataType.typeName() == "binary"
    assert lazy.int_order_payments.schema == kept.int_order_payments.schema


def test_items_keep_a_master_key_of_its_own(spark):
    hist = lambda p: spark.createDataFrame([(1, f"{p}a", f"{p}a", T, T + dt.timedelta(5), False), (1, f"{p}b", f"{p}a", T + dt.timedelta(5), None, True),
                                            (2, f"{p}c", None, T, None, True)],
                                           "k long, sk string, master_sk string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    o, p = hist("o").withColumnRenamed("k", "order_id"), hist("p").withColumnRenamed("k", "product_id")
    empty = spark.createDataFrame([(3, "m")], "canonical_id long, master_sk string")
    items = spark.createDataFrame([(f"i{n}", a, b, 1, T + dt.timedelta(d)) for n, (a, b, d) in enumerate([(1, 1, 1), (1, 1, 6), (2, 2, 1), (1, 3, 1), (None, 1, 6), (1, None, 1), (9, 9, 1)])],
                                  "id string, order_id long, product_id long, quantity long, created_at timestamp_ntz").withColumn("unit_price", F.lit(2).cast("decimal(18,2)"))
    merge, join = (M.stg_order_items(items, o, empty, p, empty, strategy=s, settled="ok") for s in ("merge", "join"))
    assert _rows(merge) == _rows(join) and merge.dtypes == join.dtypes
    got = {r.order_item_id: (r.product_sk, r.product_master_sk) for r in merge.collect()}
    assert got == {"i0": ("pa", "pa"), "i1": ("pb", "pa"), "i2": ("pc", None), "i3": (None, "m"), "i4": ("pb", "pa"), "i5": (None, None), "i6": (None, None)}


def test_contract_checks_write_no_links(spark):
    from kairos.plans import catalog

    layers = os.path.join(checkpoint_dir(spark), "kairos")
    count = lambda: len([n for n in os.listdir(layers) if n.startswith("layer-")]) if os.path.isdir(layers) else 0
    before = count()
    catalog.QUERIES["q_contract_suite"](spark, "/root/testdata/sf0.001")
    assert count() - before == 7


def _plan(df, which):
    return getattr(df._jdf.queryExecution(), which)().toString()


def test_open_versions_are_found_by_closed_keys(spark, tmp_path):
    from kairos.operators.scd import scd2_changes
    from kairos.sources.versions import VersionStore

    def load(day, ids):
        return ids.select("id", F.lit(f"v{day}").alias("v"), F.lit(T + dt.timedelta(day)).cast("timestamp_ntz").alias("updated_at"))

    store, ids = None, [spark.range(1, 4), spark.range(2, 20_000).where("id <> 3"), spark.createDataFrame([(2,), (3,), (30_000,)], "id long")]
    for gen, x in enumerate(ids):
        rows = scd2_changes(store.open_rows(gen - 1) if store else None, load(gen, x), "id")
        store = store or VersionStore(spark, str(tmp_path / "versions"), "id", rows.drop("_kind").schema)
        store.write(gen, rows)
    few = F.col("id").isin(1, 2, 3, 4, 30_000)
    got, before = store.open_rows(2), store.open_rows(1)
    assert sorted((r.id, r.v) for r in got.where(few).collect()) == [(1, "v0"), (2, "v2"), (3, "v2"), (4, "v1"), (30_000, "v2")]
    assert sorted((r.id, r.v) for r in before.where(few).collect()) == [(1, "v0"), (2, "v1"), (3, "v0"), (4, "v1")]
    assert got.count() == got.select("id").distinct().count() == 20_000
    # the few closed keys are broadcast, however many versions were opened
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16384")
    try:
        plan = _plan(store.open_rows(2).select("*"), "sparkPlan")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_version_and_master_keys_cross_joins_packed(spark):
    from kairos.operators.scd import scd2_changes, scd2_snapshot

    kinds = [None, "", "plain", "AB" * 16, "ab" * 16, "0f8fad5b-d9cb-469f-a165-70867728950e"]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(kinds)] + [(None, "x")], "canonical_id long, sk string")
    m = spark.createDataFrame([(i + 1, k) for i, k in enumerate(kinds[2:])], "canonical_id long, master_sk string")
    out = keys.assign_master_sk(df, m)
    masters = dict(enumerate(kinds[2:], 1))
    assert out.columns == ["canonical_id", "sk", "master_sk"]
    assert {tuple(r) for r in out.collect()} == {(i, k, masters.get(i, k)) for i, k in [*enumerate(kinds), (None, "x")]}
    assert "unhex" in _plan(out, "optimizedPlan")

    first = spark.createDataFrame([(i, "a", T) for i in (1, 2, 3)], "id long, v string, updated_at timestamp_ntz")
    then = spark.createDataFrame([(i, "b", T + dt.timedelta(d)) for i, d in ((1, 1), (2, 0), (3, -1), (4, 1), (None, 1))], "id long, v string, updated_at timestamp_ntz")
    held = scd2_snapshot(None, first, "id")
    changed = scd2_changes(held, then, "id")
    whole = scd2_snapshot(held, then, "id")
    assert changed.columns == [*whole.columns, "_kind"]
    assert _rows(changed.drop("_kind")) == _rows(whole.where("id in (1, 4) or id is null"))
    assert sorted((r.id or 0, r._kind) for r in changed.collect()) == [(0, "opened"), (1, "closed"), (1, "opened"), (4, "opened")]
    assert "unhex" in _plan(changed, "optimizedPlan")


def test_sliced_links_that_nobody_reads_cost_no_exchange(spark):
    h = spark.range(9).select("id", F.lit("x").alias("sk"), F.lit("x").alias("master_sk"), F.lit(T).cast("timestamp_ntz").alias("valid_from"),
                              F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"))
    f = spark.range(50).select("id", F.when(F.col("id") % 5 > 0, F.col("id") % 9).alias("k"), F.lit(T).cast("timestamp_ntz").alias("at"))
    out = pit.fk_enrich(f, "k", "at", h, "id", "p", slice_unit="year").select("id")
    assert _exchanges(spark, out) == 0 and out.count() == 50


def test_facts_without_a_key_go_with_the_others(spark):
    """One pass over the facts, whatever made them: each id of a deduplicated log is made once."""
    h = spark.createDataFrame([(1, "a", "a", T, T + dt.timedelta(5), False), (1, "b", "a", T + dt.timedelta(5), None, True)],
                              "k long, sk string, master_sk string, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
    f = spark.createDataFrame([(f"f{i}", (1, 2, None)[i % 3], T + dt.timedelta(i)) for i in range(-3, 9)] + [("none", None, None), ("late", 1, None)],
                              "id string, order_id long, at timestamp_ntz")
    for options in ({"strategy": "merge"}, {"slice_unit": "month"}, {"slice_unit": None}):
        got = pit.fk_enrich(f, "order_id", "at", h, "k", "p", mark="ok", **options)
        assert _rows(got) == _rows(pit.fk_enrich(f, "order_id", "at", h, "k", "p", mark="ok", strategy="join"))
        seen = spark.sparkContext.accumulator(0)
        counted = spark.createDataFrame(f.rdd.map(lambda r: (seen.add(1), r)[1]), f.schema)
        pit.fk_enrich(counted, "order_id", "at", h, "k", "p", strategy="merge").write.format("noop").mode("overwrite").save()
        assert seen.value == f.count()


def test_layers_that_an_order_item_does_not_read_are_not_written(spark):
    from kairos.plans.catalog import QUERIES

    layers = os.path.join(checkpoint_dir(spark), "kairos")
    count = lambda: len([n for n in os.listdir(layers) if n.startswith("layer-")]) if os.path.isdir(layers) else 0
    before = count()
    out = QUERIES["stg_order_items"](spark, "/root/testdata/sf0.001")
    assert count() == before and _exchanges(spark, out) <= 6


def test_late_settled_facts_are_compared_with_settled_ones_only(spark, tmp_path):
    """Facts linked again leave the other first rows out of their joins; without any there is no join at all."""
    store = _facts_base(spark, tmp_path)
    assert _exchanges(spark, store.table(0)) == 0 and len(store._again_folders(0)) == 0
    before = {tuple(r) for r in store.table(1).collect()}
    stale = store.affected(1, {"order_id": spark.createDataFrame([(f"o{i}", T) for i in range(6)], "order_id string, _from timestamp_ntz")}, packed=True)
    moved = store.affected(1, {"order_id": spark.createDataFrame([(f"o{i}", T) for i in range(6)], "order_id string, _from timestamp_ntz")})
    assert stale.count() == moved.count() == 5
    # f1 was settled, f2 and f4 were linked again before they kept what they had replaced: their kind is not known
    assert {(r.fact_id[-1], r._was_pending) for r in moved.collect()} == {("1", False), ("2", None), ("3", False), ("4", None), ("5", False)}
    again = moved.withColumn("order_sk", F.lit("z")).withColumn("_settled", F.lit(True))
    store.write(2, again.drop("_was_pending").limit(0), again)
    assert {link for n, link in store._again_folders(2).values() if n == 2} == {"settled", "settled_was_settled"}
    assert {(r.order_id, r.order_sk) for r in store.table(2).collect()} == {("o0", None)} | {(f"o{i}", "z") for i in range(1, 6)}
    assert {tuple(r) for r in store.table(1).collect()} == before
