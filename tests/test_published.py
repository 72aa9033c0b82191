"""Validated promotion by commit, and selective compaction."""

import pytest
from pyspark.sql import functions as F

from kairos.session import hadoop_path, path_exists, scratch_path
from kairos.sources import compaction, sinks
from kairos.sources.published import PromotionRefused, PublishedTable, Rules
from tests.conftest import rows

SCHEMA = "ds string, k int, v int"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def seen(table):
    return sorted((r["ds"], r["k"], r["v"]) for r in table.read().collect())


@pytest.fixture()
def table(spark):
    t = PublishedTable(spark, scratch_path(spark, "published"), "ds", ["k"])
    t.backfill(frame(spark, ("a/b", 1, 10), ("a/b", 2, 20), ("c", 1, 5), ("d", 7, 7)), "first")
    return t


def test_a_failing_comparison_leaves_readers_on_the_old_rows(spark, table):
    before = seen(table)
    assert before == [("a/b", 1, 10), ("a/b", 2, 20), ("c", 1, 5), ("d", 7, 7)]
    for bad, why in ((frame(spark, ("a/b", 1, 10)), "too many removed"),
                     (frame(spark, ("c", 1, 5), ("c", 1, 6)), "repeated keys"),
                     (frame(spark, ("c", 1, -1)), "rule broken"),
                     (frame(spark, ("c", 1, 50)), "sum of v moved")):
        with pytest.raises(PromotionRefused, match=why) as e:
            table.backfill(bad, f"bad {why}", Rules(sums={"v": 2.0}, must_hold="v >= 0"))
        assert len(e.value.report) == 1 and seen(table) == before
    with pytest.raises(Exception, match="has no ds"):
        table.stage(frame(spark, (None, 1, 1)), "nulls")


def test_a_good_run_switches_its_partitions_and_a_rerun_is_harmless(spark, table):
    good = frame(spark, ("a/b", 1, 11), ("a/b", 2, 20), ("e", 1, 1))
    for _ in range(2):
        table.backfill(good, "second", Rules(max_changed=0.5))
    want = [("a/b", 1, 11), ("a/b", 2, 20), ("c", 1, 5), ("d", 7, 7), ("e", 1, 1)]
    assert seen(table) == want
    with pytest.raises(ValueError, match="live"):
        table.stage(good, "second")
    # a run that was staged only, even twice, changes nothing
    table.stage(frame(spark, ("c", 9, 9)), "half")
    table.stage(frame(spark, ("c", 8, 8)), "half")
    assert seen(table) == want
    # partitions that the run covers without rows become empty, when asked for
    with pytest.raises(PromotionRefused):
        table.backfill(frame(spark, ("c", 1, 6)), "third", parts=["c", "d"])
    table.backfill(frame(spark, ("c", 1, 6)), "third", Rules(max_removed=None), parts=["c", "d"])
    assert seen(table) == [("a/b", 1, 11), ("a/b", 2, 20), ("c", 1, 6), ("e", 1, 1)]
    with pytest.raises(ValueError, match="not asked for"):
        table.backfill(frame(spark, ("z", 1, 6)), "fourth", parts=["c"])
    table.rollback()
    assert seen(table) == want
    assert table.vacuum(keep=1) == sorted(["third", "fourth", "half"]) and seen(table) == want


def test_partition_report_counts(spark, table):
    new = frame(spark, ("a/b", 2, 21), ("a/b", 3, 1), ("c", 1, 5))
    schema = table.stage(new, "r")
    got = {r["partition"]: r for r in table.report("r", schema, Rules(max_removed=None, max_added=0.4, sums={"v": 0.1})).collect()}
    r = got["a/b"]
    assert (r["n_old"], r["n_new"], r["n_added"], r["n_removed"], r["n_changed"], r["n_same"]) == (2, 2, 1, 1, 1, 0)
    assert (r["v_old"], r["v_new"], r["verdict"]) == (30, 22, "too many added, sum of v moved")
    assert got["c"]["verdict"] == "ok" and got["c"]["n_same"] == 1 and "d" not in got


def files(spark, path):
    return {r["path"]: r["length"] for r in compaction.list_files(spark, path).collect()}


def test_compaction_packs_small_files_and_keeps_large_ones(spark):
    path = scratch_path(spark, "small")
    spark.range(40_000).selectExpr("id", "'big' as p", "sha2(string(id), 256) as s").coalesce(1).write.partitionBy("p").parquet(path)
    for i in range(6):
        (spark.range(i * 100, i * 100 + 100).selectExpr("id", "if(id % 2 = 0, 'even x:%', 'big') as p", "string(id) as s").coalesce(1)
         .write.mode("append").partitionBy("p").parquet(path))
    spark.range(1).selectExpr("id", "'lone' as p", "'x' as s").write.mode("append").partitionBy("p").parquet(path)
    before, content = files(spark, path), rows(spark.read.parquet(path))
    large = {p: n for p, n in before.items() if n > 1_000_000}
    assert len(before) == 14 and len(large) == 1
    assert compaction.compact_small(spark, path, target_mb=1) == 12
    after = files(spark, path)
    assert rows(spark.read.parquet(path)) == content
    assert large.items() <= after.items() and len(after) == 4  # the large one, the lone one, one packed file in each of two folders
    assert compaction.compact_small(spark, path, target_mb=1) == 0 and not path_exists(spark, f"{path}/_compact")
    # rows of the packed file keep their order
    packed = [p for p in after if "packed" in p and "even" in p]
    ids = [r["id"] for r in spark.read.parquet(packed[0]).collect()]
    assert ids == sorted(ids)


def test_compaction_in_bins_of_the_target_size(spark, monkeypatch):
    path = scratch_path(spark, "bins")
    spark.range(30_000).selectExpr("id", "sha2(string(id), 256) as s").repartition(30).write.parquet(path)
    content, size = rows(spark.read.parquet(path)), sum(files(spark, path).values())
    monkeypatch.setattr(compaction, "FILES_PER_JOB", 7)  # several jobs
    compaction.compact_small(spark, path, target_mb=size / 5 / 1024**2)
    after = files(spark, path)
    assert 4 <= len(after) <= 6 and max(after.values()) < 2 * size / 5 and rows(spark.read.parquet(path)) == content


def test_an_interrupted_compaction_is_finished_or_forgotten(spark, monkeypatch):
    path = scratch_path(spark, "stop")
    spark.range(100).repartition(4).write.parquet(path)
    content = rows(spark.read.parquet(path))
    with monkeypatch.context() as m:  # dies before its journal
        m.setattr(compaction, "_journal", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            compaction.compact_small(spark, path)
    assert rows(spark.read.parquet(path)) == content and len(files(spark, path)) == 4
    bins = [(d, [r["path"] for r in compaction.list_files(spark, path).collect()]) for d in [next(iter(files(spark, path))).rsplit("/", 1)[0]]]
    compaction._rewrite(spark, path, bins)  # dies after its journal, half of the old files moved
    fs, old = hadoop_path(spark, bins[0][1][0])
    fs.mkdirs(hadoop_path(spark, f"{path}/_compact/old/0")[1])
    fs.rename(old, hadoop_path(spark, f"{path}/_compact/old/0/moved.parquet")[1])
    compaction.finish(spark, path)
    assert rows(spark.read.parquet(path)) == content and len(files(spark, path)) == 1


def test_compact_to_a_new_path_keeps_partition_folders(spark):
    src, dst = scratch_path(spark, "src"), scratch_path(spark, "dst")
    spark.range(90).selectExpr("id", "id % 3 as p").repartition(5).write.partitionBy("p").parquet(src)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    sinks.compact(spark, src, dst)
    assert {p.rsplit("/", 2)[1] for p in files(spark, dst)} == {"p=0", "p=1", "p=2"} and len(files(spark, dst)) == 3
    assert rows(spark.read.parquet(dst).select("id", F.col("p").cast("long"))) == [(i, i % 3) for i in range(90)]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_closed_versions_are_packed_at_compaction(spark):
    """Files of a version table don't grow with the number of runs: closed versions join a history."""
    from kairos.operators.scd import scd2_changes
    from kairos.sources.versions import VersionStore

    store = None
    for day in range(1, 8):
        at = F.lit(f"2024-01-0{day}").cast("timestamp_ntz")
        load = spark.range(4).select("id", F.lit(str(day)).alias("v"), at.alias("updated_at")).coalesce(1)
        changes = scd2_changes(store.open_rows(day - 2) if store else None, load, "id")
        store = store or VersionStore(spark, scratch_path(spark, "closed"), "id", changes.drop("_kind").schema, compact_every=3)
        store.write(day - 1, changes)
        assert store.table(day - 1).count() == 4 * day
    plan = store.table(6)._jdf.queryExecution().executedPlan().toString()
    used = store._closed(6, 6).inputFiles()
    assert plan and len(used) >= 1 and store._closed(6, 6).count() == 24
