import os

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from kairos.session import hadoop_path, scratch_path
from kairos.sources import raw as R
from kairos.sources import sinks
from kairos.streaming import micro_batch as S

SF = "/root/testdata/sf0.001"


def test_upsert_replaces_and_checks_schema(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    b = spark.createDataFrame([(2, "B"), (3, "c")], "k long, v string")
    assert rows(sinks.upsert(t, b, ["k"])) == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(sinks.upsert(sinks.upsert(t, b, ["k"]), b, ["k"])) == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(sinks.SchemaChangeError):
        sinks.upsert(t, b.withColumn("extra", F.lit(1)), ["k"])


def test_append_after_high_water(spark):
    t = spark.createDataFrame([(1,), (2,)], "k long")
    b = spark.createDataFrame([(2,), (3,), (4,)], "k long")
    assert rows(sinks.append_after(t, b, "k")) == [(1,), (2,), (3,), (4,)]
    path = scratch_path(spark, "append-after")
    sinks.load_append_after(t, path, "k")
    sinks.load_append_after(b, path, "k")
    assert rows(spark.read.parquet(path), "k") == [(1,), (2,), (3,), (4,)]


def test_compare_frames_and_mask(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k long, v string")
    new = spark.createDataFrame([(1, "a"), (2, "x"), (3, None), (4, "d")], "k long, v string")
    assert rows(sinks.compare_frames(old, new, ["k"])) == [(1, "same"), (2, "changed"), (3, "same"), (4, "added")]
    m = sinks.mask_columns(old, ["v"])
    assert m.where("k = 1").first()["v"] == "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb"
    assert sinks.mask_columns(old, ["v"], how="drop").columns == ["k"]


def test_append_after_reports_a_damaged_target(spark):
    path = scratch_path(spark, "damaged")
    fs, p = hadoop_path(spark, path + "/part-0.parquet")
    out = fs.create(p)
    out.write(bytearray(b"not a parquet file"))
    out.close()
    with pytest.raises(Exception, match="(?i)parquet|footer|schema"):
        sinks.load_append_after(spark.createDataFrame([(1,)], "k long"), path, "k")


def test_partitioned_backfill_is_idempotent(spark):
    path = scratch_path(spark, "backfill")
    df = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2)], "ds string, n long")
    sinks.backfill(df, path, "ds")
    sinks.backfill(df.withColumn("n", F.col("n") * 10), path, "ds", parts=["2024-01-02"])
    assert rows(spark.read.parquet(path), "n") == [(1,), (20,)]


def test_writers_make_few_and_split_files(spark):
    fs, _ = hadoop_path(spark, "/")

    def files(path):
        return [p for p in spark.read.parquet(path).inputFiles()]

    df = spark.range(0, 20_000, 1, 16).select((F.col("id") % 2).alias("part"), F.col("id").alias("v"))
    p = scratch_path(spark, "parted")
    sinks.write_partitioned(df, p, ["part"])
    assert len(files(p)) < 16  # not one file per task and value
    c = scratch_path(spark, "clustered")
    sinks.write_clustered(df, c, ["part"], ["v"], num_partitions=8)
    assert len(files(c)) >= 6  # a value's rows spread over several tasks
    spans = sorted((r.lo, r.hi) for r in spark.read.parquet(c).where("part = 0").groupBy(F.input_file_name().alias("f"))
                   .agg(F.min("v").alias("lo"), F.max("v").alias("hi")).collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))  # files cover separate ranges
    small = scratch_path(spark, "small")
    df.repartition(16).write.parquet(small)
    plan = spark.sparkContext
    out = sinks.compact(spark, small, scratch_path(spark, "compacted"), 128)
    assert len(files(out)) == 1 and spark.read.parquet(out).count() == 20_000
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None and plan is spark.sparkContext


def test_checkpoint_folder_must_be_shared(spark, monkeypatch):
    from kairos import session

    class Cluster:
        class sparkContext:
            master = "yarn"

            @staticmethod
            def getCheckpointDir():
                return None

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Cluster)
    assert session._single_machine("local[4]") and not session._single_machine("local-cluster[2,1,1024]")


def test_write_as_roundtrip(spark):
    df = R.raw_orders_current(spark, SF)
    for fmt, codec in (("csv", "gzip"), ("json", "lz4"), ("orc", "snappy"), ("parquet", "lz4")):
        p = sinks.write_as(df, scratch_path(spark, f"fmt-{fmt}"), fmt, codec)
        assert rows(sinks.read_as(spark, p, df.schema, fmt)) == rows(df)


def test_stream_windowed_counts_match_batch(spark):
    out = scratch_path(spark, "t4")
    agg = S.windowed_counts(S.stream_table(spark, SF, "events"), "ts", "1 day", "1 day", ["event_type"])
    S.run_complete(agg, out, out + "-ckpt")
    got = spark.read.parquet(out)
    ev = R.read_raw(spark, SF, "events")
    want = ev.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start"), "event_type").count()
    assert rows(got, "window_start", "event_type", "n_rows") == rows(want)


def test_streams_read_a_folder_of_files(spark, tmp_path):
    """A table that is a folder of part files streams the same rows as one that is a file."""
    d = str(tmp_path)
    R.read_raw(spark, SF, "events").repartition(5).write.parquet(f"{d}/events.parquet")
    R.read_raw(spark, SF, "lineitem").repartition(3).write.parquet(f"{d}/lineitem.parquet")
    R.read_raw(spark, SF, "events").limit(5).write.parquet(f"{d}/events_other.parquet")  # another table
    for name, q in S.STREAM_QUERIES.items():
        assert rows(q(spark, d)) == rows(q(spark, SF)), name
    out = scratch_path(spark, "t1-files")
    S.ingest_available(S.stream_table(spark, d, "events", max_files=2), out, out + "-ckpt")
    assert spark.read.parquet(out).count() == R.read_raw(spark, SF, "events").count()


def test_dedup_forgets_beyond_the_delay(spark, tmp_path):
    """A repeat within the delay is dropped; one that arrives after the watermark passed its first is kept."""
    src, out = str(tmp_path / "src"), scratch_path(spark, "t2-late")
    schema = "k long, t timestamp_ntz"
    for day in ("2024-01-01", "2024-01-02", "2024-01-20", "2024-02-20"):
        k = 1 if day != "2024-01-20" else 2
        spark.createDataFrame([(k, ts(day))], schema).coalesce(1).write.mode("append").parquet(src)
        d = S.dedup_within_lateness(S.stream_path(spark, src, spark.read.parquet(src).schema), ["k"], "t", "5 days")
        S.ingest_available(d, out, out + "-ckpt")
    assert rows(spark.read.parquet(out), "k", "t") == [(1, ts("2024-01-01")), (1, ts("2024-02-20")), (2, ts("2024-01-20"))]


def test_stream_scd2_batches_equal_batch_snapshot(spark, tmp_path):
    """Two files arrive as two micro-batches; the result equals two S1 loads."""
    from kairos.operators.scd import scd2_snapshot
    from kairos.operators.sequence import latest_per_key

    src = str(tmp_path / "src")
    os.makedirs(src)
    a = spark.createDataFrame([(1, "x", ts("2024-01-01")), (2, "y", ts("2024-01-01"))],
                              "user_id long, event_type string, updated_at timestamp_ntz")
    b = spark.createDataFrame([(1, "z", ts("2024-01-02")), (3, "w", ts("2024-01-02"))],
                              "user_id long, event_type string, updated_at timestamp_ntz")
    a.coalesce(1).write.parquet(src + "/batch=1")
    b.coalesce(1).write.parquet(src + "/batch=2")
    stream = (spark.readStream.schema(a.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(src))
    base = scratch_path(spark, "t3-test")
    history = S.scd2_stream(stream, "user_id", "updated_at", base, base + "-ckpt")
    expected = scd2_snapshot(scd2_snapshot(None, latest_per_key(a, ["user_id"], ["updated_at"]), "user_id"),
                             latest_per_key(b, ["user_id"], ["updated_at"]), "user_id")
    assert rows(history) == rows(expected.select(*history.columns))
