"""Structured Streaming for the append-only logs (micro-batch, repeat-safe).

T-1 ingest_available      - file source -> Parquet sink, ``availableNow`` + checkpoint
T-2 dedup_within_lateness - ``withWatermark`` + ``dropDuplicatesWithinWatermark``
T-3 scd2_stream           - ``foreachBatch`` applying S1 to a version table; each batch
                            writes what it opened and closed as the generation of its
                            batch id (a retried batch writes the same rows again)
T-4 windowed_counts       - event-time tumbling counts with a watermark, emitted in
                            complete mode through ``foreachBatch`` (overwrite)

Event time arrives as TIMESTAMP_NTZ; watermarks need TIMESTAMP, so the stream
edge converts with ``ntz_to_instant`` (UTC wall time, session-zone independent)
and converts back for output.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairos.functions.scalars import instant_to_ntz, ntz_to_instant
from kairos.operators.scd import scd2_changes
from kairos.session import hadoop_path, scratch_path
from kairos.sources.versions import VersionStore


def stream_table(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A streaming DataFrame over the table ``{sf_dir}/{name}.parquet``, one file or a folder of files.

    ``max_files`` limits a micro-batch to that many files (None: all that are there).
    """
    path = os.path.join(sf_dir, f"{name}.parquet")
    return stream_path(spark, path, spark.read.parquet(path).schema, max_files)


def stream_path(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """A streaming DataFrame over a folder in which Parquet files may arrive later, or over one file.

    Spark streams folders only; of a single file's folder exactly that file is taken.
    """
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    fs, p = hadoop_path(spark, path)
    if fs.getFileStatus(p).isDirectory():
        return r.parquet(path)
    return r.option("pathGlobFilter", _literal_glob(p.getName())).parquet(os.path.dirname(path))


def _literal_glob(name: str) -> str:
    """A glob that matches ``name`` alone."""
    return "".join("\\" + c if c in "\\*?[]{}," else c for c in name)


def ingest_available(stream: DataFrame, out_path: str, checkpoint: str) -> str:
    """T-1: append everything available now to a Parquet table; exactly-once via the checkpoint."""
    q = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(out_path))
    q.awaitTermination()
    return out_path


def dedup_within_lateness(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """T-2: drop repeats of ``keys`` arriving within ``delay`` of each other (bounded state)."""
    return (stream.withColumn("_et", ntz_to_instant(event_time))
            .withWatermark("_et", delay)
            .dropDuplicatesWithinWatermark(keys)
            .drop("_et"))


def scd2_stream(stream: DataFrame, key: str, updated_at: str, base: str, checkpoint: str) -> DataFrame:
    """T-3: every micro-batch is one load applied to the stored history with S1.

    Batch ``i`` writes generation ``i`` of a version table: what it opened and closed.
    It derives from generations below ``i`` and the batch alone, so a retried batch
    writes the same rows again.  Returns the history after the last batch.
    """
    spark = stream.sparkSession
    schema = scd2_changes(None, spark.createDataFrame([], stream.schema), key, updated_at).drop("_kind").schema
    store = VersionStore(spark, base, key, schema)

    def apply(batch: DataFrame, batch_id: int) -> None:
        before = store.open_rows(batch_id - 1) if batch_id else None
        store.write(batch_id, scd2_changes(before, batch, key, updated_at))

    q = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    gens = [int(p[4:]) for p in list_dir(spark, base) if p.startswith("gen=")]
    return store.table(max(gens, default=0))


def scd2_change_stream(stream: DataFrame, key: str, ts: str, attrs: list[str], base: str, checkpoint: str) -> DataFrame:
    """T-3 for change rows that come late: every micro-batch is spliced into the stored history.

    A retried batch that was committed changes nothing.  Returns the history after the last batch.
    """
    from kairos.sources.spliced import SplicedHistory

    store = SplicedHistory(stream.sparkSession, base, key, ts, attrs)
    q = (stream.writeStream.foreachBatch(store.apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return store.history()


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names under ``path`` on whatever file system holds it."""
    fs, p = hadoop_path(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def windowed_counts(stream: DataFrame, event_time: str, window: str, delay: str, by: list[str]) -> DataFrame:
    """T-4: tumbling event-time counts with a watermark (window bounds as TIMESTAMP_NTZ)."""
    g = (stream.withColumn("_et", ntz_to_instant(event_time))
         .withWatermark("_et", delay)
         .groupBy(F.window("_et", window).alias("w"), *by)
         .agg(F.count(F.lit(1)).alias("n_rows")))
    return g.select(instant_to_ntz("w.start").alias("window_start"), instant_to_ntz("w.end").alias("window_end"),
                    *by, "n_rows")


def run_complete(agg: DataFrame, out_path: str, checkpoint: str) -> str:
    """Run an aggregating stream in complete mode; each batch overwrites the full result."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    q = (agg.writeStream.outputMode("complete").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


def run_updates(agg: DataFrame, out_path: str, checkpoint: str, keys: list[str], on_batch=None) -> DataFrame:
    """Run an aggregating stream in update mode; the table after the last batch.

    Batch ``i`` writes the windows it changed to ``gen=i`` (a retried batch overwrites its own), and of every
    window and key the row of the latest batch counts.  The watermark lets Spark drop the state of windows that are over,
    so state follows the open windows; rows later than the watermark's delay aren't counted any more.
    ``on_batch`` gets the progress of each batch (for monitoring).
    """
    spark, schema = agg.sparkSession, agg.schema

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out_path, f"gen={batch_id:06d}"))

    q = (agg.writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    for p in q.recentProgress if on_batch else []:
        on_batch(p)
    return latest_windows(spark, out_path, schema, keys)


def latest_windows(spark: SparkSession, out_path: str, schema, keys: list[str]) -> DataFrame:
    """The row of the latest batch for every window and key of what ``run_updates`` wrote."""
    from pyspark.sql.types import IntegerType, StructType

    rows = spark.read.schema(StructType(list(schema.fields)).add("gen", IntegerType())).parquet(out_path)
    rest = [c for c in schema.names if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "gen").alias("_r")).select(*keys, "_r.*").select(*schema.names)


# --- registered queries over the driver tables ------------------------------

def q_t1_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "t1-events")
    ingest_available(stream_table(spark, sf_dir, "events"), out, out + "-ckpt")
    return spark.read.parquet(out)


def q_t2_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "t2-lineitem-keys")
    s = stream_table(spark, sf_dir, "lineitem")
    # repeats of a line lie anywhere in the log, so the whole log is one trigger's lateness
    d = dedup_within_lateness(s, ["l_orderkey", "l_linenumber"], "l_shipdate", "30 days")
    ingest_available(d.select("l_orderkey", "l_linenumber"), out, out + "-ckpt")
    return spark.read.parquet(out)


# the events log arrives in three parts, each a micro-batch of a resumed stream
T3_CUTOFFS = ["2024-01-11 00:00:00", "2024-01-21 00:00:00", None]


def q_t3_stream_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, base = scratch_path(spark, "t3-landing"), scratch_path(spark, "t3-user-status")
    ev = (spark.read.parquet(os.path.join(sf_dir, "events.parquet")).where(F.col("event_type") != "purchase")
          .select("user_id", "event_type", F.col("ts").alias("updated_at")))
    low, out = None, None
    for high in T3_CUTOFFS:
        part = ev if low is None else ev.where(F.col("updated_at") >= F.lit(low).cast("timestamp_ntz"))
        part = part if high is None else part.where(F.col("updated_at") < F.lit(high).cast("timestamp_ntz"))
        part.write.mode("append").parquet(landing)
        out = scd2_stream(stream_path(spark, landing, ev.schema), "user_id", "updated_at", base, base + "-ckpt")
        low = high
    return out


def q_t3_late_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status changes that arrive in three parts which overlap in time, each a micro-batch of a resumed stream."""
    landing, base = scratch_path(spark, "t3-late"), scratch_path(spark, "t3-spliced")
    ev = (spark.read.parquet(os.path.join(sf_dir, "events.parquet")).where(F.col("event_type") != "purchase")
          .select("event_id", "user_id", "event_type", "ts"))
    for part in (2, 0, 1):
        ev.where(F.col("event_id") % 3 == part).drop("event_id").write.mode("append").parquet(landing)
        out = scd2_change_stream(stream_path(spark, landing, ev.drop("event_id").schema), "user_id", "ts", ["event_type"], base, base + "-ckpt")
    return out


def q_t4_stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "t4-counts")
    agg = windowed_counts(stream_table(spark, sf_dir, "events"), "ts", "1 day", "1 day", ["event_type"])
    run_complete(agg, out, out + "-ckpt")
    return spark.read.parquet(out)


def q_t4_stream_window_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events log arrives in three parts, each counted by a stream that goes on where the last one stopped."""
    landing, out = scratch_path(spark, "t4-landing"), scratch_path(spark, "t4-updates")
    ev = spark.read.parquet(os.path.join(sf_dir, "events.parquet")).select("event_id", "ts", "event_type")
    low = None
    for high in T3_CUTOFFS:
        part = ev if low is None else ev.where(F.col("ts") >= F.lit(low).cast("timestamp_ntz"))
        part = part if high is None else part.where(F.col("ts") < F.lit(high).cast("timestamp_ntz"))
        part.write.mode("append").parquet(landing)
        agg = windowed_counts(stream_path(spark, landing, ev.schema), "ts", "1 day", "1 day", ["event_type"])
        got = run_updates(agg, out, out + "-ckpt", ["window_start", "window_end", "event_type"])
        low = high
    return got


STREAM_QUERIES = {
    "t1_stream_ingest": q_t1_stream_ingest,
    "t2_stream_dedup": q_t2_stream_dedup,
    "t3_stream_scd2": q_t3_stream_scd2,
    "t3_late_changes": q_t3_late_changes,
    "t4_stream_window_counts": q_t4_stream_window_counts,
    "t4_stream_window_updates": q_t4_stream_window_updates,
}
