"""Sinks and write modes.

A2 load_replace, A3 load_append_after, A6 write_table, A7 upsert, A9
check_same_schema, A11 write_partitioned, A12 write_clustered, A13 compact,
A14 backfill, A15 compare_frames, A18 write_as / read_as, A21 mask_columns
(A17, a watermark load, is ``scd.newer_than``).

Parquet paths are never overwritten while being read: every stateful write
goes to a new generation directory (see ``plans/incremental.py``).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kairos.session import path_exists


class SchemaChangeError(ValueError):
    pass


def check_same_schema(a: DataFrame, b: DataFrame, ignore: Iterable[str] = ()) -> None:
    """Fail when column names or types differ (``on_schema_change='fail'``)."""
    ig = set(ignore)
    sa = [(f.name, f.dataType.simpleString()) for f in a.schema.fields if f.name not in ig]
    sb = [(f.name, f.dataType.simpleString()) for f in b.schema.fields if f.name not in ig]
    if sorted(sa) != sorted(sb):
        raise SchemaChangeError(f"schema changed: {sorted(set(sa) ^ set(sb))}")


def one_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """A batch with one row per key: the latest by ``order``, or without an order any repeated key fails the job.

    Rows with a null in a key equal no other row and pass unchanged.
    """
    from kairos.operators.sequence import latest_per_key

    keys = list(keys)
    null = F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x)
    keyed, others = batch.where(~null), batch.where(null)
    if order:
        return latest_per_key(keyed, keys, list(order)).select(*batch.columns).unionByName(others)
    rest = [c for c in batch.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest]) if rest else F.lit(True)
    said = F.concat(F.lit("repeated key in the batch: "), F.to_json(F.struct(*keys)))
    one = keyed.groupBy(*keys).agg(F.any_value(row).alias("_r"), F.count(F.lit(1)).alias("_n"))
    checked = F.when(F.col("_n") == 1, F.col("_r")).otherwise(F.raise_error(said)).alias("_r")
    one = one.select(*keys, checked)
    one = one.select(*keys, "_r.*") if rest else one.where("_r").select(*keys)
    return one.select(*batch.columns).unionByName(others)


def upsert(target: DataFrame | None, batch: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Incremental merge on unique ``keys``: batch rows replace target rows.

    ``target`` anti-joined with the batch keys, plus the batch (MERGE is not
    available on plain Parquet tables).  A key that the batch holds twice fails the job, as a
    merge would; with ``order`` its latest row counts.
    """
    batch = one_per_key(batch, keys, order)
    if target is None:
        return batch
    check_same_schema(target, batch)
    keys = list(keys)
    return target.join(batch.select(*keys), keys, "left_anti").unionByName(batch.select(*target.columns))


def load_replace(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """A2: full-replace load; re-running with the same input gives the same table."""
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> str:
    """Materialise a mart as a table (overwrite)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def high_water(spark: SparkSession, target_path: str, key_col: str):
    """Largest ``key_col`` already stored at ``target_path`` (None if the path doesn't exist).

    Any failure to read an existing table is an error: taking it for "no table"
    would append the whole batch a second time.
    """
    if not path_exists(spark, target_path):
        return None
    return spark.read.parquet(target_path).agg(F.max(key_col)).first()[0]


def load_append_after(df: DataFrame, target_path: str, key_col: str,
                      loaded_at_col: str = "_loaded_at") -> DataFrame:
    """A3: append rows with ``key_col`` beyond the stored high-water key; return them."""
    spark = df.sparkSession
    last = high_water(spark, target_path, key_col)
    new = df if last is None else df.where(F.col(key_col) > F.lit(last))
    if loaded_at_col not in new.columns:
        new = new.withColumn(loaded_at_col, F.localtimestamp())
    new.write.mode("append").parquet(target_path)
    return new


def append_after(target: DataFrame | None, batch: DataFrame, key_col: str) -> DataFrame:
    """A3 as a pure function: ``target`` plus batch rows beyond ``MAX(target.key_col)``."""
    if target is None:
        return batch
    hw = target.agg(F.max(key_col)).scalar()  # scalar subquery, computed once
    return target.unionByName(batch.where(hw.isNull() | (F.col(key_col) > hw)))


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str], mode: str = "overwrite",
                      dynamic: bool = True) -> str:
    """Partitioned write; ``dynamic`` overwrites only the partitions present.

    Rows are rebalanced on the partition columns first: a partition gets a few files
    instead of one from every task, and AQE splits a large one.
    """
    w = df.hint("rebalance", *cols).write.mode(mode).partitionBy(*cols)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)
    return path


def write_clustered(df: DataFrame, path: str, part: Sequence[str], sort: Sequence[str],
                    num_partitions: int | None = None) -> str:
    """Cluster rows by ``part`` and sort within each file by ``sort`` (block skipping).

    Ranges over (part, sort) deal the rows out, so a frequent ``part`` value spreads
    over several tasks and its files cover separate ranges of ``sort``.
    """
    d = df.repartitionByRange(num_partitions, *part, *sort) if num_partitions else df.repartitionByRange(*part, *sort)
    d.sortWithinPartitions(*part, *sort).write.mode("overwrite").partitionBy(*part).parquet(path)
    return path


def compact(spark: SparkSession, src_path: str, dst_path: str, target_mb: int = 128) -> str:
    """Rewrite many small files as files of about ``target_mb`` to a new path, partition directories kept.

    Scan tasks take whole files up to the target size and write one file each (a
    partitioned table: one for each partition they hold): no shuffle, and rows of a file stay together.  ``compaction.compact_small`` packs
    a table's small files in place.  The packing options are set in a session of their own.
    """
    size = str(target_mb * 1024 * 1024)
    own = spark.newSession()
    for k, v in (("maxPartitionBytes", size), ("openCostInBytes", "0"), ("minPartitionNum", "1")):
        own.conf.set(f"spark.sql.files.{k}", v)
    rows = own.read.parquet(src_path)
    files = rows.inputFiles()
    inside = [c.split("=", 1)[0] for c in (files[0].split("/")[:-1] if files else []) if "=" in c]
    parts = [c for c in inside if c in rows.columns and c not in own.read.parquet(files[0]).columns]
    w = rows.write.mode("overwrite")
    (w.partitionBy(*parts) if parts else w).parquet(dst_path)
    return dst_path


def backfill(df: DataFrame, path: str, partition_col: str = "ds", parts: Iterable | None = None) -> str:
    """Rebuild partitions in one pass with dynamic overwrite (idempotent).

    ``df`` carries ``partition_col``; ``parts`` limits the run to some of its values
    (None: all).  Partitions that the run doesn't hold stay as they are.
    """
    if parts is not None:
        df = df.where(F.col(partition_col).isin(list(parts)))
    return write_partitioned(df, path, [partition_col], dynamic=True)


def compare_frames(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key, whether the row is only in old, only in new, changed or equal.

    One full outer join on the keys; value comparison is null-safe.
    """
    keys = list(keys)
    vals = [c for c in old.columns if c not in keys]
    o = old.select(*keys, F.struct(*vals).alias("_o"))
    n = new.select(*keys, F.struct(*[F.col(c) for c in vals]).alias("_n"))
    j = o.join(n, keys, "full_outer")
    status = (F.when(F.col("_n").isNull(), "removed").when(F.col("_o").isNull(), "added")
              .when(F.col("_o").eqNullSafe(F.col("_n")), "same").otherwise("changed"))
    return j.select(*keys, status.alias("status"))


def compare_summary(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A15 summary: row counts by status (one aggregate pass over the comparison)."""
    return compare_frames(old, new, keys).groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"))


def write_as(df: DataFrame, path: str, fmt: str = "parquet", codec: str | None = None) -> str:
    """Write as csv / json / parquet / orc with an optional codec (gzip, snappy, lz4, zstd)."""
    if fmt not in {"csv", "json", "parquet", "orc"}:
        raise ValueError(f"unsupported format {fmt!r}")
    w = df.write.mode("overwrite").format(fmt)
    if codec:
        w = w.option("compression", codec)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)
    return path


def read_as(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """Read back what ``write_as`` wrote, with its schema (text formats carry none)."""
    r = spark.read.schema(schema).format(fmt)
    return (r.option("header", True) if fmt == "csv" else r).load(path)


def mask_columns(df: DataFrame, cols: Sequence[str], how: str = "hash") -> DataFrame:
    """Keep sensitive columns out at load: sha2-256 hash, or drop."""
    if how == "drop":
        return df.drop(*cols)
    return df.select(*[F.sha2(F.col(c).cast("string"), 256).alias(c) if c in cols else F.col(c)
                       for c in df.columns])

