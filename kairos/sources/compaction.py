"""Selective compaction of Parquet folders (A13): small files only, partition by partition.

``plan`` lists the files with their sizes (no file is opened) and packs the small ones
of each directory into bins of about the target size; directories keep their place and large files
are not touched.  ``compact_small`` rewrites the bins, each as one file with its rows in their old
order, and publishes them::

    {path}/_compact/new/_bin=K/...   packed files, invisible to readers
    {path}/_compact/journal.json     what replaces what; written when all packed files are there
    {path}/_compact/old/...          replaced files, until the end

Without a journal a job that died has changed nothing; with one, the next call goes on where it stopped.
Plain Parquet folders have no transaction: while a bin is exchanged (renames, no copying) a reader by path
can miss its rows.  Tables read by commit notes don't have that gap.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kairos.session import hadoop_path

#: files rewritten by one job: bounds the paths that the driver names and the plan that is broadcast
FILES_PER_JOB = 10_000


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(dir, path, length, modified) of the Parquet files under ``path``; hidden folders are left out."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
             .load(path).select("path", "length", "modificationTime"))
    return files.select(F.regexp_replace("path", "/[^/]*$", "").alias("dir"), "path", "length", F.col("modificationTime").alias("modified"))


def plan(spark: SparkSession, path: str, target_mb: float = 128, small: float = 0.75) -> DataFrame:
    """(dir, bin, path, length, modified): small files (under ``small`` of the target) by the bin they are packed into.

    Files of a directory fill bins in the order of writing, so loads that follow each other stay together.
    A bin of one file is left as it is.
    """
    target = int(target_mb * 1024 * 1024)
    w = Window.partitionBy("dir").orderBy("modified", "path").rowsBetween(Window.unboundedPreceding, -1)
    files = list_files(spark, path).where(F.col("length") < small * target)
    placed = files.withColumn("bin", F.floor(F.coalesce(F.sum("length").over(w), F.lit(0)) / target))
    return placed.withColumn("_n", F.count("*").over(Window.partitionBy("dir", "bin"))).where("_n > 1").select("dir", "bin", "path", "length", "modified")


def compact_small(spark: SparkSession, path: str, target_mb: float = 128, small: float = 0.75) -> int:
    """Pack the small files under ``path`` in place; the number of files that went."""
    finish(spark, path)
    bins = [(r["dir"], [f["path"] for f in r["files"]]) for r in
            plan(spark, path, target_mb, small).groupBy("dir", "bin").agg(F.array_sort(F.collect_list(F.struct("modified", "path"))).alias("files"))
            .orderBy("dir", "bin").toLocalIterator()]
    done = 0
    while bins:
        job, n = [], 0
        while bins and (not job or n + len(bins[0][1]) <= FILES_PER_JOB):
            job.append(bins.pop(0))
            n += len(job[-1][1])
        _rewrite(spark, path, job)
        finish(spark, path)
        done += n
    return done


def _rewrite(spark: SparkSession, path: str, bins: list[tuple[str, list[str]]]) -> None:
    as_uri = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    named = [(as_uri(p).toUri().toString(), i, k) for i, (_, files) in enumerate(bins) for k, p in enumerate(files)]
    of = spark.createDataFrame(named, "_path string, _bin int, _at int")  # at most FILES_PER_JOB rows
    rows = spark.read.parquet(*[p for _, files in bins for p in files])
    cols = rows.columns
    rows = rows.select(*[F.col(f"`{c}`") for c in cols], F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
    packed = (rows.join(F.broadcast(of), "_path").repartitionById(len(bins), F.col("_bin")).sortWithinPartitions("_bin", "_at", "_row"))
    new = os.path.join(path, "_compact", "new")
    packed.select(*[F.col(f"`{c}`") for c in cols], "_bin").write.mode("overwrite").partitionBy("_bin").parquet(new)
    fs, p = hadoop_path(spark, new)
    made = {}
    for d in fs.listStatus(p):
        name = d.getPath().getName()
        if name.startswith("_bin="):
            made[int(name[5:])] = [f.getPath().toString() for f in fs.listStatus(d.getPath()) if f.getPath().getName().endswith(".parquet")]
    _journal(spark, path, [{"dir": d, "old": files, "new": made.get(i, [])} for i, (d, files) in enumerate(bins)])


def _journal(spark: SparkSession, path: str, note: list[dict]) -> None:
    """Write what is to be exchanged, under a name that appears at once."""
    fs, tmp = hadoop_path(spark, os.path.join(path, "_compact", "journal.tmp"))
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps(note).encode()))
    out.close()
    fs.rename(tmp, hadoop_path(spark, os.path.join(path, "_compact", "journal.json"))[1])


def finish(spark: SparkSession, path: str) -> None:
    """Carry out what a journal says (again, where it was begun), and remove the compaction's folder."""
    fs, work = hadoop_path(spark, os.path.join(path, "_compact"))
    _, journal = hadoop_path(spark, os.path.join(path, "_compact", "journal.json"))
    if fs.exists(journal):
        note = json.loads("".join(r[0] for r in spark.read.text(journal.toString()).collect()))
        to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for i, b in enumerate(note):
            aside = to(work, f"old/{i}")
            fs.mkdirs(aside)
            for p in b["old"]:
                if fs.exists(to(p)) and not fs.rename(to(p), to(aside, os.path.basename(p))):
                    raise RuntimeError(f"{p} could not be moved")
            for p in b["new"]:
                # a name of its own: parts of different jobs may be called alike
                if fs.exists(to(p)) and not fs.rename(to(p), to(b["dir"] + f"/packed-{i:05d}-{os.path.basename(p)}")):
                    raise RuntimeError(f"{p} could not be moved")
    if fs.exists(work):
        fs.delete(work, True)
