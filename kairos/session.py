"""Session helpers: a tuned builder for tests/bench and the shared scratch area.

On a cluster the session is created by the platform; the library never
assumes it owns the session.  It only *reads* ``spark.checkpoint.dir`` (the
shared folder every executor can reach).  Without that setting a session on
one machine (``local``) gets a private temporary folder; any other master is an
error, because executors don't see a folder of the driver's machine.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: codec of stored layers: hexadecimal keys take half the space that snappy needs
LAYER_CODEC = "zstd"


def get_session(master: str | None = None, app: str = "kairos",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE and skew handling switched on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder from the session; a private one only on a single machine."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not _single_machine(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="kairos-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def _single_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder (its scheme kept)."""
    return os.path.join(checkpoint_dir(spark), "kairos", f"{name}-{uuid.uuid4().hex[:12]}")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of ``path`` on whatever storage holds it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def clear_scratch(spark: SparkSession) -> bool:
    """Delete the layers this library wrote under the checkpoint folder.

    Call it when no DataFrame over a layer is in use any more, e.g. at the end
    of a job; layers are never removed on their own.
    """
    fs, p = hadoop_path(spark, os.path.join(checkpoint_dir(spark), "kairos"))
    return fs.delete(p, True)


def cut_lineage(df):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    One job (a reliable RDD checkpoint would compute the plan twice), the
    result survives executor loss, and readers get a columnar scan with
    statistics.  Never ``localCheckpoint``.
    """
    path = scratch_path(df.sparkSession, "layer")
    df.write.mode("overwrite").option("compression", LAYER_CODEC).parquet(path)
    return df.sparkSession.read.parquet(path)
