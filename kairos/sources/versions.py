"""Stored version tables whose runs write only what changed.

Layout: ``{path}/gen=N/_kind=base|history|opened|closed``.  Run N writes the versions it
opened and the versions it closed, nothing else.  Every ``compact_every`` runs
(and in run 0) the whole open set is written as ``base``, and the versions closed since the
last such run together as ``history``, so files don't grow with the number of runs.  So

* open versions at N = the last base and the versions opened since, without those of keys
  that a later run closed;
* table at N = history up to the last base, closed versions since, and the open versions at N.

Both read with partition pruning; the deltas since the last base are small
beside it.  A generation directory is written by one run and never changed, a
repeated run overwrites its own directory with the same rows.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from kairos.session import LAYER_CODEC, path_exists

COMPACT_EVERY = 30


@dataclass
class VersionStore:
    """Versions of one table under ``path``; ``key`` has at most one open version."""

    spark: SparkSession
    path: str
    key: str
    schema: StructType  # of the versions, without gen and _kind
    compact_every: int = COMPACT_EVERY

    def _all(self) -> DataFrame:
        return self._read([self.path])

    def _read(self, paths: list[str]) -> DataFrame:
        full = StructType(list(self.schema.fields)).add("gen", IntegerType()).add("_kind", StringType())
        return self.spark.read.schema(full).option("basePath", self.path).parquet(*paths)

    def touched(self, gen: int) -> DataFrame:
        """What generation ``gen`` opened or closed, with ``_kind``."""
        kinds = ["base"] if gen == 0 else ["opened", "closed"]
        return self._all().where((F.col("gen") == gen) & F.col("_kind").isin(kinds)).drop("gen")

    def open_rows(self, gen: int) -> DataFrame:
        """The open versions at generation ``gen``."""
        last = gen - gen % self.compact_every
        rows = self._all()
        base = rows.where((F.col("gen") == last) & (F.col("_kind") == "base")).drop("gen", "_kind")
        if gen == last:
            return base
        # a run that opens a version of a key closes the one before it: what is open is not found by the opened keys but by the
        # few closed ones, and neither the base nor the opened versions cross a shuffle for it
        since = rows.where((F.col("gen") > last) & (F.col("gen") <= gen) & (F.col("_kind") == "opened") & F.col(self.key).isNotNull())
        held = base.withColumn("gen", F.lit(last)).unionByName(since.drop("_kind"))
        # read by their folders: the planner takes a scan for as large as the folders it is given, whatever partitions it leaves out
        folders = [os.path.join(self.path, f"gen={g:06d}", "_kind=closed") for g in range(last + 1, gen + 1)]
        folders = [f for f in folders if path_exists(self.spark, f)]
        if not folders:
            return held.drop("gen")
        closed = self._read(folders).groupBy(F.col(self.key).alias("_tk")).agg(F.max("gen").alias("_tg"))
        return held.join(closed, (F.col(self.key) == F.col("_tk")) & (F.col("gen") < F.col("_tg")), "left_anti").drop("gen")

    def table(self, gen: int) -> DataFrame:
        """All versions at generation ``gen``."""
        return self._closed(gen, gen - gen % self.compact_every).unionByName(self.open_rows(gen))

    def _closed(self, gen: int, last: int) -> DataFrame:
        """Versions closed up to ``gen``: history of generations up to ``last`` and what was closed after it."""
        since = (F.col("_kind") == "closed") & (F.col("gen") > last)
        return (self._all().where((F.col("gen") <= gen) & (((F.col("_kind") == "history") & (F.col("gen") <= last)) | since))
                .drop("gen", "_kind"))

    def write(self, gen: int, changes: DataFrame) -> None:
        """Write generation ``gen``: ``changes`` are versions with ``_kind`` opened or closed."""
        if gen == 0:
            changes = changes.withColumn("_kind", F.when(F.col("_kind") == "opened", "base").otherwise(F.col("_kind")))
        target = os.path.join(self.path, f"gen={gen:06d}")
        changes.select(*self.schema.names, "_kind").write.mode("overwrite").option("compression", LAYER_CODEC).partitionBy("_kind").parquet(target)
        if gen and gen % self.compact_every == 0:
            # the open set before this run, then this run's changes on top
            before, now = self.open_rows(gen - 1), self.touched(gen)
            opened = now.where(F.col("_kind") == "opened").drop("_kind")
            base = before.join(now.select(F.col(self.key).alias("_tk")).distinct(), F.col(self.key) == F.col("_tk"), "left_anti")
            base.unionByName(opened).write.mode("overwrite").option("compression", LAYER_CODEC).parquet(os.path.join(target, "_kind=base"))
            closed = self._all().where((F.col("gen") > gen - self.compact_every) & (F.col("gen") <= gen) & (F.col("_kind") == "closed"))
            closed.drop("gen", "_kind").write.mode("overwrite").option("compression", LAYER_CODEC).parquet(os.path.join(target, "_kind=history"))
