"""SCD-2 history from a change log whose rows come late, repeated or shuffled (S5, E3, T-3).

A history alone can't take late rows: rows that changed nothing when they came were dropped, yet a late change
before them makes them the end of its version.  So the store keeps every observation (one per key and time) and
derives versions from them.  A batch rewrites the versions of the keys it touches and of no other key::

    {path}/seen/gen=N/...       observations of batch N
    {path}/versions/gen=N/...   all versions of the keys that batch N touched

Of a key the versions of the newest generation count.  Observations at the same key and time are one change, the
greatest by the other columns, so any order and any repetition of batches gives the history that one pass over all rows gives.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from kairos.operators.scd import scd2_from_changes
from kairos.operators.sequence import latest_per_key
from kairos.sources.commits import commit, committed, read_note


@dataclass
class SplicedHistory:
    """History of ``attrs`` per ``key`` under ``path``; a hot key is windowed by ``slice_unit``."""

    spark: SparkSession
    path: str
    key: str
    ts: str
    attrs: Sequence[str]
    slice_unit: str | None = "month"

    def _note(self) -> tuple[int, dict] | None:
        done = committed(self.spark, self.path)
        return (done[-1], read_note(self.spark, self.path, done[-1])) if done else None

    def _rows(self, name: str, schema: StructType, since: int, upto: int) -> DataFrame:
        full = StructType(list(schema.fields)).add("gen", IntegerType())
        return self.spark.read.schema(full).parquet(os.path.join(self.path, name)).where((F.col("gen") >= since) & (F.col("gen") <= upto))

    def apply(self, batch: DataFrame, number: int | None = None) -> None:
        """Take a batch of change rows in; ``number`` (a stream's batch id) makes a committed batch a no-op.

        Rows without a key or a time are no observation.
        """
        last = self._note()
        gen = number if number is not None else (last[0] + 1 if last else 0)
        if last is not None and gen <= last[0]:
            return
        since = last[1]["since"] if last else 0
        rows = batch.where(F.col(self.key).isNotNull() & F.col(self.ts).isNotNull())
        seen = latest_per_key(rows, [self.key, self.ts], []).select(*batch.columns)
        seen.write.mode("overwrite").parquet(os.path.join(self.path, "seen", f"gen={gen:06d}"))
        now = self._rows("seen", batch.schema, gen, gen)
        touched = now.select(self.key).distinct()
        # observations of the touched keys only, whenever they came
        known = self._rows("seen", batch.schema, since, gen).join(touched, self.key, "left_semi").select(*batch.columns)
        versions = scd2_from_changes(known, self.key, self.ts, list(self.attrs), self.slice_unit)
        versions.write.mode("overwrite").parquet(os.path.join(self.path, "versions", f"gen={gen:06d}"))
        commit(self.spark, self.path, gen, {"since": since, "seen": batch.schema.jsonValue(), "versions": versions.schema.jsonValue()})

    def history(self) -> DataFrame | None:
        """The versions after the last committed batch."""
        last = self._note()
        if last is None:
            return None
        rows = self._rows("versions", StructType.fromJson(last[1]["versions"]), last[1]["since"], last[0])
        newest = rows.groupBy(F.col(self.key).alias("_k")).agg(F.max("gen").alias("_g"))
        return rows.join(newest, (F.col(self.key) == F.col("_k")) & (F.col("gen") == F.col("_g"))).drop("_k", "_g", "gen")

    def compact(self) -> None:
        """Write observations and versions as one generation that later batches start from."""
        last = self._note()
        if last is None:
            return
        gen, schema = last[0] + 1, StructType.fromJson(last[1]["seen"])
        seen = latest_per_key(self._rows("seen", schema, last[1]["since"], last[0]).drop("gen"), [self.key, self.ts], [])
        seen.select(*schema.names).write.mode("overwrite").parquet(os.path.join(self.path, "seen", f"gen={gen:06d}"))
        self.history().write.mode("overwrite").parquet(os.path.join(self.path, "versions", f"gen={gen:06d}"))
        commit(self.spark, self.path, gen, {"since": gen, "seen": last[1]["seen"], "versions": last[1]["versions"]})
