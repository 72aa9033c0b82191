"""Stored facts whose links to versioned parents follow late parents.

A fact is staged once, with the surrogate keys of its parents' versions at the
fact's time.  A link can be wrong later on for two reasons only:

* it is *pending*: no version covered the fact's time, so the link is the
  parent's current version or none.  Any change of that parent may alter it;
* it is *settled*, but a version that starts at or before the fact's time opens
  afterwards (the version came late).

So a run relinks pending facts of the parents it touched, and settled facts at or
after the start of a version it opened, and writes those whose links differ.

Layout: ``{path}/gen=N/_set=first|again/_link=...``.  ``first`` rows (``_link=settled|pending``)
were staged in run N, ``again`` rows replace an earlier row of their id; the row of the
highest generation counts.  The ``_link`` of ``again`` rows also says how the id's first row was
linked (``settled_was_pending``), so that readers compare the few late settled rows with the settled ones
and the others with the pending ones; without that (older files) they are compared with both.
A generation's directory is written by one run.  Facts without
an id are kept but never relinked.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from kairos.functions.scalars import text_packed, text_unpacked
from kairos.session import LAYER_CODEC, hadoop_path

#: column of the enriched rows that tells whether every link is by a covering version
SETTLED = "_settled"
#: column that tells whether the first row of a fact's id was pending (null: not known)
WAS_PENDING = "_was_pending"


@dataclass
class FactStore:
    """Facts of one log under ``path``, one row per ``key``."""

    spark: SparkSession
    path: str
    key: str
    time: str
    schema: StructType  # of the facts, without the store's own columns

    def _all(self, gen: int) -> DataFrame:
        return self._read([self.path]).where(F.col("gen") <= gen)

    def _read(self, paths: list[str]) -> DataFrame:
        full = StructType(list(self.schema.fields)).add("gen", IntegerType()).add("_set", StringType()).add("_link", StringType())
        return self.spark.read.schema(full).option("basePath", self.path).parquet(*paths)

    def _again_folders(self, gen: int) -> dict[str, tuple[int, str]]:
        """Folders of ``again`` rows up to generation ``gen``: the generation and ``_link`` of each."""
        fs, root = hadoop_path(self.spark, self.path)
        found = {}
        for run in fs.listStatus(root):
            n = re.fullmatch(r"gen=(\d+)", run.getPath().getName())
            again = os.path.join(self.path, run.getPath().getName(), "_set=again")
            if n and int(n[1]) <= gen and fs.exists(hadoop_path(self.spark, again)[1]):
                for link in fs.listStatus(hadoop_path(self.spark, again)[1]):
                    if link.getPath().getName().startswith("_link="):
                        found[os.path.join(again, link.getPath().getName())] = (int(n[1]), link.getPath().getName()[len("_link="):])
        return found

    def _current(self, gen: int, plain=(), since=None, packed: bool = True) -> DataFrame:
        """The row that counts of every fact, with its ``_link`` and ``WAS_PENDING``; texts but those in ``plain`` packed, as whole
        rows cross joins (``packed=False``: as text).  ``since`` leaves settled facts before that time unread."""
        cols = [*self.schema.names, "_link", WAS_PENDING]
        texts = StructType([f for f in self.schema.fields if f.name not in plain])
        late = F.lit(True) if since is None else F.col(self.time) >= since
        key = F.col(self.key)

        def pack(rows: DataFrame) -> DataFrame:
            return text_packed(rows, keep=("_set", "_link", WAS_PENDING, *plain))

        def given(rows: DataFrame, crossed: bool) -> DataFrame:
            if crossed:
                return rows if packed else text_unpacked(rows, texts)
            return pack(rows) if packed else rows

        folders = self._again_folders(gen)
        parts = []
        for link in ("settled", "pending"):
            rows = self._all(gen).where((F.col("_set") == "first") & (F.col("_link") == link)).withColumn(WAS_PENDING, F.lit(link == "pending")).select(*cols)
            if link == "settled":
                rows = rows.where(late)
            # read by their folders: the planner takes a scan for as large as the folders it is given, whatever partitions it leaves out
            over = [f for f, (_, x) in folders.items() if "_was_" not in x or x.endswith(f"_was_{link}")]
            if over:
                ids = pack(self._read(over).where(key.isNotNull()).select(self.key)).select(F.col(self.key).alias("_nk"))
                rows = pack(rows).join(ids, key == F.col("_nk"), "left_anti")
            parts.append(given(rows, bool(over)))
        if folders:
            rows = self._read(list(folders)).where(key.isNotNull())
            rows = (rows.withColumn(WAS_PENDING, F.when(F.col("_link").contains("_was_"), F.col("_link").endswith("_was_pending")))
                    .withColumn("_link", F.substring_index("_link", "_was_", 1)))
            several = len({n for n, _ in folders.values()}) > 1
            if several:
                newest = pack(rows.select(self.key, "gen")).groupBy(F.col(self.key).alias("_nk")).agg(F.max("gen").alias("_ng"))
                rows = pack(rows).join(newest, (key == F.col("_nk")) & (F.col("gen") == F.col("_ng")))
            parts.append(given(rows.select(*cols).where((F.col("_link") == "pending") | late), several))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def table(self, gen: int) -> DataFrame:
        """All facts at generation ``gen``."""
        return self._current(gen, packed=False).select(*self.schema.names)

    def ids(self, gen: int) -> DataFrame:
        """Ids staged up to generation ``gen`` (reads one column of the first rows)."""
        return self._all(gen).where(F.col("_set") == "first").select(self.key)

    def affected(self, gen: int, changes: dict[str, DataFrame], packed: bool = False) -> DataFrame | None:
        """Facts whose links may be out of date, given the parents' changes of a run.

        ``changes`` maps a foreign key to (key, ``_from``): the touched parents, one row each, and where their
        earliest version opened in the run starts.  Settled facts before all of these times aren't read
        (the literal reaches the scan); None when nothing changed.  ``packed`` leaves texts but the foreign keys as ``packed_key``.
        """
        starts = {fk: s for fk, c in changes.items() if (s := c.agg(F.min("_from")).first()[0]) is not None}
        if not starts:
            return None
        rows = self._current(gen, plain=tuple(changes), since=F.lit(min(starts.values())).cast("timestamp_ntz")).where(F.col(self.key).isNotNull())
        hit = F.lit(False)
        for i, fk in enumerate(starts):
            c = changes[fk]
            rows = rows.join(c.select(F.col(c.columns[0]).alias(f"_k{i}"), F.col("_from").alias(f"_from{i}")), F.col(fk) == F.col(f"_k{i}"), "left")
            hit = hit | (F.col(f"_k{i}").isNotNull() & ((F.col("_link") == "pending") | (F.col(self.time) >= F.col(f"_from{i}"))))
        out = rows.where(hit).select(*self.schema.names, "_link", WAS_PENDING)
        return out if packed else text_unpacked(out, StructType([f for f in self.schema.fields if f.name not in changes]))

    def write(self, gen: int, first: DataFrame, again: DataFrame | None = None) -> None:
        """Write generation ``gen``; both frames carry ``_settled``, ``again`` may carry ``WAS_PENDING``."""
        link = F.when(F.col(SETTLED), "settled").otherwise("pending")
        rows = first.select(*self.schema.names, F.lit("first").alias("_set"), link.alias("_link"))
        if again is not None:
            was = F.lit("")
            if WAS_PENDING in again.columns:
                was = F.when(F.col(WAS_PENDING), "_was_pending").when(~F.col(WAS_PENDING), "_was_settled").otherwise("")
            rows = rows.unionByName(again.select(*self.schema.names, F.lit("again").alias("_set"), F.concat(link, was).alias("_link")))
        (rows.write.mode("overwrite").option("compression", LAYER_CODEC)
         .partitionBy("_set", "_link").parquet(os.path.join(self.path, f"gen={gen:06d}")))
