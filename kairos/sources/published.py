"""Backfills that readers see only after they were validated.

A run writes its partitions beside the live ones, a comparison by partition
decides, and one commit note switches readers over::

    {path}/data/run=<run>/<part>=<value>/...   rows, written once per run
    {path}/_commits/N.json                     which run holds each partition

``read`` goes by the last note, so a run that is refused, dies or is repeated leaves readers on the old
rows.  A run may cover partitions for which it has no rows: promoted, they are empty.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from kairos.session import hadoop_path, path_exists
from kairos.sources.commits import commit, committed, read_note
from kairos.sources.sinks import check_same_schema


class PromotionRefused(ValueError):
    """A run's rows broke the rules; ``report`` holds the failing partitions (at most 100)."""

    def __init__(self, run: str, report: list):
        super().__init__(f"run {run!r} refused: " + "; ".join(f"{r['partition']}: {r['verdict']}" for r in report[:5]))
        self.report = report


@dataclass
class Rules:
    """What a partition of a run may differ in from the live one (shares of the live rows; None: any)."""

    max_removed: float | None = 0.0
    max_changed: float | None = None
    max_added: float | None = None
    sums: dict[str, float] = field(default_factory=dict)  # column -> how far its sum may move, as a share
    must_hold: str | None = None  # SQL condition of every new row (null counts as broken)


def compare_partitions(old: DataFrame, new: DataFrame, keys: Sequence[str], part: str, rules: Rules) -> DataFrame:
    """One row per partition: rows only in old, only in new, changed, equal or repeated in new, sums, and a verdict.

    Both sides meet in one aggregate on partition and keys (no join, so repeated keys don't multiply).
    A partition without live rows has nothing to compare with: only ``must_hold`` and repeated keys count there.
    """
    check_same_schema(old, new)
    keys = [k for k in keys if k != part]
    vals = [c for c in old.columns if c not in (part, *keys)]
    row = F.struct(*[F.col(c) for c in vals]) if vals else F.lit(True)
    holds = F.coalesce(F.expr(rules.must_hold), F.lit(False)) if rules.must_hold else F.lit(True)

    def side(df, is_new):
        sums = [F.col(c).alias(f"_s{i}") for i, c in enumerate(rules.sums)]
        return df.select(F.col(part).alias("partition"), *keys, row.alias("_row"), F.lit(is_new).alias("_new"), (~holds).alias("_broken"), *sums)

    new_side = F.col("_new")
    per_key = (side(old, False).unionByName(side(new, True)).groupBy("partition", *keys)
               .agg(F.count_if(~new_side).alias("o"), F.count_if(new_side).alias("n"),
                    F.max(F.when(~new_side, F.col("_row"))).alias("old_row"), F.max(F.when(new_side, F.col("_row"))).alias("new_row"),
                    F.count_if(new_side & F.col("_broken")).alias("broken"),
                    *[F.sum(F.when(F.col("_new") == s, F.col(f"_s{i}"))).alias(f"_s{i}_{s}") for i in range(len(rules.sums)) for s in (False, True)]))
    both = (F.col("o") > 0) & (F.col("n") > 0)
    same = F.col("old_row").eqNullSafe(F.col("new_row"))
    out = per_key.groupBy("partition").agg(
        F.sum("o").alias("n_old"), F.sum("n").alias("n_new"), F.count_if(F.col("o") == 0).alias("n_added"), F.count_if(F.col("n") == 0).alias("n_removed"),
        F.count_if(both & ~same).alias("n_changed"), F.count_if(both & same).alias("n_same"),
        F.sum(F.greatest(F.col("n") - 1, F.lit(0))).alias("n_repeated"), F.sum("broken").alias("n_broken"),
        *[F.sum(f"_s{i}_{s}").alias(f"{c}_{'new' if s else 'old'}") for i, c in enumerate(rules.sums) for s in (False, True)])

    def beyond(n, share):
        return (F.col("n_old") > 0) & (F.col(n) > F.lit(float(share)) * F.col("n_old"))

    faults = [F.when(F.col("n_repeated") > 0, "repeated keys"), F.when(F.col("n_broken") > 0, "rule broken")]
    faults += [F.when(beyond(f"n_{what}", share), f"too many {what}")
               for what, share in (("removed", rules.max_removed), ("changed", rules.max_changed), ("added", rules.max_added)) if share is not None]
    for c, share in rules.sums.items():
        before, after = (F.coalesce(F.col(f"{c}_{x}"), F.lit(0)) for x in ("old", "new"))
        faults.append(F.when((F.col("n_old") > 0) & (F.abs(after - before) > F.lit(float(share)) * F.abs(before)), f"sum of {c} moved"))
    said = F.array_join(F.filter(F.array(*faults), lambda x: x.isNotNull()), ", ")
    return out.withColumn("verdict", F.when(said == "", "ok").otherwise(said))


@dataclass
class PublishedTable:
    """A table partitioned by ``part`` whose readers see promoted runs only."""

    spark: SparkSession
    path: str
    part: str
    keys: Sequence[str]

    def _run_dir(self, run: str) -> str:
        if not run or any(x in run for x in "/=\\"):
            raise ValueError(f"not a run name: {run!r}")
        return os.path.join(self.path, "data", f"run={run}")

    def _note(self) -> dict | None:
        done = committed(self.spark, self.path)
        return read_note(self.spark, self.path, done[-1]) if done else None

    def _rows(self, note: dict, wanted: dict[str, str]) -> DataFrame:
        """Rows of the partitions in ``wanted`` (value -> run); only their directories are read."""
        schema = StructType.fromJson(note["schema"])
        full = StructType(list(schema.fields)).add("run", StringType())
        dirs = [self._run_dir(r) for r in sorted(set(wanted.values()))]
        dirs = [d for d in dirs if path_exists(self.spark, d)]
        if not dirs:
            return self.spark.createDataFrame([], schema)
        at = F.concat_ws("/", F.col("run"), F.col(self.part).cast("string"))
        rows = self.spark.read.schema(full).option("basePath", os.path.join(self.path, "data")).parquet(*dirs)
        return rows.where(at.isin([f"{r}/{v}" for v, r in wanted.items()])).select(*schema.names)

    def read(self) -> DataFrame | None:
        """The live rows (None: nothing was promoted yet)."""
        note = self._note()
        return None if note is None else self._rows(note, note["runs"])

    def stage(self, df: DataFrame, run: str) -> StructType:
        """Write a run's rows beside the live ones and return their schema; a run that isn't live may be written again.

        Rows without a partition value are refused: no partition would hold them.
        """
        note = self._note()
        if note is not None and run in note["runs"].values():
            raise ValueError(f"run {run!r} is live and not written again")
        value = F.when(F.col(self.part).isNull(), F.raise_error(F.lit(f"a row has no {self.part}"))).otherwise(F.col(self.part))
        rows = df.withColumn(self.part, value.cast(df.schema[self.part].dataType))
        rows.hint("rebalance", self.part).write.mode("overwrite").partitionBy(self.part).parquet(self._run_dir(run))
        return StructType([f for f in df.schema.fields if f.name != self.part] + [df.schema[self.part]])

    def candidate(self, run: str, schema: StructType) -> DataFrame:
        """The staged rows of ``run``."""
        return self.spark.read.schema(schema).parquet(self._run_dir(run))

    def _scope(self, run: str, schema: StructType, parts: Iterable | None) -> list[str]:
        """Partitions a run covers: the named ones, else those it holds (a list as long as the directories)."""
        held = [r[0] for r in self.candidate(run, schema).select(F.col(self.part).cast("string")).distinct().collect()]
        if parts is None:
            return sorted(held)
        named = {str(p) for p in parts}
        if set(held) - named:
            raise ValueError(f"run {run!r} holds partitions that it was not asked for: {sorted(set(held) - named)[:5]}")
        return sorted(named)

    def report(self, run: str, schema: StructType, rules: Rules = Rules(), parts: Iterable | None = None) -> DataFrame:
        """The staged run against the live rows of the partitions it covers."""
        note = self._note()
        scope = self._scope(run, schema, parts)
        new = self.candidate(run, schema)
        if note is None:
            old = self.spark.createDataFrame([], schema)
        else:
            old = self._rows(note, {v: r for v, r in note["runs"].items() if v in set(scope)})
        return compare_partitions(old, new.select(*old.columns), self.keys, self.part, rules)

    def promote(self, run: str, schema: StructType, rules: Rules = Rules(), parts: Iterable | None = None) -> None:
        """Switch readers to the run's partitions, or raise ``PromotionRefused`` and change nothing.

        Promoting a run that is live already does nothing, so a job may be run again.
        """
        done = committed(self.spark, self.path)
        note = self._note()
        if note is not None and note["run"] == run:
            return
        failing = self.report(run, schema, rules, parts).where("verdict != 'ok'").orderBy("partition").limit(100).collect()
        if failing:
            raise PromotionRefused(run, failing)
        runs = dict(note["runs"]) if note else {}
        runs.update({v: run for v in self._scope(run, schema, parts)})
        commit(self.spark, self.path, (done[-1] + 1) if done else 0, {"run": run, "runs": runs, "schema": schema.jsonValue()})

    def backfill(self, df: DataFrame, run: str, rules: Rules = Rules(), parts: Iterable | None = None) -> None:
        """Stage, validate and promote one run (A14 with A15)."""
        note = self._note()
        if note is not None and note["run"] == run:
            return
        self.promote(run, self.stage(df, run), rules, parts)

    def rollback(self) -> None:
        """Back to the state before the last commit, as a commit of its own."""
        done = committed(self.spark, self.path)
        if len(done) < 2:
            raise ValueError("there is no earlier commit")
        before = read_note(self.spark, self.path, done[-2])
        commit(self.spark, self.path, done[-1] + 1, before)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete runs that none of the last ``keep`` commits uses; their names."""
        done = committed(self.spark, self.path)
        used = {r for n in done[-keep:] for r in read_note(self.spark, self.path, n)["runs"].values()}
        fs, data = hadoop_path(self.spark, os.path.join(self.path, "data"))
        if not done or not fs.exists(data):
            return []
        gone = [n for n in (st.getPath().getName() for st in fs.listStatus(data)) if n.startswith("run=") and n[4:] not in used]
        for n in gone:
            fs.delete(hadoop_path(self.spark, os.path.join(self.path, "data", n))[1], True)
        return sorted(n[4:] for n in gone)
