"""Profile history (Q10, Q11): what a column looked like in past runs, and whether this run departs from it.

``ProfileStore`` appends one small profile per run: row counts and null rates of columns, shares of the values of
category columns.  A run is judged by the column's own past (median and spread of the last runs), from the
profiles alone: old data isn't read again.

A rate departs when it lies further from the median of the past than ``floor`` and than ``k`` times the spread,
the median absolute deviation.  Fewer than ``min_runs`` past runs judge nothing ("new").
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kairos.session import path_exists


def null_rates(df: DataFrame, cols: Sequence[str], run: Sequence[Column | str] = ()) -> DataFrame:
    """(run columns, column_name, n_rows, rate): null rates of all columns in one aggregate."""
    aggs = [F.count_if(F.col(c).isNull()).alias(f"_c{i}") for i, c in enumerate(cols)]
    wide = df.groupBy(*run).agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    keys = [c for c in wide.columns if not c.startswith("_c") and c != "n_rows"]
    rate = [F.struct(F.lit(c).alias("column_name"), (F.col(f"_c{i}") / F.col("n_rows")).alias("rate")) for i, c in enumerate(cols)]
    return wide.where("n_rows > 0").select(*keys, "n_rows", F.inline(F.array(*rate)))


def value_shares(df: DataFrame, cols: Sequence[str], run: Sequence[Column | str] = ()) -> DataFrame:
    """(run columns, column_name, value, rate): share of every value of the category columns (null is a value)."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols]))
    counted = df.select(*run, pairs.alias("_p")).select("*", "_p.*").drop("_p")
    keys = [c for c in counted.columns if c not in ("column_name", "value")]
    counted = counted.groupBy(*keys, "column_name", "value").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*keys, "column_name")  # the values of a category column in a run
    return counted.select(*keys, "column_name", "value", (F.col("_n") / F.sum("_n").over(whole)).alias("rate"))


def _median(x: Column) -> Column:
    """Median of an array of numbers (the mean of the two middle ones)."""
    s, n = F.sort_array(x), F.size(x)
    low, high = F.element_at(s, ((n + 1) / 2).cast("int")), F.element_at(s, (n / 2).cast("int") + 1)
    return F.when(n > 0, (low + high) / 2)


def judge(history: DataFrame, run: str, series: Sequence[str], past: int = 10, min_runs: int = 5, k: float = 4.0, floor: float = 0.01) -> DataFrame:
    """``history`` (run, series columns, rate) with ``median``, ``spread`` of the ``past`` runs before, and ``status``.

    One window per series over its runs; rows of a series follow the number of runs, not the data.
    """
    before = F.collect_list("rate").over(Window.partitionBy(*series).orderBy(run).rowsBetween(-past, -1))
    out = history.withColumn("_past", before).withColumn("median", _median(F.col("_past")))
    out = out.withColumn("spread", _median(F.transform("_past", lambda x: F.abs(x - F.col("median")))))
    off = F.abs(F.col("rate") - F.col("median"))
    status = (F.when(F.size("_past") < min_runs, "new")
              .when((off > floor) & (off > k * F.col("spread")), F.when(F.col("rate") > F.col("median"), "spike").otherwise("drop"))
              .otherwise("steady"))
    return out.withColumn("status", status).drop("_past")


def with_missing(shares: DataFrame, run: str) -> DataFrame:
    """Shares with a rate of 0 in every run in which a value, seen in some run, doesn't occur."""
    runs = shares.select(run, "column_name").distinct()
    values = shares.select("column_name", "value").distinct()
    grid = runs.alias("r").join(values.alias("v"), F.col("r.column_name") == F.col("v.column_name")).select(f"r.{run}", "r.column_name", "v.value")
    return grid.unionByName(shares.select(run, "column_name", "value")).distinct().join(
        shares.withColumnRenamed("value", "_v").withColumnRenamed("column_name", "_c").withColumnRenamed(run, "_r"),
        (F.col(run).eqNullSafe(F.col("_r"))) & (F.col("column_name") == F.col("_c")) & F.col("value").eqNullSafe(F.col("_v")), "left").select(
        run, "column_name", "value", F.coalesce("rate", F.lit(0.0)).alias("rate"))


@dataclass
class ProfileStore:
    """Profiles of a table's runs under ``path``: ``nulls/run=...`` and ``values/run=...``, each written once per run."""

    spark: SparkSession
    path: str
    columns: Sequence[str]
    categories: Sequence[str] = ()

    def record(self, df: DataFrame, run: str) -> None:
        """Profile ``df`` as ``run``; recording a run again replaces its profile."""
        null_rates(df, self.columns).coalesce(1).write.mode("overwrite").parquet(os.path.join(self.path, "nulls", f"run={run}"))
        if self.categories:
            value_shares(df, self.categories).coalesce(1).write.mode("overwrite").parquet(os.path.join(self.path, "values", f"run={run}"))

    def _read(self, what: str, schema: str) -> DataFrame:
        path = os.path.join(self.path, what)
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def null_history(self, **rule) -> DataFrame:
        """Every run's null rates with their verdicts."""
        rows = self._read("nulls", "column_name string, n_rows bigint, rate double, run string")
        return judge(rows, "run", ["column_name"], **rule).select("run", "column_name", "n_rows", "rate", "median", "spread", "status")

    def value_history(self, **rule) -> DataFrame:
        """Every run's value shares with their verdicts; a value that stays away has rate 0."""
        rows = self._read("values", "column_name string, value string, rate double, run string")
        return judge(with_missing(rows, "run"), "run", ["column_name", "value"], **rule).select(
            "run", "column_name", "value", "rate", "median", "spread", "status")

    def alerts(self, run: str, **rule) -> DataFrame:
        """What departs from its past in ``run``: (column_name, value or null for the null rate, rate, median, status)."""
        nulls = self.null_history(**rule).select("run", "column_name", F.lit(None).cast("string").alias("value"), F.lit("null rate").alias("what"), "rate", "median", "status")
        shares = self.value_history(**rule).select("run", "column_name", "value", F.lit("share").alias("what"), "rate", "median", "status")
        return nulls.unionByName(shares).where((F.col("run") == run) & F.col("status").isin("spike", "drop")).drop("run")
