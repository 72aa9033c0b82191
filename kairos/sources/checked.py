"""Layers whose checks run while they are written (Q13, Q14).

``checked_write`` writes a layer once and learns from that same pass how many rows break each
clause of its contract (observed metrics).  Rows that break a clause of severity ``error`` go to
a quarantine beside the layer, with the names of the clauses; ``warn`` clauses are only counted.  Uniqueness
needs all rows together: one scan of the key columns for all keys, by one expand and one aggregate.

    {path}/_ok=true/...    the layer
    {path}/_ok=false/...   quarantined rows, with ``failed_clauses``
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from kairos.functions.scalars import as_of as _as_of
from kairos.functions.scalars import epoch_micros
from kairos.operators.quality import Contract, QualityError, repeated_keys, row_clauses

CLAUSES = "failed_clauses"


@dataclass
class CheckedLayer:
    """What ``checked_write`` wrote: the layer, its quarantine, and failed rows by clause."""

    path: str
    schema: StructType
    n_rows: int
    failed: dict[str, int] = field(default_factory=dict)  # clause -> rows (freshness: 1)
    errors: list[str] = field(default_factory=list)  # clauses of severity error that failed on the layer itself

    def _read(self, spark, ok: str, schema: StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(f"{self.path}/_ok={ok}") if self._has(spark, ok) else spark.createDataFrame([], schema)

    def _has(self, spark, ok: str) -> bool:
        from kairos.session import path_exists

        return path_exists(spark, f"{self.path}/_ok={ok}")

    def layer(self, spark) -> DataFrame:
        return self._read(spark, "true", self.schema)

    def quarantine(self, spark) -> DataFrame:
        """The rows kept out, each with the clauses of severity error that it breaks."""
        return self._read(spark, "false", StructType([*self.schema.fields, StructField(CLAUSES, ArrayType(StringType()))]))


def checked_write(df: DataFrame, path: str, contract: Contract, as_of=None, severity: dict[str, str] | None = None,
                  on_error: str = "stop") -> CheckedLayer:
    """Write ``df`` under ``path`` and check it in the same pass.

    ``severity`` gives clauses (``not_null:c``, ``accepted:c``, ``range:c``, ``unique:c``, ``freshness:c``) as ``warn`` or
    ``error`` (default).  ``on_error="stop"``: any failed error clause raises ``QualityError`` after the write, with
    the quarantine there to be read.  ``"quarantine"``: rows that break error clauses are kept out of the layer and the
    build goes on; clauses of the whole table (unique, freshness, schema) still stop it.
    """
    severity = severity or {}
    level = lambda clause: severity.get(clause, "error")
    missing = [f"schema:{c}" for c, t in contract.fields.items() if c not in df.columns or df.schema[c].dataType.simpleString() != t]
    missing += [f"schema:{c}" for c in df.columns if contract.closed and c not in contract.fields]
    if missing:
        raise QualityError(f"failed checks: {missing}")
    clauses = row_clauses(contract, df.columns)
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("n_rows"), *[F.count_if(bad).alias(c) for c, bad in clauses.items()]]
    fresh = contract.freshness_col if contract.freshness_col in df.columns and contract.freshness_hours else None
    if fresh:
        age = epoch_micros(_as_of(as_of)) - epoch_micros(F.max(fresh))
        metrics.append(F.when(age.isNull() | (age > contract.freshness_hours * 3600e6), 1).otherwise(0).alias(f"freshness:{fresh}"))
    broken = F.filter(F.array(F.lit(None).cast("string"), *[F.when(bad, F.lit(c)) for c, bad in clauses.items() if level(c) == "error"]),
                      lambda x: x.isNotNull())
    rows = df.observe(seen, *metrics).withColumn(CLAUSES, broken).withColumn("_ok", (F.size(CLAUSES) == 0).cast("string"))
    rows.write.mode("overwrite").partitionBy("_ok").parquet(path)
    got = dict(seen.get)
    out = CheckedLayer(path, df.schema, got.pop("n_rows"), {c: n for c, n in got.items() if n})
    keys = [c for c in contract.unique if c in df.columns]
    if keys:
        for r in repeated_keys(out.layer(df.sparkSession), keys).where("n_failed > 0").collect():  # a row per key column
            out.failed[f"unique:{r['key']}"] = r["n_failed"]
    whole = [c for c in out.failed if c.startswith(("unique:", "freshness:"))]
    out.errors = [c for c in out.failed if level(c) == "error" and (on_error == "stop" or c in whole)]
    if out.errors:
        raise QualityError(f"failed checks: {sorted(out.errors)}")
    return out
