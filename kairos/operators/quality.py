"""Data-quality checks as Spark jobs.  Each check returns the violating rows
(or a small status frame), never collects the data.

Q1 check_unique, Q2 check_not_null, Q3 check_accepted, Q4 check_freshness,
Q5 check_reconcile, Q6/C13 check_relationship, Q7 check_rule, Q8 check_volume,
Q9 schema_diff, Q10 null_profile, Q11 category_profile, Q12 check_range,
Q13 check_contract, Q14 require.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StructField, StructType

from kairos.functions.scalars import as_of as _as_of
from kairos.functions.scalars import epoch_micros, seconds_between, text_packed


def check_unique(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """Q1: key values that occur more than once, with their count."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    """Q2: rows where ``col`` is NULL."""
    return df.where(F.col(col).isNull())


def check_accepted(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Q3: rows whose value is outside ``values`` (NULL passes, as in the declared test)."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def check_freshness(df: DataFrame, col: str, as_of=None, warn_hours: float = 12,
                    error_hours: float = 24) -> DataFrame:
    """Q4: one row: newest ``col``, its age in seconds, and pass / warn / error."""
    out = df.agg(F.max(col).alias("max_loaded_at"))
    out = out.withColumn("age_seconds", seconds_between(F.col("max_loaded_at"), _as_of(as_of)))
    s = F.col("age_seconds")
    status = (F.when(s.isNull(), "error")
              .when(s > error_hours * 3600, "error")
              .when(s > warn_hours * 3600, "warn").otherwise("pass"))
    return out.withColumn("status", status)


def check_relationship(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null ``fk`` has no parent (anti join)."""
    p = parent.select(F.col(pk).alias("_pk")).distinct()
    return child.where(F.col(fk).isNotNull()).join(p, F.col(fk) == F.col("_pk"), "left_anti")


def check_rule(df: DataFrame, violation: F.Column | str) -> DataFrame:
    """Q7: rows for which the violation predicate holds."""
    cond = F.expr(violation) if isinstance(violation, str) else violation
    return df.where(cond)


def check_reconcile(items: DataFrame, orders: DataFrame, key: str = "order_id",
                    item_total: F.Column | None = None, order_amount: str = "amount",
                    order_key: str = "id", tolerance: float = 0.01) -> DataFrame:
    """Q5: orders whose item total differs from the order amount by more than ``tolerance``."""
    total = item_total if item_total is not None else F.col("quantity") * F.col("unit_price")
    sums = items.groupBy(key).agg(F.sum(total).cast("decimal(18,2)").alias("items_total"))
    o = orders.select(F.col(order_key).alias(key), F.col(order_amount).alias("order_amount"))
    j = o.join(sums, key, "left")
    diff = F.abs(F.coalesce(F.col("items_total"), F.lit(0)) - F.col("order_amount"))
    return j.where(diff > tolerance).withColumn("difference", diff.cast("decimal(18,2)"))


def check_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Q12: rows outside [lo, hi] (NULL passes)."""
    c = F.col(col)
    bad = F.lit(False)
    if lo is not None:
        bad = bad | (c < lo)
    if hi is not None:
        bad = bad | (c > hi)
    return df.where(c.isNotNull() & bad)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Q10: null rate of every column in one aggregate pass, one row per column."""
    cols = list(cols or df.columns)
    aggs = [F.avg(F.col(c).isNull().cast("double")).alias(f"c{i}") for i, c in enumerate(cols)]
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("null_rate"))
                      for i, c in enumerate(cols)])
    return wide.select(F.col("_n").alias("n_rows"), F.inline(pairs))


def category_profile(current: DataFrame, baseline: DataFrame, col: str,
                     shift_threshold: float = 0.1) -> DataFrame:
    """Q11: share of each value now vs in the baseline; flags new, missing and shifted values."""
    def shares(df, name):
        total = df.agg(F.count(F.lit(1))).scalar()  # scalar subquery, computed once
        return (df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("_c"))
                .select("value", (F.col("_c").cast("double") / total.cast("double")).alias(name)))
    j = shares(current, "share_now").join(shares(baseline, "share_before"), "value", "full_outer")
    kind = (F.when(F.col("share_before").isNull(), "unexpected")
            .when(F.col("share_now").isNull(), "missing")
            .when(F.abs(F.col("share_now") - F.col("share_before")) > shift_threshold, "shifted")
            .otherwise("stable"))
    return j.withColumn("status", kind)


def check_volume(df: DataFrame, ts: str, days: int = 7, threshold: float = 0.2) -> DataFrame:
    """Q8: days whose row count deviates more than ``threshold`` from the prior ``days``-day mean."""
    from kairos.operators.aggregates import daily_baseline

    return daily_baseline(df, ts, days, threshold).where(F.col("is_anomaly"))


# Type changes that keep every old value.
WIDENING = {
    "tinyint": ["smallint", "int", "bigint", "float", "double"],
    "smallint": ["int", "bigint", "float", "double"],
    "int": ["bigint", "double"],
    "float": ["double"],
    "date": ["timestamp_ntz"],
}


def widens(old: DataType, new: DataType) -> bool:
    """Whether every value of ``old`` is also one of ``new``."""
    if isinstance(old, DecimalType) and isinstance(new, DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return new.simpleString() in WIDENING.get(old.simpleString(), [])


def schema_diff(old: StructType, new: StructType) -> list[dict]:
    """Q9: column-level drift; removed columns, narrowing type changes and nullability
    tightening are breaking; widened types, loosened nullability and added nullable
    columns are not."""
    o = {f.name: f for f in old.fields}
    n = {f.name: f for f in new.fields}
    out = []
    for name, f in o.items():
        if name not in n:
            out.append({"column": name, "change": "removed", "breaking": True})
        elif f.dataType != n[name].dataType:
            out.append({"column": name, "change": f"type {f.dataType.simpleString()}->"
                        f"{n[name].dataType.simpleString()}", "breaking": not widens(f.dataType, n[name].dataType)})
        if name in n and f.nullable != n[name].nullable:
            tighter = f.nullable
            out.append({"column": name, "change": "nullable->required" if tighter else "required->nullable", "breaking": tighter})
    for name, f in n.items():
        if name not in o:
            out.append({"column": name, "change": "added", "breaking": not f.nullable})
    return out


def evolved(old: StructType, new: StructType) -> StructType:
    """The schema that holds rows of both; raises ``SchemaChangeError`` for a breaking change.

    Added nullable columns and widened types go on (older rows have nulls and their values in the wider type), and a
    column that comes narrower keeps its stored type.  Removed columns, other type changes and added required columns stop.
    """
    from kairos.sources.sinks import SchemaChangeError

    before = {f.name: f for f in old.fields}
    breaking = [d for d in schema_diff(old, new) if d["breaking"] and not d["change"].startswith("nullable")]
    names = {f.name: f for f in new.fields}
    breaking = [d for d in breaking if not (d["column"] in before and d["column"] in names and widens(names[d["column"]].dataType, before[d["column"]].dataType))]
    if breaking:
        raise SchemaChangeError("breaking schema change: " + "; ".join(f"{d['column']} {d['change']}" for d in breaking))
    fields = []
    for f in old.fields:
        wider = names[f.name].dataType if widens(f.dataType, names[f.name].dataType) else f.dataType
        fields.append(StructField(f.name, wider, True))
    return StructType(fields + [StructField(f.name, f.dataType, True) for f in new.fields if f.name not in before])


def conformed(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema`` (columns it lacks: null)."""
    return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


@dataclass
class Contract:
    """Q13: fields, types, nullability, accepted values and freshness in one declaration.

    ``closed``: columns that ``fields`` doesn't name are failures."""
    fields: dict[str, str]
    required: Sequence[str] = ()
    closed: bool = False
    unique: Sequence[str] = ()
    accepted: dict[str, Sequence] = field(default_factory=dict)
    freshness_col: str | None = None
    freshness_hours: float | None = None
    ranges: dict[str, tuple] = field(default_factory=dict)  # column -> (least, greatest), either may be None


def row_clauses(contract: Contract, columns: Sequence[str]) -> dict[str, F.Column]:
    """Clause -> whether a row breaks it, for the clauses that a row can break on its own."""
    out = {f"not_null:{c}": F.col(c).isNull() for c in contract.required if c in columns}
    out |= {f"accepted:{c}": F.col(c).isNotNull() & ~F.col(c).isin(list(v)) for c, v in contract.accepted.items() if c in columns}
    for c, (lo, hi) in contract.ranges.items():
        if c in columns:
            low = F.col(c) < lo if lo is not None else F.lit(False)
            out[f"range:{c}"] = F.coalesce(low | (F.col(c) > hi if hi is not None else F.lit(False)), F.lit(False))
    return out


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(key, n_failed): surplus rows of every key column, all of them by one scan, one expand and one aggregate.

    Values are compared as text; nulls count as one value, as in ``check_unique``.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("v")) for k in keys]))
    per = df.select(pairs.alias("_p")).select("_p.*").groupBy("key", "v").agg(F.count(F.lit(1)).alias("_n"))
    return per.groupBy("key").agg(F.sum(F.col("_n") - 1).alias("n_failed"))


def check_contract(df: DataFrame, contract: Contract, as_of=None) -> DataFrame:
    """Q13: one row per failed clause.  Schema clauses are checked on the plan;
    all data clauses are evaluated in a single aggregate pass (plus one
    aggregate per unique key)."""
    rows: list[tuple[str, str, int]] = []
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for c, t in contract.fields.items():
        if c not in actual:
            rows.append(("schema", f"missing column {c}", 1))
        elif actual[c] != t:
            rows.append(("schema", f"{c} is {actual[c]}, expected {t}", 1))
    if contract.closed:
        rows += [("schema", f"unexpected column {c}", 1) for c in actual if c not in contract.fields]
    spark = df.sparkSession
    checks = []
    for c in contract.required:
        if c in actual:
            checks.append((f"not_null:{c}", F.count(F.when(F.col(c).isNull(), 1))))
    for c, vals in contract.accepted.items():
        if c in actual:
            checks.append((f"accepted:{c}", F.count(F.when(F.col(c).isNotNull() & ~F.col(c).isin(list(vals)), 1))))
    checks += [(c, F.count_if(bad)) for c, bad in row_clauses(contract, list(actual)).items() if c.startswith("range:")]
    if contract.freshness_col and contract.freshness_col in actual and contract.freshness_hours:
        age = epoch_micros(_as_of(as_of)) - epoch_micros(F.max(contract.freshness_col))
        checks.append((f"freshness:{contract.freshness_col}",
                       # a table without a time has no age: it fails, as in check_freshness
                       F.when(age.isNull() | (age > contract.freshness_hours * 3600e6), 1).otherwise(0)))
    schema_df = spark.createDataFrame(rows, "clause string, detail string, n_failed long")
    result = schema_df
    if checks:
        agg = df.agg(*[e.cast("bigint").alias(f"k{i}") for i, (_, e) in enumerate(checks)])
        arr = F.array(*[F.struct(F.lit(name.split(":")[0]).alias("clause"), F.lit(name).alias("detail"),
                                 F.col(f"k{i}").alias("n_failed")) for i, (name, _) in enumerate(checks)])
        result = result.unionByName(agg.select(F.inline(arr)))
    for c in contract.unique:
        # texts are compared packed: one form per text
        dup = check_unique(text_packed(df.select(c)), c).agg(F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).cast("bigint").alias("n_failed"))
        result = result.unionByName(dup.select(F.lit("unique").alias("clause"), F.lit(f"unique:{c}").alias("detail"),
                                               "n_failed"))
    return result.where(F.col("n_failed") > 0)


class QualityError(RuntimeError):
    pass


def require(checks: dict[str, DataFrame]) -> None:
    """Q14: stop the build when any check returns a violating row.

    Only one row per check is fetched (``limit(1)``), never the data.
    """
    failed = [name for name, df in checks.items() if df.limit(1).count() > 0]
    if failed:
        raise QualityError(f"failed checks: {failed}")
