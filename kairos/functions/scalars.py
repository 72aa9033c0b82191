"""Scalar column functions (all JVM-side built-ins, no Python UDFs).

G1 day_diff, G2 as_of, G3/G4 shift_days, G7 md5_uuid, G8 surrogate_key,
G9 version_sk, G10 round, B13 safe_ratio, B14 ratio_if, G12 recency_status.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# Fixed text format used wherever a timestamp becomes part of a hash key.
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a string or naive datetime."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def as_of(value=None) -> Column:
    """Explicit evaluation time; defaults to the current timestamp."""
    if value is None:
        return F.localtimestamp()
    return ts_literal(value)


def ts_text(c) -> Column:
    """Timestamp rendered with a fixed 6-digit fraction (stable across engines)."""
    return F.date_format(col(c), TS_TEXT_FORMAT)


def epoch_micros(c) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ, independent of the session time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), col(c))


def seconds_between(start, end) -> Column:
    """Whole seconds from start to end (floor), session-zone independent."""
    return F.floor((epoch_micros(end) - epoch_micros(start)) / F.lit(1_000_000)).cast("bigint")


def ntz_to_instant(c) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP read as UTC wall time, whatever the session zone."""
    return F.timestamp_micros(epoch_micros(c))


def instant_to_ntz(c) -> Column:
    """Inverse of ``ntz_to_instant``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(col(c)), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def day_diff(start, end) -> Column:
    """G1: number of calendar-day boundaries between start and end (DATEDIFF('day', a, b))."""
    return F.datediff(F.to_date(col(end)), F.to_date(col(start))).cast("bigint")


def shift_days(c, days: int) -> Column:
    """Timestamp plus a (possibly negative) number of days."""
    return col(c) + F.make_dt_interval(F.lit(days))


def md5_uuid(*parts) -> Column:
    """Deterministic UUID text from md5 of the concatenated parts (8-4-4-4-12)."""
    h = F.md5(F.concat(*[col(p).cast("string") for p in parts]))
    return _dashed(h)


def _dashed(h) -> Column:
    return F.concat_ws("-", *[F.substring(h, start, length) for start, length in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


_HEX_KEY = r"\A[0-9a-f]{32}\z"
_UUID_KEY = r"\A[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"


def packed_key(c) -> Column:
    """Text as bytes for a shuffle, lower-case hexadecimal keys and UUIDs at half their length; any text survives.

    Written with few operations: plans hold it many times over, and generated code that is too large isn't compiled."""
    t = col(c)
    return (F.when(t.rlike(_HEX_KEY), F.concat(F.lit(b"\x01"), F.unhex(t)))
            .when(t.rlike(_UUID_KEY), F.concat(F.lit(b"\x02"), F.unhex(F.replace(t, F.lit("-"), F.lit("")))))
            .otherwise(F.concat(F.lit(b"\x00"), t.cast("binary"))))


def unpacked_key(c) -> Column:
    """Inverse of ``packed_key``."""
    b = col(c)
    kind, rest = F.substring(b, 1, 1), F.substring(b, 2, 2**31 - 1)
    return (F.when(kind == F.lit(b"\x01"), F.lower(F.hex(rest)))
            .when(kind == F.lit(b"\x02"), F.regexp_replace(F.lower(F.hex(rest)), "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"))
            .otherwise(rest.cast("string")))


def text_packed(df: DataFrame, keep=()) -> DataFrame:
    """``df`` with its text columns, but those in ``keep``, as ``packed_key`` (for the time of a shuffle)."""
    return df.select(*[(packed_key(f.name).alias(f.name) if f.dataType == StringType() and f.name not in keep else F.col(f.name))
                       for f in df.schema.fields])


def text_unpacked(df: DataFrame, schema: StructType) -> DataFrame:
    """Inverse of ``text_packed``: the columns that are text in ``schema`` as text."""
    text = {f.name for f in schema.fields if f.dataType == StringType()}
    return df.select(*[(unpacked_key(c).alias(c) if c in text else F.col(c)) for c in df.columns])


def surrogate_key(*cols) -> Column:
    """md5 of natural keys joined by '-', NULL rendered as a fixed marker."""
    marker = "_null_"
    return F.md5(F.concat_ws("-", *[F.coalesce(col(c).cast("string"), F.lit(marker)) for c in cols]))


def version_sk(key, updated_at) -> Column:
    """Version id unique per (key, updated_at)."""
    return F.md5(F.concat_ws("|", F.coalesce(col(key).cast("string"), F.lit("")),
                             F.coalesce(ts_text(updated_at), F.lit(""))))


def safe_ratio(num, den, default=0.0) -> Column:
    """CASE WHEN den > 0 THEN num / den ELSE default END, as DOUBLE."""
    n, d = col(num), col(den)
    return F.when(d > 0, n.cast("double") / d.cast("double")).otherwise(F.lit(default).cast("double"))


def ratio_if(num, den, cond: Column) -> Column:
    """Num / den when cond holds, else NULL."""
    return F.when(cond, col(num).cast("double") / col(den).cast("double"))


def recency_status(last_at, as_of_col: Column, active_days: int = 90,
                   churn_days: int = 180) -> Column:
    """Active <= 90 days, at_risk up to 180 days, churned beyond (documented rule)."""
    d = day_diff(last_at, as_of_col)
    return (F.when(d.isNull(), F.lit(None).cast("string"))
            .when(d <= active_days, "active")
            .when(d <= churn_days, "at_risk")
            .otherwise("churned"))


def money(c) -> Column:
    """DECIMAL(18,2) money, exact under summation in every engine."""
    return col(c).cast("decimal(18,2)")
