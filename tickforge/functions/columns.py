"""Column expressions shared by the operators (all JVM-side, no Python UDFs)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MS_PER_DAY = 86_400_000


def epoch_ms(df: DataFrame, col: str) -> Column:
    """Epoch milliseconds of a timestamp column, independent of the session time zone.

    ``TIMESTAMP_NTZ`` values are wall-clock UTC (as the parquet writer stored them); a
    ``TIMESTAMP`` is an instant. Dates count from midnight UTC.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{col}`)")
    if isinstance(dtype, T.TimestampType):
        return F.unix_millis(F.col(col))
    if isinstance(dtype, T.DateType):
        return F.unix_date(F.col(col)).cast("bigint") * F.lit(MS_PER_DAY)
    return F.col(col).cast("bigint")


def epoch_to_ms(col: Column, ts_unit: str = "ms") -> Column:
    """Convert an epoch integer in ``ts_unit`` ('ms' or 'us') to milliseconds (double)."""
    if ts_unit == "ms":
        return col.cast("double")
    if ts_unit == "us":
        return col.cast("double") / F.lit(1000.0)
    raise ValueError(f"ts_unit must be 'ms' or 'us', got {ts_unit!r}")


def ds_from_ms(ms: Column) -> Column:
    """``YYYY-MM-DD`` (UTC) of an epoch-ms column, without going through the session zone."""
    return F.date_from_unix_date(F.floor(ms / F.lit(MS_PER_DAY)).cast("int")).cast("string")


def calendar_fields(ms: Column) -> dict[str, Column]:
    """UTC hour, minute of day and second of an epoch-ms column, from integer arithmetic."""
    sec = F.floor(ms / F.lit(1000.0))
    return {
        "hour": F.pmod(F.floor(sec / 3600), F.lit(24)),
        "minute_of_day": F.pmod(F.floor(sec / 60), F.lit(1440)),
        "second": F.pmod(sec, F.lit(60)),
    }


def guarded_div(num: Column, den: Column, eps: float | None = None) -> Column:
    """``num / (den + eps)`` when ``eps`` is given (literal reference formula), else NULL on 0."""
    if eps is not None:
        return F.try_divide(num, den + F.lit(eps))
    return F.try_divide(num, den)


def ln_pos(x: Column) -> Column:
    """Natural log; NULL for non-positive or NULL input (never raises, never -inf)."""
    return F.when(x > 0, F.log(x))


def code_u8(x: Column) -> Column:
    """E1 / E4 (M2): 8-bit code: clip(round-half-even(x*255), 0, 255)."""
    return F.least(F.greatest(F.rint(x * F.lit(255.0)), F.lit(0.0)), F.lit(255.0)).cast("short")


def code_trunc(x: Column) -> Column:
    """Truncating code int(x*255) (toward zero)."""
    v = x * F.lit(255.0)
    return F.when(v >= 0, F.floor(v)).otherwise(F.ceil(v)).cast("short")


TWO_PI = 2.0 * math.pi
