"""Null-safe scalar expressions (ANSI mode is on: plain casts/divides raise)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (tone bucket edges) -----------------------------------------
NEGATIVE_TONE_MAX = -2.0  # tone <= -2 is negative
POSITIVE_TONE_MIN = 2.0  # tone >= 2 is positive
# --- end fixed values ----------------------------------------------------------


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tone_bucket(c: Column | str) -> Column:
    """negative / positive / neutral / unknown (null or NaN tone)."""
    t = F.nanvl(_c(c).cast("double"), F.lit(None).cast("double"))
    return (
        F.when(t.isNull(), F.lit("unknown"))
        .when(t <= F.lit(NEGATIVE_TONE_MAX), F.lit("negative"))
        .when(t >= F.lit(POSITIVE_TONE_MIN), F.lit("positive"))
        .otherwise(F.lit("neutral"))
    )


def parse_yyyymmdd(c: Column | str) -> Column:
    """Strict ``yyyyMMdd`` text -> DATE; anything unparsable -> null."""
    return F.try_to_date(_c(c).cast("string"), "yyyyMMdd")


def yyyymmdd(c: Column | str) -> Column:
    """DATE -> ``yyyyMMdd`` integer (the raw SQLDATE encoding), by arithmetic, not formatting."""
    d = _c(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def safe_divide(a: Column | str, b: Column | str) -> Column:
    """``SAFE_DIVIDE``: null when the divisor is 0 or null (never raises)."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def to_double(c: Column | str) -> Column:
    """Coercing numeric parse: bad text and NaN (a missing value) -> null."""
    return F.nanvl(_c(c).try_cast("double"), F.lit(None).cast("double"))


def to_bigint(c: Column | str) -> Column:
    """Coercing integer parse; integral decimals such as ``'12.0'`` are accepted."""
    d = _c(c).try_cast("double")
    return F.coalesce(
        _c(c).try_cast("bigint"),
        F.when(d == F.floor(d), d.try_cast("bigint")),
    )


def first_csv_double(c: Column | str) -> Column:
    """``SAFE_CAST(SPLIT(c, ',')[OFFSET(0)] AS DOUBLE)``."""
    return F.get(F.split(_c(c), ","), 0).try_cast("double")


def if_else_zero(cond: Column, value: Column | str) -> Column:
    """``IF(cond, value, 0)`` -- a null condition takes the 0 branch."""
    return F.when(cond, _c(value)).otherwise(F.lit(0))
