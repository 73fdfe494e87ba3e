"""Scalar expressions. Every function takes and returns a ``Column``.

A zero divisor gives NULL (never an error under ANSI, never infinity), a comparison with NULL counts as false
when it becomes a 0/1 flag.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a, b) -> Column:
    """a / b, NULL when b is zero."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def ratio_guarded(a, b, eps: float = 0.01) -> Column:
    """a / (b + eps): the small constant keeps a zero denominator finite."""
    return F.try_divide(col(a).cast("double"), col(b) + F.lit(float(eps)))


def difference(a, b) -> Column:
    return col(a) - col(b)


def log_ratio(a, b) -> Column:
    """log(1 + a) / (b + 1); NULL for a <= -1."""
    return F.try_divide(F.log1p(col(a)), col(b) + F.lit(1.0))


def project_day(start, count, step: int = 30) -> Column:
    """Day number reached after ``count`` steps of ``step`` days."""
    return col(start) + col(count) * F.lit(step)


def flip(flag) -> Column:
    return F.lit(1) - col(flag)


def indicator(cond: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def clip_zero(x) -> Column:
    """x where positive, else 0; NULL becomes 0."""
    return F.when(col(x) > 0, col(x)).otherwise(F.lit(0))


def recode(c, mapping: dict) -> Column:
    """Literal recode; values outside the mapping become NULL."""
    out = None
    for old, new in mapping.items():
        out = F.when(col(c) == F.lit(old), F.lit(new)) if out is None else out.when(col(c) == F.lit(old), F.lit(new))
    return out


def floor_bucket(x, width: int) -> Column:
    """Bucket number rounding toward minus infinity (days to 30-day months and the like)."""
    return F.floor(col(x) / F.lit(float(width))).cast("bigint")


def null_if(c, cond: Column) -> Column:
    """The value, nulled where the condition holds."""
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(None)).otherwise(col(c))


def fill(c, value) -> Column:
    return F.coalesce(col(c), value if isinstance(value, Column) else F.lit(value))


def _as_date(c) -> Column:
    return F.to_date(F.substring(col(c).cast("string"), 1, 10))


def _seconds(c) -> Column:
    return F.unix_timestamp(F.to_timestamp(col(c)))


def days_between(a, b) -> Column:
    """Signed whole days from the date part of b to the date part of a (text or time)."""
    return F.datediff(_as_date(a), _as_date(b)).cast("bigint")


def minutes_between(a, b) -> Column:
    return F.abs(F.floor((_seconds(a) - _seconds(b)) / F.lit(60.0))).cast("bigint")


def hours_between(a, b) -> Column:
    return F.abs(F.floor((_seconds(a) - _seconds(b)) / F.lit(3600.0))).cast("bigint")


def add_days(c, days) -> Column:
    """yyyy-MM-dd text, ``days`` after the date part of c."""
    return F.date_format(F.date_add(_as_date(c), col(days).cast("int") if not isinstance(days, int) else days), "yyyy-MM-dd")


def add_hours(c, hours) -> Column:
    """yyyy-MM-dd HH:mm:ss text, ``hours`` after c."""
    step = F.lit(hours) if isinstance(hours, int) else col(hours)
    return F.date_format(F.to_timestamp(col(c)) + F.make_interval(hours=step), "yyyy-MM-dd HH:mm:ss")
