"""Calendar functions on columns (all built-in, codegen friendly)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_yyyymm(c) -> Column:
    """'199501' or 199501 → date 1995-01-01 (bad input → null)."""
    return F.try_to_timestamp(_c(c).cast("string"), F.lit("yyyyMM")).cast("date")


def parse_yyyymmdd(c) -> Column:
    return F.try_to_timestamp(_c(c).cast("string"), F.lit("yyyyMMdd")).cast("date")


def year_start(c) -> Column:
    """Integer year → January 1st."""
    return F.make_date(_c(c).cast("int"), F.lit(1), F.lit(1))


def month_floor(c) -> Column:
    """Date or timestamp → first day of its month (DateType)."""
    return F.trunc(F.to_date(_c(c)), "MM")


def days_in_month(c) -> Column:
    return F.dayofmonth(F.last_day(_c(c)))


def epoch_seconds(c) -> Column:
    """Seconds since 1970-01-01 of a date or timestamp_ntz, independent of the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, _c(c).cast("timestamp_ntz"))


def epoch_seconds_of_date(c) -> Column:
    return F.datediff(F.to_date(_c(c)), F.lit("1970-01-01").cast("date")).cast("long") * 86400


def month_index(c) -> Column:
    """year*12 + month: consecutive months differ by exactly 1."""
    col = _c(c)
    return F.year(col) * 12 + F.month(col)


def month_step(a, b) -> Column:
    """(y2-y1)*12 + (m2-m1)."""
    return month_index(b) - month_index(a)


def cyclic_month_sin(c) -> Column:
    return F.sin(F.lit(2 * math.pi) * F.month(_c(c)) / 12)


def cyclic_month_cos(c) -> Column:
    return F.cos(F.lit(2 * math.pi) * F.month(_c(c)) / 12)
