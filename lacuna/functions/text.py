"""String functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zero_pad(c, width: int = 5) -> Column:
    """K7: left-pad with '0' to ``width``; longer codes are kept whole (``lpad`` alone truncates)."""
    col = _c(c).cast("string")
    return F.when(F.length(col) < width, F.lpad(col, width, "0")).otherwise(col)


def safe_name(c) -> Column:
    """K8: '/' → '_'."""
    return F.translate(_c(c), "/", "_")


def clean_header(c) -> Column:
    """K9: drop '#', trim."""
    return F.trim(F.regexp_replace(_c(c), "#", ""))


def case_contains(c, text: str) -> Column:
    """K10."""
    return F.lower(_c(c)).contains(text.lower())


def basename(c) -> Column:
    """Last '/'-separated segment."""
    return F.element_at(F.split(_c(c), "/"), -1)


def station_from_file(c) -> Column:
    """Strip every 'data_' and '.csv'."""
    return F.replace(F.replace(_c(c), F.lit("data_"), F.lit("")), F.lit(".csv"), F.lit(""))


def json_field(c, path: str, default: str | None = None) -> Column:
    """A field of a JSON string (``$.a.b``), with an optional default when absent."""
    v = F.get_json_object(_c(c), path)
    return F.coalesce(v, F.lit(default)) if default is not None else v
