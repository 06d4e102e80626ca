"""Projections and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def filter_department(communes: DataFrame, depts: list[int], postal: str = "postal_code") -> DataFrame:
    """Communes whose integer postal code lies in [n·1000, (n+1)·1000 − 1] for a department n
    (the list is treated as a set; a non-numeric code never matches)."""
    d = F.floor(F.col(postal).try_cast("int") / 1000)
    return communes.filter(d.isin(sorted(set(depts))))


def filter_bbox(df: DataFrame, lat_min: float, lat_max: float, lon_min: float, lon_max: float,
                lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Inclusive bounding box (pushed down to the scan when the columns come from parquet)."""
    return df.filter(F.col(lat).between(lat_min, lat_max) & F.col(lon).between(lon_min, lon_max))


def drop_incomplete_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """B5."""
    return df.dropna("any", subset=subset)


def drop_all_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """B6."""
    return df.dropna("all", subset=subset)


def drop_null_target(df: DataFrame, col: str) -> DataFrame:
    """B7."""
    return df.dropna(subset=[col])


def fill_sentinel(df: DataFrame, cols: list[str], sentinel: float = -1.0) -> DataFrame:
    """B8."""
    return df.fillna(sentinel, subset=cols)


def search_stations(df: DataFrame, text: str, name: str = "name") -> DataFrame:
    """Case-insensitive substring search."""
    return df.filter(F.lower(F.col(name)).contains(text.lower()))


def coerce_types(df: DataFrame, numeric: list[str], timestamps: list[str], time: str | None = None) -> DataFrame:
    """Bad numbers / timestamps → null (ANSI-safe ``try_*``); rows whose ``time`` is null dropped."""
    for c in numeric:
        df = df.withColumn(c, F.col(c).cast("string").try_cast("double"))
    for c in timestamps:
        df = df.withColumn(c, F.try_to_timestamp(F.col(c).cast("string")))
    if time:
        df = df.filter(F.col(time).isNotNull())
    return df


def dataset_focus(errors: DataFrame, dataset, dataset_col: str = "dataset") -> tuple[DataFrame, DataFrame]:
    """The error rows of one dataset, and its distinct removal rates (sorted)."""
    rows = errors.filter(F.col(dataset_col) == F.lit(dataset))
    return rows, rows.select("pct_removed").distinct().orderBy("pct_removed")


def numeric_columns(df: DataFrame, keep: list[str]) -> DataFrame:
    num = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    return df.select(*keep, *[f.name for f in df.schema.fields if isinstance(f.dataType, num) and f.name not in keep])


def compare_series(a: DataFrame, b: DataFrame, time: str = "month", suffixes=("_a", "_b")) -> DataFrame:
    """Numeric columns of two series side by side on the full month calendar of both."""
    a = numeric_columns(a, [time])
    b = numeric_columns(b, [time])
    a = a.select(time, *[F.col(c).alias(c + suffixes[0]) for c in a.columns if c != time])
    b = b.select(time, *[F.col(c).alias(c + suffixes[1]) for c in b.columns if c != time])
    bounds = a.select(time).unionByName(b.select(time))
    lo = bounds.select(F.min(time)).scalar()
    hi = bounds.select(F.max(time)).scalar()
    cal = a.sparkSession.range(1).select(F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 MONTH"))).alias(time))
    return cal.join(a, time, "left").join(b, time, "left")
