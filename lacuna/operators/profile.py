"""Series profiling: availability, coverage, spans, presence, seasonal median, station constants."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions import calendar as cal
from lacuna.operators.series import STATION, MONTH


def month_calendar(df: DataFrame, time: str = MONTH, out: str = MONTH) -> DataFrame:
    """Every month start between the table's first and last month (one row per month)."""
    b = df.agg(F.min(cal.month_floor(time)).alias("_a"), F.max(cal.month_floor(time)).alias("_b"))
    return b.select(F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 MONTH"))).alias(out))


def availability_by_month(df: DataFrame, variables: list[str], time: str = MONTH) -> DataFrame:
    """Number of non-null values per month for each variable."""
    return df.groupBy(cal.month_floor(time).alias(MONTH)).agg(*[F.count(v).alias(f"n_{v}") for v in variables])


def calendar_left_join(df: DataFrame, variables: list[str], time: str = MONTH) -> DataFrame:
    """Complete calendar (first..last month) left-joined to the monthly counts, missing → 0."""
    counts = availability_by_month(df, variables, time)
    cal_df = month_calendar(df, time)
    j = cal_df.join(counts, MONTH, "left")
    return j.select(MONTH, *[F.coalesce(F.col(f"n_{v}"), F.lit(0)).alias(f"n_{v}") for v in variables])


def missing_months_by_year(df: DataFrame, variables: list[str], time: str = MONTH) -> DataFrame:
    """Per year, the number of calendar months with no data at all, per variable."""
    c = calendar_left_join(df, variables, time)
    return c.groupBy(F.year(MONTH).alias("year")).agg(
        *[F.sum(F.when(F.col(f"n_{v}") == 0, 1).otherwise(0)).alias(f"missing_{v}") for v in variables])


def fill_ratio(df: DataFrame, columns: list[str], station: str = STATION) -> DataFrame:
    """Per station and column, non-null count ÷ rows."""
    return df.groupBy(station).agg(*[(F.count(c) / F.count(F.lit(1))).alias(f"ratio_{c}") for c in columns])


def activity_span(df: DataFrame, measures: list[str], station: str = STATION, time: str = MONTH) -> DataFrame:
    """First and last time among rows that are not entirely null, and the span in days."""
    any_val = F.lit(False)
    for m in measures:
        any_val = any_val | F.col(m).isNotNull()
    a = df.filter(any_val).groupBy(station).agg(F.min(time).alias("first"), F.max(time).alias("last"))
    return a.withColumn("span_days", F.datediff("last", "first"))


def presence_matrix(df: DataFrame, value: str, station: str = STATION, time: str = MONTH) -> DataFrame:
    """D8 (long form): station × calendar month → 1 if any non-null reading that month, else 0.

    The calendar spans the whole table; stations are ranked by their first active month.
    """
    pres = (df.groupBy(station, cal.month_floor(time).alias(MONTH))
            .agg(F.max(F.when(F.col(value).isNotNull(), 1).otherwise(0)).alias("present")))
    # station × month grid: the calendar between the table's first and last month, exploded in place
    ends = pres.select(F.struct(F.min(MONTH).alias("lo"), F.max(MONTH).alias("hi"))).scalar()
    grid = (df.select(station).distinct().withColumn("_e", ends)
            .select(station, F.explode(F.sequence("_e.lo", "_e.hi", F.expr("INTERVAL 1 MONTH"))).alias(MONTH)))
    out = grid.join(pres, [station, MONTH], "left").withColumn("present", F.coalesce("present", F.lit(0)))
    first = pres.filter("present = 1").groupBy(station).agg(F.min(MONTH).alias("_first"))
    # rank = stations of earlier first months (a row for each month) + rank among those of the same month
    earlier = first.groupBy("_first").agg(F.count(F.lit(1)).alias("_k"))
    before = Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    earlier = earlier.select("_first", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_off"))
    ranked = first.withColumn("_r", F.row_number().over(Window.partitionBy("_first").orderBy(station))).join(earlier, "_first")
    return out.join(ranked.select(station, (F.col("_off") + F.col("_r")).cast("int").alias("station_rank")), station, "left")


def distinct_stations(df: DataFrame, cols=(STATION, "lon", "lat")) -> DataFrame:
    """Remove duplicate (station, x, y)."""
    return df.select(*cols).dropDuplicates(list(cols))


def seasonal_median(df: DataFrame, value: str, station: str = STATION, time: str = MONTH) -> DataFrame:
    """Exact median (interpolated) of the value per station and day of year."""
    return df.groupBy(station, F.dayofyear(time).alias("doy")).agg(F.median(value).alias("profile"))


def station_constants(df: DataFrame, columns: list[str], station: str = STATION, time: str = MONTH,
                      digits: int = 4) -> DataFrame:
    """First non-null value in time order of each column, rounded."""
    aggs = [F.round(F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(time))), digits).alias(c) for c in columns]
    return df.groupBy(station).agg(*aggs)


def value_range_padded(df: DataFrame, value: str, station: str = STATION, pad: float = 0.05) -> DataFrame:
    """min/max of the non-null values with 5 % padding; a flat series uses range 1."""
    a = df.groupBy(station).agg(F.min(value).alias("vmin"), F.max(value).alias("vmax"))
    rng = F.when(F.col("vmax") != F.col("vmin"), F.col("vmax") - F.col("vmin")).otherwise(F.lit(1.0))
    return a.select(station, (F.col("vmin") - rng * pad).alias("y_min"), (F.col("vmax") + rng * pad).alias("y_max"))


def station_dimension(df: DataFrame, station: str = STATION, time: str = MONTH,
                      cluster: str | None = "cluster") -> DataFrame:
    """One row per station with the lat/lon of its first row; stations with lat or lon 0/null dropped."""
    order = F.col(time)
    aggs = [F.min_by("lat", order).alias("lat"), F.min_by("lon", order).alias("lon")]
    if cluster:
        aggs.append(F.min_by(cluster, order).alias(cluster))
    a = df.groupBy(station).agg(*aggs)
    return a.filter((F.col("lat") != 0) & (F.col("lon") != 0))
