"""Seasonal-profile imputation.

Profile = exact median per station and day of year over all years; days of year without data
are interpolated linearly between the observed days (forward only: inner and trailing gaps; a
trailing gap keeps the last value), and what is still empty takes the series mean. Null rows are
filled from the profile of their day of year (on a month grid, March 1st is day 60 or 61).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.operators.series import STATION, MONTH


def seasonal_profile(df: DataFrame, value: str, station: str = STATION, time: str = MONTH) -> DataFrame:
    prof = df.groupBy(station, F.dayofyear(time).alias("doy")).agg(F.median(value).alias("_med"))
    w = Window.partitionBy(station).orderBy("doy")
    prof = prof.withColumn("_pos", F.row_number().over(w) - 1)
    known = F.when(F.col("_med").isNotNull(), F.struct(F.col("_pos").alias("p"), F.col("_med").alias("x")))
    prev = F.last(known, True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    nxt = F.first(known, True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    prof = prof.withColumn("_a", prev).withColumn("_b", nxt)
    inner = F.col("_a.x") + (F.col("_b.x") - F.col("_a.x")) * (F.col("_pos") - F.col("_a.p")) / (F.col("_b.p") - F.col("_a.p"))
    interp = (F.when(F.col("_med").isNotNull(), F.col("_med"))
              .when(F.col("_a").isNull(), F.lit(None))
              .when(F.col("_b").isNull(), F.col("_a.x"))
              .otherwise(inner))
    means = df.groupBy(station).agg(F.avg(value).alias("_mean"))
    return (prof.withColumn("_interp", interp).join(means, station)
            .select(station, "doy", F.coalesce("_interp", "_mean").alias("profile")))


def impute_seasonal(df: DataFrame, value: str, station: str = STATION, time: str = MONTH,
                    out: str | None = None) -> DataFrame:
    out = out or value
    prof = seasonal_profile(df, value, station, time)
    t = df.withColumn("_doy", F.dayofyear(time))
    j = t.join(prof.withColumnRenamed("doy", "_doy"), [station, "_doy"], "left")
    keep = [c for c in df.columns if c != out]
    return j.withColumn(out, F.coalesce(F.col(value), F.col("profile"))).select(*keep, out)
