"""H1: linear interpolation between the known neighbours; flat before the first and after the last."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.operators.series import STATION, MONTH, series_window


def neighbour_columns(df: DataFrame, value: str, station: str = STATION, time: str = MONTH,
                      pos: str = "_pos") -> DataFrame:
    """Adds _pos, and (_p0,_x0) = last known at or before the row, (_p1,_x1) = first known at or after."""
    w = series_window(station, time)
    df = df.withColumn(pos, F.row_number().over(w) - 1)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(pos).alias("p"), F.col(value).alias("x")))
    prev = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    back = Window.partitionBy(station).orderBy(F.desc(pos))  # a frame up to the end would be read anew at every row
    nxt = F.last(known, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (df.withColumn("_prev", prev).withColumn("_next", nxt)
            .withColumn("_p0", F.col("_prev.p")).withColumn("_x0", F.col("_prev.x"))
            .withColumn("_p1", F.col("_next.p")).withColumn("_x1", F.col("_next.x"))
            .drop("_prev", "_next"))


def impute_linear(df: DataFrame, value: str, station: str = STATION, time: str = MONTH,
                  out: str | None = None) -> DataFrame:
    out = out or value
    t = neighbour_columns(df, value, station, time)
    inner = F.col("_x0") + (F.col("_x1") - F.col("_x0")) * (F.col("_pos") - F.col("_p0")) / (F.col("_p1") - F.col("_p0"))
    filled = (F.when(F.col(value).isNotNull(), F.col(value))
              .when(F.col("_p0").isNull(), F.col("_x1"))
              .when(F.col("_p1").isNull(), F.col("_x0"))
              .otherwise(inner))
    return t.withColumn(out, filled).drop("_pos", "_p0", "_x0", "_p1", "_x1")
