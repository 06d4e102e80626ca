"""Sliding windows over series (E9) and the average of overlapping window predictions.

A series is gathered once as an array in time order (bounded by the calendar); windows are slices of
it, so there is one shuffle by station and no self-join. Windows multiply a series by their size, so they are
the last step before a model that wants them; ``impute.window_model`` fits without them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.operators.series import STATION, MONTH


def _vector(features: list[str], sentinel: float | None):
    cells = [F.col(f).cast("double") if sentinel is None else F.coalesce(F.col(f).cast("double"), F.lit(sentinel)) for f in features]
    return F.array(*cells)


def _gathered(df: DataFrame, station: str, time: str, **vectors) -> DataFrame:
    """station, ``n`` and the given columns as arrays in time order."""
    row = F.struct(F.col(time).alias("t"), *[v.alias(name) for name, v in vectors.items()])
    g = df.groupBy(station).agg(F.sort_array(F.collect_list(row)).alias("_s"))
    return g.select(station, F.size("_s").alias("n"), *[F.col(f"_s.{name}").alias(name) for name in vectors])


def sliding_windows(df: DataFrame, features: list[str], size: int, pairing: str = "cnn",
                    truth: DataFrame | None = None, station: str = STATION, time: str = MONTH,
                    sentinel: float = -1.0) -> DataFrame:
    """(station, x_end, x, y). x rows hold the (holed, sentinel-filled) features, y the truth.

    cnn : x = rows [i−w, i), y = same rows, i = w … n−1, needs n > w+1
    lstm: x = rows [i−w−1, i−1), y = rows [i−w, i), i = w+1 … n−1, needs n > w+2
    ``truth`` has the same rows as ``df`` for every station that ``df`` holds.
    """
    ahead = 0 if pairing == "cnn" else 1
    g = _gathered(df, station, time, x_all=_vector(features, sentinel))
    if truth is None:
        g = g.join(_gathered(df, station, time, y_all=_vector(features, None)).drop("n"), station)
    else:
        g = g.join(_gathered(truth, station, time, y_all=_vector(features, None)).drop("n"), station)
    last = F.col("n") - 2 - ahead
    ends = g.filter(F.col("n") > size + 1 + ahead).withColumn("x_end", F.explode(F.sequence(F.lit(size - 1), last)))
    return ends.select(station, "x_end", F.slice("x_all", F.col("x_end") - size + 2, F.lit(size)).alias("x"),
                       F.slice("y_all", F.col("x_end") - size + 2 + ahead, F.lit(size)).alias("y"))


def overlap_average(window_preds: DataFrame, series: DataFrame, size: int, out: str = "pred",
                    station: str = STATION, time: str = MONTH) -> DataFrame:
    """Window i (start row i) covers rows i … i+size−1; each row takes the mean of every
    window covering it; rows covered by none stay null (always the last row, and all rows when n ≤ size).

    ``window_preds``: (station, start, values array<double> of length size). The windows of a station are added up
    in memory, place by place, so that no window becomes rows; null values don't count."""
    kind = window_preds.schema[station].dataType.simpleString()

    def averaged(batches):
        for b in batches:
            found = []
            for starts, values in zip(b.column(1), b.column(2)):
                at = starts.values.to_numpy()
                rows = values.values.flatten().to_numpy(zero_copy_only=False).reshape(len(at), size)
                total, hits = np.zeros(int(at.max()) + size), np.zeros(int(at.max()) + size)
                for t in range(size):
                    known = ~np.isnan(rows[:, t])
                    np.add.at(total, at[known] + t, rows[known, t])
                    np.add.at(hits, at[known] + t, 1)
                found.append(np.where(hits > 0, total / np.where(hits > 0, hits, 1), np.nan))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.float64()))], [station, "_avg"])

    g = window_preds.groupBy(station).agg(F.collect_list(F.struct(F.col("start").cast("long").alias("start"), "values")).alias("_w"))
    g = g.select(station, F.transform("_w", lambda w: w["start"]).alias("start"), F.transform("_w", lambda w: w["values"]).alias("values"))
    avg = g.mapInArrow(averaged, f"`{station}` {kind}, _avg array<double>")
    rest = [c for c in series.columns if c != station]
    whole = series.groupBy(station).agg(F.sort_array(F.collect_list(F.struct(F.col(time).alias("_t"), F.struct(*rest).alias("_r")))).alias("_s"))
    j = whole.join(avg, station, "left").select(station, "_avg", F.posexplode("_s").alias("_pos", "_s"))
    value = F.get("_avg", F.col("_pos"))
    return j.select(station, "_s._r.*", F.when(~F.isnan(value), value).alias(out)).select(*series.columns, out)


def inference_windows(df: DataFrame, features: list[str], size: int, station: str = STATION,
                      time: str = MONTH, sentinel: float = -1.0) -> DataFrame:
    """Inference windows i = 0 … n−size−1 over rows [i, i+size) (the reference stops one short)."""
    g = _gathered(df, station, time, x_all=_vector(features, sentinel)).filter(F.col("n") > size)
    return (g.withColumn("start", F.explode(F.sequence(F.lit(0), F.col("n") - size - 1)))
            .select(station, "start", F.slice("x_all", F.col("start") + 1, F.lit(size)).alias("x")))
