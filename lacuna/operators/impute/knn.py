"""K-nearest-neighbour imputation inside each series.

Features: lon, lat, year, sin and cos of 2π·month/12, standardised per station on the complete rows
(population std; a constant feature is divided by 1). A missing row takes the mean value of its k
nearest complete rows (distance ties: earlier row first). ``past_only`` keeps strictly earlier rows
and shrinks k (no earlier row → stays null). A missing row with a null feature takes the mean of the
complete rows; a station with fewer than k complete rows is filled with its mean.

A series (one array, bounded by the calendar) is the unit of work: its missing rows meet its complete
rows as one matrix of distances, some rows at a time, so no pair of rows is ever a row of a table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions import calendar as cal
from lacuna.operators.series import STATION, MONTH

DIST_DIGITS, ROWS = 9, 512


def nearest_rows(asked: np.ndarray, items: np.ndarray, k: int, forbidden: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The places of the ``k`` nearest items of each asked row (fewer if there are not so many), nearest first, the earlier item first
    at equal distance (9 digits), and which of these count (a forbidden pair never does)."""
    d = np.round(np.sqrt(((asked[:, None, :] - items[None]) ** 2).sum(axis=2)), DIST_DIGITS)
    if forbidden is not None:
        d[forbidden] = np.inf
    order = np.argsort(d, axis=1, kind="stable")[:, :k]
    return order, np.isfinite(np.take_along_axis(d, order, axis=1))


def knn_fill(v: np.ndarray, features: np.ndarray, k: int, past_only: bool) -> np.ndarray:
    """The series with its missing values filled; NaN where nothing fills."""
    known, whole = ~np.isnan(v), ~np.isnan(features).any(axis=1)
    complete, out = known & whole, v.copy()
    if complete.sum() < k:
        out[~known] = v[known].mean() if known.any() else np.nan
        return out
    spread = features[complete].std(axis=0)
    z = (features - features[complete].mean(axis=0)) / np.where(spread == 0, 1.0, spread)
    out[~known & ~whole] = v[complete].mean()
    items, asked = np.flatnonzero(complete), np.flatnonzero(~known & whole)
    for at in range(0, len(asked), ROWS):
        rows = asked[at:at + ROWS]
        order, counts = nearest_rows(z[rows], z[items], k, items[None] >= rows[:, None] if past_only else None)
        n = counts.sum(axis=1)
        total = np.where(counts, v[items[order]], 0.0).sum(axis=1)
        out[rows] = np.where(n > 0, total / np.where(n > 0, n, 1), np.nan)
    return out


def impute_knn(df: DataFrame, value: str, station: str = STATION, time: str = MONTH, k: int = 5,
               past_only: bool = False, coords: tuple[str, ...] = ("lon", "lat"), out: str | None = None) -> DataFrame:
    out = out or value
    features = [*(F.col(c).cast("double") for c in coords), F.year(time).cast("double"), cal.cyclic_month_sin(time), cal.cyclic_month_cos(time)]
    names = [f"x{i}" for i in range(len(features))]
    row = F.struct(F.col(time).alias("t"), F.col(value).cast("double").alias("v"), *[f.alias(n) for f, n in zip(features, names)])
    g = df.groupBy(station).agg(F.sort_array(F.collect_list(row)).alias("_s"))
    g = g.select(station, F.col("_s.t").alias("times"), F.col("_s.v").alias("v"), *[F.col(f"_s.{n}").alias(n) for n in names])
    kind, when = g.schema[station].dataType.simpleString(), g.schema["times"].dataType.simpleString()

    def run(batches):
        for b in batches:
            found = []
            for i in range(b.num_rows):
                v, *x = (c[i].values.to_numpy(zero_copy_only=False).astype(np.float64) for c in b.columns[2:])
                found.append(knn_fill(v, np.stack(x, axis=1), k, past_only))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.float64()))], [station, "times", "_f"])

    filled = g.mapInArrow(run, f"`{station}` {kind}, times {when}, _f array<double>")
    filled = filled.select(station, F.inline(F.arrays_zip("times", "_f"))).select(station, F.col("times").alias(time), F.nanvl("_f", F.lit(None).cast("double")).alias("_f"))
    keep = [c for c in df.columns if c != out]
    return df.join(filled, [station, time], "left").withColumn(out, F.coalesce(F.col(value), F.col("_f"))).select(*keep, out)
