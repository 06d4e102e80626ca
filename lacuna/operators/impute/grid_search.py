"""Hyper-parameter search for the window model, with a run log that a later call resumes from.

A configuration is a hole rate, a window size and a ridge term. The rate decides the data; size and
ridge only need its Gram matrix for the largest size. So one pass over the series for each
untried rate gives the matrices of the training rows (the first part of every series) and of the validation
rows (the rest), and all its configurations are fitted and judged from these. Results go to the log rate by
rate; a call after a failure takes up what is not in the log, and one whose configurations are all
there reads no series.
"""

from __future__ import annotations

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.operators.impute import window_model as WM
from lacuna.operators.joins import skip_done
from lacuna.operators.reshape import best_config, config_grid
from lacuna.operators.series import MONTH, STATION
from lacuna.session import cut_lineage
from lacuna.sources.writers import append_run_log

KEYS = ["pct", "size", "ridge"]
LOG = "pct double, size int, ridge double, val_loss double, val_accuracy double"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(LOG).option("header", True).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def halves(series: DataFrame, k: int, share: float) -> DataFrame:
    """Each series of arrays as two: ``part`` "train", its first ``share`` of the rows, and "val", the rest."""
    cut = F.floor(F.size("y") * F.lit(share)).cast("int")
    rest = F.size("y") - cut
    part = lambda name, first, n: F.struct(F.lit(name).alias("part"), F.slice("x", first * k + 1, n * k).alias("x"), F.slice("y", first + 1, n).alias("y"))
    return series.select(F.inline(F.array(part("train", F.lit(0), cut), part("val", cut, rest)))).filter(F.size("y") > 0)


def accuracy(u: np.ndarray, loss: float) -> float:
    """Share of the validation truth's variance that is explained."""
    n = u[0, 0]
    variance = u[-1, -1] / n - (u[0, -1] / n) ** 2 if n else 0.0
    return float(1 - loss / variance) if variance > 0 else float("nan")


def grid_search(df: DataFrame, value: str, features: list[str], log_path: str, sizes: list[int], ridges: list[float], pcts: list[float],
                holed: list[str] | None = None, share: float = 0.8, seed: int = 42, station: str = STATION, time: str = MONTH) -> DataFrame:
    """Fits what the log lacks, appends it, and returns the log's row of least loss (then greatest accuracy). The
    grid is a few hundred rows at most; a configuration that can't be fitted is not logged."""
    spark = df.sparkSession
    grid = config_grid(spark, {"pct": [float(p) for p in pcts], "size": [int(s) for s in sizes], "ridge": [float(r) for r in ridges]})
    todo: dict[float, list[tuple[int, float]]] = {}
    for r in skip_done(grid, read_log(spark, log_path), KEYS).collect():
        todo.setdefault(r.pct, []).append((r["size"], r.ridge))
    if todo:
        df, k = cut_lineage(df), len(features)
    for pct, configs in sorted(todo.items()):
        most = max(s for s, _ in configs)
        series, _ = WM.training_series(df, value, features, holed, None, pct, seed, station, time)
        found = WM.gram(halves(series, k, share), k, most, "part")
        rows = []
        for size, ridge in sorted(configs):
            train, val = (WM.narrower(found[s], k, most, size) if s in found else np.zeros((2, 2)) for s in ("train", "val"))
            try:
                weights = WM.solve(train, k, size, ridge)
            except np.linalg.LinAlgError:
                continue
            if weights is not None and val[0, 0] > 0:
                loss = WM.loss(val, k, size, weights)
                rows.append((pct, size, ridge, loss, accuracy(val, loss)))
        if rows:
            append_run_log(spark.createDataFrame(rows, LOG).coalesce(1), log_path)
    return best_config(read_log(spark, log_path))
