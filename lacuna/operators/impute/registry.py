"""Method registry, completion of every enabled variable, best-method application.

A method is ``fn(df, value, station, time, out=...) -> DataFrame`` over (station_id, month, value…) that keeps
the other columns. The registry keys are the reference's method names; ``register`` adds a model plug-in under
any other name. Methods that are window expressions stack on one sort of the series, so any number of them
costs one shuffle; each of the others reads the input that was materialised once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.operators.series import STATION, MONTH

Method = Callable[..., DataFrame]
METHODS: dict[str, Method] = {}
WINDOWED = ("lineaire", "pchip", "akima")  # one window over (station, time) each


def register(name: str, fn: Method) -> None:
    METHODS[name] = fn


def _load_defaults() -> None:
    from lacuna.operators.impute.linear import impute_linear
    from lacuna.operators.impute.local import impute_pchip, impute_akima
    from lacuna.operators.impute.seasonal import impute_seasonal
    from lacuna.operators.impute.knn import impute_knn
    from lacuna.operators.impute import models, splines, similar
    # Method keys accepted by the reference dispatcher
    register("lineaire", impute_linear)
    register("pchip", impute_pchip)
    register("akima", impute_akima)
    register("cubique", splines.impute_cubic)
    register("polynome", splines.impute_quadratic)
    register("spline", splines.impute_smoothing_spline)
    register("knn", impute_knn)
    register("bss", impute_seasonal)
    register("knn_nappe", similar.impute_similar_series)
    register("rf", models.impute_forest_delta)


def get(name: str) -> Method:
    if "lineaire" not in METHODS:
        _load_defaults()
    return METHODS[name]


def with_predictions(df: DataFrame, value: str, methods: list[str], station: str = STATION, time: str = MONTH) -> DataFrame:
    """``df`` with a column ``_p_<method>`` for each of the methods, which are window expressions: one sort of the series."""
    for m in methods:
        df = get(m)(df, value, station, time, out=f"_p_{m}")
    return df


def predictions(df: DataFrame, value: str, methods: list[str], station: str = STATION,
                time: str = MONTH, keep: tuple[str, ...] = ()) -> Iterator[DataFrame]:
    """(station, time, method, pred) and the columns ``keep`` of every row: all window methods as one part, then each other method. ``df`` is
    read once a part; materialise it first if it is dear. A part is planned only when it is asked for."""
    head = [station, time, *keep]
    fused = [m for m in methods if m in WINDOWED]
    if fused:
        cells = F.array(*[F.struct(F.lit(m).alias("method"), F.col(f"_p_{m}").cast("double").alias("pred")) for m in fused])
        # a number of tasks of its own: of a union's branches, AQE would merge one of few bytes into a task or two
        dealt = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), station)
        yield with_predictions(dealt, value, fused, station, time).select(*head, F.inline(cells))
    for m in methods:
        if m not in fused:
            yield get(m)(df, value, station=station, time=time, out="_pred").select(*head, F.lit(m).alias("method"), F.col("_pred").alias("pred"))


def predictions_long(df: DataFrame, value: str, methods: list[str], station: str = STATION,
                     time: str = MONTH, keep: tuple[str, ...] = ()) -> DataFrame:
    """All parts of ``predictions`` as one table."""
    return reduce(DataFrame.unionByName, predictions(df, value, methods, station, time, keep))


def complete_variables(df: DataFrame, plan: dict[str, list[str]], station: str = STATION,
                       time: str = MONTH) -> DataFrame:
    """Add ``{method}_{variable}`` for every enabled (variable, method). Window methods of all variables are
    columns of one sorted pass; the other methods' predictions meet in one aggregation by row and one join."""
    from lacuna.session import cut_lineage
    rest = [(v, m) for v, methods in plan.items() for m in methods if m not in WINDOWED]
    df = cut_lineage(df) if rest else df
    out = df
    for variable, methods in plan.items():
        for m in methods:
            if m in WINDOWED:
                out = get(m)(out, variable, station, time, out=f"{m}_{variable}")
    found = None
    for variable, m in rest:
        p = get(m)(df, variable, station=station, time=time, out="_pred").select(station, time, F.lit(f"{m}_{variable}").alias("_name"), F.col("_pred"))
        found = p if found is None else found.unionByName(p)
    if found is not None:
        wide = found.groupBy(station, time).agg(*[F.max(F.when(F.col("_name") == f"{m}_{v}", F.col("_pred"))).alias(f"{m}_{v}") for v, m in rest])
        out = out.join(wide, [station, time], "left")
    return out.select(*df.columns, *[f"{m}_{v}" for v, methods in plan.items() for m in methods])


def apply_best_method(preds_long: DataFrame, scores: DataFrame, value_df: DataFrame, value: str,
                      station: str = STATION, time: str = MONTH, score: str = "nrmse") -> DataFrame:
    """Per station, the method with the lowest score (ties: method name) fills the gaps."""
    best = (scores.filter(F.col(score).isNotNull())
            .groupBy(station).agg(F.min_by("method", F.struct(F.col(score), F.col("method"))).alias("best_method")))
    chosen = preds_long.join(best, station).filter(F.col("method") == F.col("best_method"))
    j = value_df.join(chosen.select(station, time, "best_method", "pred"), [station, time], "left")
    return j.withColumn("completed", F.coalesce(F.col(value), F.col("pred"))).drop("pred")
