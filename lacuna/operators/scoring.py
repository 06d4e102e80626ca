"""Scoring on artificial holes and method evaluation."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions import stats as ST
from lacuna.operators.holes import holes_blocks
from lacuna.operators.impute.registry import predictions
from lacuna.operators.series import STATION, MONTH
from lacuna.session import cut_lineage, release, staged


def _method_by_method(parts: Iterable[DataFrame], score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The scores of all parts of the predictions. Each part's few scores are materialised before the next part is planned, so no more than one
    method's predictions and shuffle files are there at a time."""
    found, rest = [], iter(parts)
    while (part := next(rest, None)) is not None:
        spark, part = part.sparkSession, cut_lineage(score(part))
        found.append(part)
        release(spark)
    return reduce(DataFrame.unionByName, found)


def score_on_holes(df: DataFrame, value: str, methods: list[str], pct: float = 0.2,
                   sizes: tuple[int, int] = (1, 5), seed: int = 42, station: str = STATION,
                   time: str = MONTH, carry: tuple[str, ...] = ("lat", "lon", "cluster")) -> DataFrame:
    """NRMSE per (station, method) on the rows nulled by the holes where truth and prediction
    exist; null when there is no such row. Carries the first lat/lon/cluster in time order.

    The holed series are materialised once; truth, hole flag and carried columns go with the rows through the
    methods, so scores, keys and carried values are one aggregation of a method's predictions."""
    holed = staged(holes_blocks(df, value, pct, seed, sizes, station, time))
    present = [c for c in carry if c in df.columns]
    hit = F.col("hole") & F.col("truth").isNotNull() & F.col("pred").isNotNull()

    def score(preds: DataFrame) -> DataFrame:
        scored = preds.withColumn("_t", F.when(hit, F.col("truth"))).withColumn("_p", F.when(hit, F.col("pred")))
        return (scored.groupBy(station, "method")
                .agg(F.when(F.count("_t") > 0, ST.nrmse("_t", "_p")).alias("nrmse"), *[F.min_by(c, F.col(time)).alias(c) for c in present]))

    keep = ("truth", "hole", *[c for c in present if c not in (station, time)])
    return _method_by_method(predictions(holed, value, methods, station, time, keep), score).withColumn("variable", F.lit(value))


def evaluate_methods(preds: DataFrame, truth: DataFrame, value: str, pct: float, skip: int = 6,
                     station: str = STATION, time: str = MONTH) -> DataFrame:
    """I4: NMAE and NRMSE per (station, method) over the whole series minus its first ``skip``
    rows; one null truth or prediction in that range makes the metric null (NaN in the reference)."""
    t = preds.join(truth.select(station, time, F.col(value).alias("_real")), [station, time])
    return _errors(t, [station], skip, time).withColumnRenamed(station, "dataset").withColumn("pct_removed", F.lit(float(pct)))


def _errors(t: DataFrame, series: list[str], skip: int, time: str) -> DataFrame:
    """NMAE and NRMSE of ``pred`` against ``_real`` by series and method."""
    w = Window.partitionBy(*series, "method").orderBy(time)
    t = t.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") > skip)
    return t.groupBy(*series, "method").agg(
        ST.strict(ST.nmae("_real", "pred"), "_real", "pred").alias("NMAE"),
        ST.strict(ST.nrmse("_real", "pred"), "_real", "pred").alias("NRMSE"))


def evaluate_all(df: DataFrame, value: str, methods: list[str], rates: list[float], seed: int = 42,
                 sizes: tuple[int, int] = (1, 6),
                 station: str = STATION, time: str = MONTH, cluster: str = "cluster") -> DataFrame:
    """Every series × removal rate × method (no loop over files).

    A series under one rate is a series of its own (``_sid``: station and the rate's number, and so is its class), so
    all rates go through each method together: one shuffle for all window methods and rates, one search for
    each other method. F5, the limit on the series evaluated, is a filter on ``df``'s stations by the caller.
    """
    base = staged(df)
    whole = dict(base.dtypes)[station] in ("tinyint", "smallint", "int", "bigint")
    parts = None
    for i, rate in enumerate(rates):
        sid = F.col(station).cast("long") * len(rates) + i if whole else F.concat_ws("|", F.lit(str(i)), F.col(station).cast("string"))
        holed = holes_blocks(base, value, rate, seed + i, sizes, station, time).withColumn("_sid", sid).withColumn("_rate", F.lit(i))
        if cluster in base.columns:
            holed = holed.withColumn(cluster, F.concat_ws("|", F.col(cluster), F.lit(str(i))))
        parts = holed if parts is None else parts.unionByName(holed)
    holed = staged(parts.withColumnRenamed(station, "dataset"))
    e = _method_by_method(predictions(holed, value, methods, "_sid", time, ("truth", "dataset", "_rate")),
                          lambda preds: _errors(preds.withColumnRenamed("truth", "_real"), ["_sid", "dataset", "_rate"], 6, time))
    return e.select("dataset", "method", "NMAE", "NRMSE", F.get(F.array(*[F.lit(float(r)) for r in rates]), F.col("_rate")).alias("pct_removed"))


def nse(preds: DataFrame, truth: DataFrame, value: str, station: str = STATION, time: str = MONTH) -> DataFrame:
    """1 − Σ(r−p)² / Σ(r−mean r)² per (station, method); null when the denominator is 0."""
    t = preds.join(truth.select(station, time, F.col(value).alias("_r")), [station, time])
    t = t.withColumn("_mean", F.avg("_r").over(Window.partitionBy(station, "method")))
    num, den = ST.nse_parts("_r", "pred", "_mean")
    g = t.groupBy(station, "method").agg(num.alias("_num"), den.alias("_den"))
    return g.select(station, "method", (F.lit(1.0) - F.col("_num") / F.nullif(F.col("_den"), F.lit(0.0))).alias("nse"))


def mean_error_by_method(errors: DataFrame) -> DataFrame:
    """D18."""
    return errors.groupBy("method").agg(F.avg("NMAE").alias("mean_nmae"), F.avg("NRMSE").alias("mean_nrmse"))


def error_pivot(errors: DataFrame, methods: list[str], metric: str = "NRMSE") -> DataFrame:
    """Dataset × method table of the mean metric."""
    return errors.groupBy("dataset").pivot("method", methods).agg(F.avg(metric))


def method_rank(errors: DataFrame, metric: str = "NRMSE", group=("dataset", "pct_removed")) -> DataFrame:
    """Rank of each method within a dataset (ties share a rank)."""
    return errors.withColumn("rank", F.rank().over(Window.partitionBy(*group).orderBy(F.col(metric).asc_nulls_last())))


def method_league(errors: DataFrame, metric: str = "NRMSE", group=("dataset", "pct_removed")) -> DataFrame:
    """Per method, times ranked first, times ranked last, mean rank."""
    r = method_rank(errors, metric, group)
    r = r.withColumn("_last", F.rank().over(Window.partitionBy(*group).orderBy(F.col(metric).desc_nulls_first())))
    return r.groupBy("method").agg(F.sum(F.when(F.col("rank") == 1, 1).otherwise(0)).alias("first"),
                                   F.sum(F.when(F.col("_last") == 1, 1).otherwise(0)).alias("last"),
                                   F.avg("rank").alias("mean_rank"))


def summary_range(scores_long: DataFrame, metric: str = "nrmse") -> DataFrame:
    """Over all score cells, nulls as 0: global max and mean (colour scale = 2×mean)."""
    v = F.coalesce(F.col(metric), F.lit(0.0))
    return scores_long.agg(F.max(v).alias("max_score"), F.avg(v).alias("mean_score"),
                           (F.avg(v) * 2).alias("scale_max"))
