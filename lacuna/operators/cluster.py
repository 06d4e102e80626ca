"""Series classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.operators.series import STATION, MONTH, longest_streak

# Class thresholds and labels
REACTIVE_ABOVE = 1.0
INTERMEDIATE_ABOVE = 0.4
TWO_WAY_THRESHOLD = 0.4
BUCKETS = [(">30", 30), (">20", 20), (">10", 10)]
BUCKET_LABELS = [">30", ">20", ">10", "<10"]


def fluctuation_index(df: DataFrame, value: str, station: str = STATION, time: str = MONTH) -> DataFrame:
    """On the non-null values in time order, mean |Δ| + sample std of Δ (null when undefined)."""
    w = Window.partitionBy(station).orderBy(time)
    d = (df.filter(F.col(value).isNotNull())
         .withColumn("_d", F.col(value) - F.lag(value, 1).over(w)))
    a = d.groupBy(station).agg(F.avg(F.abs("_d")).alias("_m"), F.stddev_samp("_d").alias("_s"))
    return a.select(station, (F.col("_m") + F.col("_s")).alias("fluctuation_index"))


def fluctuation_class(idx: DataFrame, col: str = "fluctuation_index") -> DataFrame:
    """Three classes."""
    c = (F.when(F.col(col) > REACTIVE_ABOVE, "reactive")
         .when(F.col(col) > INTERMEDIATE_ABOVE, "intermediate")
         .otherwise("inertial"))
    return idx.withColumn("class", c)


def cluster_two_way(idx: DataFrame, col: str = "fluctuation_index", out: str = "cluster") -> DataFrame:
    """The pipeline's split, index > 0.4 → reactive, else (or undefined) inertial."""
    return idx.withColumn(out, F.when(F.coalesce(F.col(col) > TWO_WAY_THRESHOLD, F.lit(False)), "reactive")
                          .otherwise("inertial"))


def assign_clusters(df: DataFrame, value: str, station: str = STATION, time: str = MONTH) -> DataFrame:
    """D9 → D9c joined back: every row gets its station's class."""
    cls = cluster_two_way(fluctuation_index(df, value, station, time)).select(station, "cluster")
    return df.join(cls, station, "left").withColumn("cluster", F.coalesce("cluster", F.lit("inertial")))


def _bucket(c):
    out = F.lit("<10")
    for label, thr in reversed(BUCKETS):
        out = F.when(c > thr, label).otherwise(out)
    return out


def _bucket_counts(per_station: DataFrame, measure: str) -> DataFrame:
    spark = per_station.sparkSession
    b = per_station.groupBy(_bucket(F.col(measure)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    labels = spark.createDataFrame([(x,) for x in BUCKET_LABELS], "bucket string")
    return labels.join(b, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n_stations"))


def duration_years(df: DataFrame, value: str, station: str = STATION, time: str = MONTH) -> DataFrame:
    a = df.filter(F.col(value).isNotNull()).groupBy(station).agg(F.min(time).alias("_a"), F.max(time).alias("_b"))
    return a.select(station, (F.datediff("_b", "_a") / 365.25).alias("years"))


def duration_buckets(df: DataFrame, value: str, station: str = STATION, time: str = MONTH) -> DataFrame:
    """Stations counted by span of non-null data in years (>30, >20, >10, <10)."""
    return _bucket_counts(duration_years(df, value, station, time), "years")


def streak_buckets(df: DataFrame, value: str, station: str = STATION, time: str = MONTH,
                   unit: str = "months") -> DataFrame:
    """Stations counted by longest run of consecutive months; the reference compares months
    with the year thresholds (``unit='months'``); ``unit='years'`` divides by 12 first."""
    s = longest_streak(df, value, station, time)
    m = F.col("longest_streak") if unit == "months" else F.col("longest_streak") / 12.0
    return _bucket_counts(s.withColumn("_m", m), "_m")


def cluster_counts(clusters: DataFrame, station: str = STATION, cluster: str = "cluster") -> DataFrame:
    """Stations per class and the number of distinct classes."""
    per = clusters.select(station, cluster).distinct().groupBy(cluster).agg(F.count(F.lit(1)).alias("n_stations"))
    return per.withColumn("n_classes", F.count(F.lit(1)).over(Window.partitionBy()))


def cluster_override(clusters: DataFrame, overrides: DataFrame, station: str = STATION,
                     cluster: str = "cluster") -> DataFrame:
    """C14: a manual class wins over the computed one."""
    o = overrides.select(station, F.col(cluster).alias("_ov"))
    return (clusters.join(o, station, "left")
            .withColumn(cluster, F.coalesce(F.col("_ov"), F.col(cluster))).drop("_ov"))


def quality_filter(df: DataFrame, value: str, min_years: float, station: str = STATION,
                   time: str = MONTH) -> DataFrame:
    """Keep the stations whose non-null span is at least ``min_years`` years."""
    ok = duration_years(df, value, station, time).filter(F.col("years") >= min_years).select(station)
    return df.join(ok, station, "left_semi")


def cluster_selection(df: DataFrame, types: list[str] | None, cluster: str = "cluster") -> DataFrame:
    """Restrict to the chosen classes; an empty list keeps everything."""
    if not types:
        return df
    return df.filter(F.col(cluster).isin(list(types)))
