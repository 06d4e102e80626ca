"""Set and reshape operations, ordering and top-k."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.operators.holes import hash_int


def union_all(*dfs: DataFrame) -> DataFrame:
    """G1: duplicates kept, columns matched by name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def unpivot_vintages(df: DataFrame, pairs: list[tuple[str, str]], keep: list[str],
                     time: str = "year", value: str = "sealed_area") -> DataFrame:
    """Each (vintage, value) column pair becomes one row."""
    arr = F.array(*[F.struct(F.col(t).alias(time), F.col(v).alias(value)) for t, v in pairs])
    return df.select(*keep, F.inline(arr))


def month_year_pivot(df: DataFrame, value: str, years: list[int], time: str = "month") -> DataFrame:
    """Calendar month (rows) × year (columns ``y<year>``) with the largest value; the years are given."""
    t = df.select(F.month(time).alias("month_of_year"), F.year(time).alias("_y"), F.col(value).alias("_v"))
    p = t.groupBy("month_of_year").pivot("_y", years).agg(F.max("_v"))
    return p.select("month_of_year", *[F.col(f"`{y}`").alias(f"y{y}") for y in years])


def config_grid(spark, axes: dict[str, list]) -> DataFrame:
    """Cartesian product of the hyper-parameter axes, built by exploding literal arrays
    (one row per configuration, no join)."""
    df = spark.range(1).select()
    for name, values in axes.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def tiles(df: DataFrame, station: str, width: int) -> DataFrame:
    """(station, tile): stations dealt by hash to as many tiles as ``width`` stations each need on average."""
    ids = df.select(station).distinct()
    n = ids.select(F.greatest(F.ceil(F.count(F.lit(1)) / width), F.lit(1)).cast("long")).scalar()
    return ids.select(station, (hash_int(F.col(station), "tile") % n).alias("tile"))


def tiled(df: DataFrame, keys: list[str], value: str, station: str = "station_id", width: int = 1000) -> DataFrame:
    """keys…, tile, and the tile's ``stations`` that have a row there and their ``values``, as arrays in station
    order, one row for each key and tile: a wide table cut into tiles of columns, for any number of stations."""
    cells = F.sort_array(F.collect_list(F.struct(F.col(station).alias("id"), F.col(value).alias("v"))))
    rows = df.join(tiles(df, station, width), station).groupBy(*keys, "tile").agg(cells.alias("_c"))
    return rows.select(*keys, "tile", F.col("_c.id").alias("stations"), F.col("_c.v").alias("values"))


def pivot_series(df: DataFrame, value: str, station: str = "station_id", time: str = "month", width: int = 1000) -> DataFrame:
    """Long → month × station, in tiles of about ``width`` station columns (report output only; computations stay long)."""
    return tiled(df, [time], value, station, width)


def unpivot_scores(wide: DataFrame, keys: list[str], variables: list[str], value: str = "nrmse") -> DataFrame:
    """``{method}_{variable}`` columns → (keys…, method, variable, value); the variable is matched
    on the known variable suffixes (a name may contain '_')."""
    cols = [c for c in wide.columns if c not in keys]
    long = wide.unpivot(keys, cols, "column", value)
    pat = "^(.*)_(" + "|".join(variables) + ")$"
    return (long.withColumn("method", F.regexp_extract("column", pat, 1))
            .withColumn("variable", F.regexp_extract("column", pat, 2))
            .filter(F.col("variable") != "").drop("column"))


def score_matrix_by_cluster(scores: DataFrame, station: str = "station_id", value: str = "nrmse", width: int = 1000) -> DataFrame:
    """Method × station matrix per (cluster, variable), in tiles of about ``width`` station columns."""
    return tiled(scores, ["cluster", "variable", "method"], value, station, width)


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """G7."""
    return df.select(col).distinct().orderBy(col)


def sort_series(df: DataFrame, cols: list[str]) -> DataFrame:
    """total order at the edge of a job (range-partitioned sort)."""
    return df.orderBy(*cols)


def best_config(log: DataFrame) -> DataFrame:
    """the row with the smallest (val_loss, −val_accuracy); NaN accuracy sorts last."""
    acc = F.when(F.isnan("val_accuracy"), F.lit(None)).otherwise(F.col("val_accuracy"))
    return log.orderBy(F.col("val_loss").asc_nulls_last(), acc.desc_nulls_last()).limit(1)


def sort_stations(classes: DataFrame, spans: DataFrame, streaks: DataFrame, station: str = "station_id") -> DataFrame:
    """stations ordered by class, total available time (desc), longest continuous run (desc)."""
    j = classes.join(spans, station, "left").join(streaks, station, "left")
    return j.orderBy("cluster", F.col("years").desc_nulls_last(), F.col("longest_streak").desc_nulls_last(), station)
