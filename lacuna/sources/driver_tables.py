"""Domain tables derived from the driver's TPC-H-like parquet tables.

The reference ships no data, so the station/point/soil tables are re-expressed on top of the
driver tables with fixed, reproducible arithmetic (the same rules are written in the DuckDB
oracle). All work is Spark-side and grows with the input tables.

Fixed derivation rules (must stay identical to the oracle SQL):
  readings      lineitem; station = l_suppkey; time = day of l_shipdate;
                level = l_quantity, null unless l_returnflag = 'R'; lat = 41 + (key*37 % 1000)/100; lon = -5 + (key*91 % 1400)/100
  points        orders x customer by c_nationkey and month of o_orderdate;
                lat = 41 + (nation*53 % 1000)/100; lon = -5 + (nation*71 % 1400)/100;
                rain = avg(o_totalprice), null when (nation + month-of-year) % 4 = 0;
                temp = count(*), null when (nation + month-of-year) % 3 = 0
  pet_daily     orders x customer: one row per order at the nation point, pet = o_totalprice/100000,
                null when o_orderstatus = 'P'
  soil          nation x {2020, 2023}: sealed = nation*10 + year - 2019, total = 1000 + nation
  daily         events: station = user_id, day of ts, value = avg(value)
  sparse        orders: station = o_custkey, month of o_orderdate, value = avg(o_totalprice)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.functions import calendar as cal


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def station_lat(key) -> F.Column:
    return F.lit(41.0) + (key * 37 % 1000) / 100.0


def station_lon(key) -> F.Column:
    return F.lit(-5.0) + (key * 91 % 1400) / 100.0


def point_lat(key) -> F.Column:
    return F.lit(41.0) + (key * 53 % 1000) / 100.0


def point_lon(key) -> F.Column:
    return F.lit(-5.0) + (key * 71 % 1400) / 100.0


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw station readings: station_id, time (date), level, lat, lon."""
    li = table(spark, sf_dir, "lineitem")
    return (li.select(F.col("l_suppkey").alias("station_id"),
                    F.to_date("l_shipdate").alias("time"),
                    F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).alias("level"),
                    station_lat(F.col("l_suppkey")).alias("lat"),
                    station_lon(F.col("l_suppkey")).alias("lon")))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("station_id"), F.col("s_name").alias("name"),
                    station_lat(F.col("s_suppkey")).alias("lat"),
                    station_lon(F.col("s_suppkey")).alias("lon"))


def _orders_with_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return o.join(c, "o_custkey")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly weather points: lat, lon, month, rain, temp (nulls by a fixed rule)."""
    j = _orders_with_nation(spark, sf_dir).withColumn("month", cal.month_floor("o_orderdate"))
    g = j.groupBy("c_nationkey", "month").agg(F.avg("o_totalprice").alias("rain_v"),
                                                F.count(F.lit(1)).cast("double").alias("temp_v"))
    moy = F.month("month")
    return g.select(
        point_lat(F.col("c_nationkey")).alias("lat"),
        point_lon(F.col("c_nationkey")).alias("lon"),
        "month",
        F.when((F.col("c_nationkey") + moy) % 4 == 0, None).otherwise(F.col("rain_v")).alias("rain"),
        F.when((F.col("c_nationkey") + moy) % 3 == 0, None).otherwise(F.col("temp_v")).alias("temp"))


def pet_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily PET readings at nation points: lat, lon, time (date), pet."""
    j = _orders_with_nation(spark, sf_dir)
    return j.select(point_lat(F.col("c_nationkey")).alias("lat"),
                    point_lon(F.col("c_nationkey")).alias("lon"),
                    F.to_date("o_orderdate").alias("time"),
                    F.when(F.col("o_orderstatus") == "P", None)
                    .otherwise(F.col("o_totalprice") / 100000.0).alias("pet"))


def soil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Soil sealing table: lat, lon, year, sealed_area, total_area (two vintages per nation)."""
    n = table(spark, sf_dir, "nation").select("n_nationkey")
    years = F.array(F.lit(2020), F.lit(2023))
    return (n.select("n_nationkey", F.explode(years).alias("year"))
            .select(point_lat(F.col("n_nationkey")).alias("lat"),
                    point_lon(F.col("n_nationkey")).alias("lon"),
                    "year",
                    (F.col("n_nationkey") * 10 + F.col("year") - 2019).cast("double").alias("sealed_area"),
                    (F.col("n_nationkey") + 1000).cast("double").alias("total_area")))


def soil_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Soil as delivered: one row per commune with two vintages side by side (input of G2)."""
    n = table(spark, sf_dir, "nation").select("n_nationkey")
    k = F.col("n_nationkey")
    return n.select(point_lat(k).alias("lat"), point_lon(k).alias("lon"),
                    (k + 1000).cast("double").alias("total_area"),
                    F.lit(2020).alias("vintage_1"), (k * 10 + 1).cast("double").alias("sealed_1"),
                    F.lit(2023).alias("vintage_2"), (k * 10 + 4).cast("double").alias("sealed_2"))


def daily_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return (e.groupBy(F.col("user_id").alias("station_id"), F.to_date("ts").alias("time"))
            .agg(F.avg("value").alias("level")))


def sparse_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(F.col("o_custkey").alias("station_id"), cal.month_floor("o_orderdate").alias("month"))
            .agg(F.avg("o_totalprice").alias("level")))


def spectra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amplitude vectors: station_id, cluster, amp (all entries of the embedding)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("station_id"), F.col("label").cast("string").alias("cluster"),
                    F.transform("embedding", lambda v: v.cast("double")).alias("amp"))
