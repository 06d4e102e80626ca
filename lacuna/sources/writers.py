"""Writers (A8–A10, A12). Output goes to the given (shared) path; no forced single file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.text import safe_name


def write_per_station(df: DataFrame, path: str, station: str = "station_id", fmt: str = "csv", sep: str = ";",
                      time: str = "month", rows: int = 1_000_000) -> DataFrame:
    """The series sorted by station and time in files of at most ``rows`` rows, and a manifest beside them
    (``<path>-manifest``): for each station its ``station_file`` (``data_`` and the id with '/' → '_'), the files that hold
    it, and its rows in each. A station may span files, so none has to fit one task; no store gets a folder a station."""
    named = df.withColumn("station_file", F.concat(F.lit("data_"), safe_name(F.col(station).cast("string"))))
    order = ["station_file", *([time] if time in df.columns else [])]
    w = named.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option("maxRecordsPerFile", rows)
    spark = df.sparkSession
    if fmt == "csv":
        w.option("sep", sep).option("header", True).csv(path)
        back = spark.read.schema(named.schema).option("sep", sep).option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
        back = spark.read.format(fmt).load(path)
    manifest = back.groupBy("station_file", F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))
    manifest.write.mode("overwrite").parquet(f"{path.rstrip('/')}-manifest")
    return spark.read.parquet(f"{path.rstrip('/')}-manifest")


def read_station(spark, path: str, station, schema: str, sep: str = ";") -> DataFrame:
    """One station's rows: only the files that the manifest names for it are read."""
    name = "data_" + str(station).replace("/", "_")
    files = [r.file for r in spark.read.parquet(f"{path.rstrip('/')}-manifest").filter(F.col("station_file") == name).select("file").collect()]
    if not files:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema + ", station_file string").option("sep", sep).option("header", True).csv(files)
            .filter(F.col("station_file") == name).drop("station_file"))


def write_by_cluster(df: DataFrame, path: str, cluster: str = "cluster") -> None:
    """Both class folders replaced, each station written under its class."""
    df.write.mode("overwrite").partitionBy(cluster).parquet(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", sep: str = ";") -> None:
    """A10: a whole table; parquet by default, ';' CSV on request (many part files)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("sep", sep).option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def append_run_log(df: DataFrame, path: str) -> None:
    """Append result rows to the log table (header written with every part file)."""
    df.write.mode("append").option("header", True).csv(path)
