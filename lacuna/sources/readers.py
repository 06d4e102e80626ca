"""Readers (A1–A7, A13–A15). Every reader declares its schema; nothing is inferred twice."""

from __future__ import annotations

import gzip
import io
import re
import zipfile
from collections.abc import Iterator
from typing import IO

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.functions.text import clean_header

SERIES_SCHEMA = "station_id string, month date, level double, lon double, lat double"


def by_name(df: DataFrame, schema: str) -> DataFrame:
    """The declared columns, cast, taken by name; a column that is not there is null."""
    have = {c.strip(): c for c in df.columns}
    fields = T.StructType.fromDDL(schema).fields
    return df.select(*[(F.col(f"`{have[f.name]}`").cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                       for f in fields])


def scan_series_csv(spark: SparkSession, path: str, schema: str = SERIES_SCHEMA, sep: str = ";") -> DataFrame:
    """A1: one ';' CSV with a header, columns taken by name. Ordering is left to the consumer that needs it."""
    return by_name(spark.read.option("sep", sep).option("header", True).option("enforceSchema", False).csv(path), schema)


def scan_series_folder(spark: SparkSession, folder: str, schema: str = SERIES_SCHEMA, sep: str = ";",
                       glob: str = "*.csv", with_file: bool = False) -> DataFrame:
    """Every file of a folder (recursively) matching ``glob`` as one table, columns taken by
    name; an empty folder gives an empty table. A file whose header differs from the others' raises an
    error (see ``scan_schema_drift``)."""
    try:
        df = (spark.read.option("sep", sep).option("header", True).option("enforceSchema", False)
              .option("pathGlobFilter", glob).option("recursiveFileLookup", True).csv(folder))
    except AnalysisException as e:  # folder without any matching file
        if not _absent(e):
            raise
        return spark.createDataFrame([], schema)
    if with_file:
        return by_name(df.select("*", F.col("_metadata.file_path").alias("source_file")), schema + ", source_file string")
    return by_name(df, schema)


def _absent(e: AnalysisException) -> bool:
    return e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def scan_suffix_filter(spark: SparkSession, folder: str, suffix: str, schema: str, sep: str = ",") -> DataFrame:
    """Entries of the folder whose name ends with ``suffix`` (a file, or a table folder of part
    files written by Spark), unioned."""
    return (spark.read.schema(schema).option("sep", sep).option("header", True)
            .csv(f"{folder.rstrip('/')}/*{suffix}"))


def _streams(content: bytes) -> Iterator[IO[bytes]]:
    """The CSV byte streams in a gzip or zip file, by its magic bytes."""
    if content[:2] == b"PK":
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for name in z.namelist():
                if name.endswith(".csv"):
                    with z.open(name) as f:
                        yield f
    else:
        with gzip.open(io.BytesIO(content)) as f:
            yield f


def _kinds(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The files by what their first two bytes say: "zip", "gzip" or "plain". Two bytes of each are read, by Spark's file system layer."""
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out: dict[str, list[str]] = {"zip": [], "gzip": [], "plain": []}
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        stream = path.getFileSystem(conf).open(path)
        try:
            head = (stream.read(), stream.read())
        finally:
            stream.close()
        out["zip" if head == (0x50, 0x4B) else "gzip" if head == (0x1F, 0x8B) else "plain"].append(p)
    return out


def scan_mixed_compressed(spark: SparkSession, folder: str, schema: str, sep: str = ";",
                          glob: str = "*.csv*", multiline: bool = True) -> DataFrame:
    """A3: plain, gzip and zip files (decided by their first bytes, not by extension), columns taken by name.

    Plain files and gzip files with that extension go to the CSV reader, at any size: as streams, or plain ones in
    splits if ``multiline`` is off, when no value holds a quoted line break. A zip file,
    or a gzip file under another name, is one task (``binaryFile``, which takes files up to 2 GB): its members are
    decompressed and parsed as streams, rows with quoted line breaks included, and leave in batches."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    kinds = _kinds(spark, [r.path for r in listed.filter("length > 0").select("path").collect()])  # one row for each file
    by_extension = [p for p in kinds["gzip"] if p.endswith(".gz")]
    fields = T.StructType.fromDDL(schema).fields
    names = [f.name for f in fields]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                for f in _streams(bytes(content)):
                    for part in pd.read_csv(f, sep=sep, dtype=str, keep_default_na=False, na_values=[""], chunksize=10_000):
                        yield part.rename(columns=str.strip).reindex(columns=names).astype(object).where(lambda d: d.notna(), None)

    out = spark.createDataFrame([], schema)
    if kinds["plain"] or by_extension:
        out = out.unionByName(scan_schema_drift(spark, [*kinds["plain"], *by_extension], schema, sep, multiline=multiline))
    packed = [*kinds["zip"], *(p for p in kinds["gzip"] if not p.endswith(".gz"))]
    if packed:
        raw = spark.read.format("binaryFile").load(packed).select("content")
        t = raw.mapInPandas(rows, T.StructType([T.StructField(n, T.StringType()) for n in names]))
        out = out.unionByName(t.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]))
    return out


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines with their file, whether they lie in its first block, and a number that grows by one from
    line to line of a block."""
    return (spark.read.text(paths)
            .select("value", F.col("_metadata.file_path").alias("file"), (F.col("_metadata.file_block_start") == 0).alias("first"),
                    F.monotonically_increasing_id().alias("at")))


def _headers(lines: DataFrame, skip: int) -> DataFrame:
    """(file, header, header_at): line ``skip`` + 1 of each file."""
    start = lines.filter("first").groupBy("file").agg((F.min("at") + skip).alias("header_at"))
    return (lines.filter("first").withColumnRenamed("file", "f").join(start, (F.col("f") == F.col("file")) & (F.col("at") == F.col("header_at")))
            .select("file", F.col("value").alias("header"), "header_at"))


def scan_schema_drift(spark: SparkSession, paths: list[str], schema: str, sep: str = ";",
                      order_by: str | None = None, multiline: bool = False) -> DataFrame:
    """A4: files with different column sets; the declared columns by name, absent ones null. ``multiline``: values
    may hold quoted line breaks, and a file is then one stream.

    One job reads the first lines of all files; the files of each distinct header are then one scan."""
    found: dict[str, list[str]] = {}
    for r in _headers(_lines(spark, paths), 0).select("header", "file").collect():  # one row for each file
        found.setdefault(r.header, []).append(r.file)
    out = None
    for header in sorted(found):
        part = by_name(spark.read.option("sep", sep).option("header", True).option("enforceSchema", False).option("multiLine", multiline)
                       .option("escape", '"').csv(sorted(found[header])), schema)
        out = part if out is None else out.unionByName(part)
    out = spark.createDataFrame([], schema) if out is None else out
    return out.orderBy(order_by) if order_by else out


def scan_with_preamble(spark: SparkSession, folder: str, schema: str, skip: int = 4, sep: str = ";") -> DataFrame:
    """A5: files whose header stands after ``skip`` lines. Header names are cleaned (``#`` removed, trimmed)
    and matched to the declared columns by name. Files are read line by line in splits, so a quoted line
    break is not a part of a value here."""
    lines = _lines(spark, folder)
    heads = _headers(lines, skip).withColumnRenamed("file", "f")
    rows = lines.join(heads, F.col("file") == F.col("f")).filter((~F.col("first") | (F.col("at") > F.col("header_at"))) & (F.trim("value") != ""))
    names = F.split("header", re.escape(sep))
    width = heads.agg(F.max(F.size(names))).first()[0] or 1  # of the longest header
    rows = rows.select("value", F.transform(names, lambda c: clean_header(c)).alias("names"))
    cells = F.from_csv("value", ", ".join(f"c{i} string" for i in range(width)), {"sep": sep, "maxColumns": str(max(width, 20480))})
    rows = rows.select("names", cells.alias("c")).select("names", F.array(*[F.col(f"c.c{i}") for i in range(width)]).alias("cells"))
    out = []
    for f in T.StructType.fromDDL(schema).fields:
        at = F.array_position("names", f.name).cast("int")
        out.append(F.when(at > 0, F.get("cells", at - 1)).cast(f.dataType).alias(f.name))
    return rows.select(*out)


def header_names(spark: SparkSession, folder: str, skip: int = 4, sep: str = ";") -> DataFrame:
    """K9 on the header line that follows the preamble."""
    heads = _headers(_lines(spark, folder), skip)
    return heads.select(F.posexplode(F.split("header", re.escape(sep))).alias("i", "raw")).select("i", clean_header("raw").alias("name"))


def explode_api_pages(spark: SparkSession, folder: str, item_schema: str, multiline: bool = True) -> DataFrame:
    """Landed pages ``{"data": [...]}`` → one row per item (one page per file with
    ``multiline``; one page per line otherwise)."""
    schema = f"data array<struct<{item_schema}>>"
    pages = spark.read.schema(schema).option("multiLine", multiline).json(folder)
    return pages.select(F.explode("data").alias("d")).select("d.*")


def filter_manifest(spark: SparkSession, folder: str, formats: list[str] | None = None,
                    departments: list[str] | None = None, multiline: bool = True) -> DataFrame:
    """Catalogue ``{"resources": [...]}`` → resources whose lower(format) is wanted, or whose
    lower(title‖url) contains ``_<dept>`` for a department."""
    schema = "resources array<struct<title string, url string, format string>>"
    r = (spark.read.schema(schema).option("multiLine", multiline).json(folder)
         .select(F.explode("resources").alias("r")).select("r.*")
         .withColumn("format", F.coalesce("format", F.lit(""))))
    if formats is not None:
        r = r.filter(F.lower("format").isin([f.lower() for f in formats]))
    if departments is not None:
        text = F.lower(F.concat(F.coalesce("title", F.lit("")), F.coalesce("url", F.lit(""))))
        cond = F.lit(False)
        for d in departments:
            cond = cond | text.contains(f"_{d}".lower())
        r = r.filter(cond)
    return r


def read_summary(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Score table without lat, lon, cluster (absent names are ignored)."""
    return spark.read.format(fmt).load(path).drop("lat", "lon", "cluster")


def read_clusters_or_fused(spark: SparkSession, clustered_path: str, fused_path: str) -> DataFrame:
    """The clustered table when it is there and holds data, otherwise the fused table with a null class."""
    try:
        c = spark.read.parquet(clustered_path)
    except AnalysisException as e:
        if not _absent(e):
            raise
        c = None
    if c is not None and not c.isEmpty():
        return c
    return spark.read.parquet(fused_path).withColumn("cluster", F.lit(None).cast("string"))
