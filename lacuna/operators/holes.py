"""Reproducible artificial holes.

Randomness is a hash, not a generator state: ``md5(station | position | seed | tag)``, so the holes
are the same on every executor, after a retry, and in the SQL oracle. Stations with fewer than 4
known values left are dropped, as in the reference.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.operators.series import STATION, MONTH

MIN_KNOWN = 4


def hash_int(*parts) -> Column:
    """First 32 bits of md5 over the '|'-joined parts, as a non-negative long."""
    s = F.concat_ws("|", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("long")


def year_range_mask(df: DataFrame, value: str, first_year: int, last_year: int, time: str = MONTH) -> DataFrame:
    """Null the value for years in [first, last], only when first < last."""
    if first_year < last_year:
        return df.withColumn(value, F.when(F.year(time).between(first_year, last_year), F.lit(None)).otherwise(F.col(value)))
    return df


def _finish(t: DataFrame, value: str, station: str, truth: str) -> DataFrame:
    t = t.withColumn("_k", F.count(value).over(Window.partitionBy(station)))
    return t.filter(F.col(station).isNotNull() & (F.col("_k") >= MIN_KNOWN)).select(station, *[c for c in t.columns if c not in (station, "_k")])


def holes_points(df: DataFrame, value: str, pct: float, seed: int = 42, station: str = STATION,
                 time: str = MONTH, first_year: int = 0, last_year: int = 0, truth: str = "truth") -> DataFrame:
    """Null int(n·pct) rows per series (any row, known or not), chosen by hash order."""
    w = Window.partitionBy(station).orderBy(time)
    t = df.withColumn(truth, F.col(value)).withColumn("_pos", F.row_number().over(w) - 1)
    t = year_range_mask(t, value, first_year, last_year, time)
    n = F.count(F.lit(1)).over(Window.partitionBy(station))
    t = t.withColumn("_h", hash_int(F.col(station), F.col("_pos"), seed))
    t = t.withColumn("_r", F.row_number().over(Window.partitionBy(station).orderBy("_h", "_pos")))
    t = t.withColumn("_nrem", F.floor(n * F.lit(pct)))
    t = t.withColumn("hole", F.col("_r") <= F.col("_nrem"))
    t = t.withColumn(value, F.when(F.col("hole"), F.lit(None)).otherwise(F.col(value))).drop("_h", "_r", "_nrem", "_pos")
    return _finish(t, value, station, truth)


def block_rows(name: str | None, n: int, pct: float, seed: int, sizes: tuple[int, int]) -> list[int]:
    """The rows of a series of ``n`` rows that the kept blocks hit; ``name``: the station as text.

    Candidate block b < M has length a + h(b,'len') mod (b−a+1) and a start drawn in [0, n−len];
    blocks M… are all single rows in hash order, so the target is always reachable. Blocks are applied in order
    and block b is kept iff the distinct rows removed before it are fewer than int(n·pct).
    """
    def drawn(number: int, tag: str) -> int:  # hash_int
        return int.from_bytes(hashlib.md5("|".join([name, str(number), str(seed), tag]).encode()).digest()[:4], "big")

    (a, b), target, hit = sizes, math.floor(n * pct), set()
    for block in range(2 * target):
        if len(hit) >= target:
            break
        length = min(a + drawn(block, "len") % (b - a + 1), n)
        start = drawn(block, "start") % (n - length + 1)
        hit.update(range(start, start + length))
    if len(hit) < target:
        for _, row in sorted((drawn(row, "tail"), row) for row in range(n)):
            if len(hit) >= target:
                break
            hit.add(row)
    return sorted(hit)


def hole_arrays(df: DataFrame, pct: float, seeds: list[int], sizes: tuple[int, int] = (1, 5), station: str = STATION) -> DataFrame:
    """(station, _holes): the rows hit (I2) under each of the seeds. Holes depend on a station and its number of rows only, so
    the rows are counted and each station's blocks are drawn in one task; none for a null station."""
    counts = df.filter(F.col(station).isNotNull()).groupBy(station).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select(station, F.col(station).cast("string").alias("_name"), "_n")
    kind = counts.schema[station].dataType.simpleString()

    def run(batches):
        for b in batches:
            found = [[block_rows(name, n, pct, seed, sizes) for seed in seeds] for name, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(pa.list_(pa.int32())))], [station, "_holes"])

    return counts.mapInArrow(run, f"`{station}` {kind}, _holes array<array<int>>")


def hole_blocks(df: DataFrame, pct: float, seed: int = 42, sizes: tuple[int, int] = (1, 5),
                station: str = STATION, time: str = MONTH) -> DataFrame:
    """I2 core: (station, pos) rows hit by the kept blocks."""
    return hole_arrays(df, pct, [seed], sizes, station).select(station, F.explode(F.get("_holes", F.lit(0)).cast("array<bigint>")).alias("pos"))


def holes_blocks(df: DataFrame, value: str, pct: float, seed: int = 42, sizes: tuple[int, int] = (1, 5),
                 station: str = STATION, time: str = MONTH, truth: str = "truth") -> DataFrame:
    """Holed copy of the series (``value`` nulled on hit rows, ``truth`` kept, ``hole`` flag)."""
    t = df.withColumn(truth, F.col(value)).join(hole_arrays(df, pct, [seed], sizes, station), station, "left")
    pos = F.row_number().over(Window.partitionBy(station).orderBy(time)) - 1
    t = t.withColumn("hole", F.coalesce(F.array_contains(F.get("_holes", F.lit(0)), pos), F.lit(False)))
    t = t.withColumn(value, F.when(F.col("hole"), F.lit(None)).otherwise(F.col(value))).drop("_holes")
    return _finish(t, value, station, truth)
