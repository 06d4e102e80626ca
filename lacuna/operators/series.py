"""Monthly series kit: aggregation to the grid, densification and per-station window operators.

Every window is ``partitionBy(station).orderBy(time)``: one station's series lives in one task.
After the monthly aggregation a series is bounded by the calendar (12 rows per year), so a hot
station in the raw readings cannot produce an unbounded window partition; the raw-to-monthly
step is a hash aggregate with map-side partial combine, which absorbs raw-row skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.functions import calendar as cal

STATION = "station_id"
MONTH = "month"


def series_window(station: str = STATION, time: str = MONTH):
    return Window.partitionBy(station).orderBy(time)


def monthly_mean_by_station(df: DataFrame, station: str = STATION, time: str = "time",
                            value: str = "level", carry: tuple[str, ...] = ("lon", "lat"),
                            out_time: str = MONTH) -> DataFrame:
    """D3: mean of ``value`` per (station, month); ``carry`` columns keep their earliest non-null value."""
    aggs = [F.avg(value).alias(value)]
    for c in carry:
        # earliest non-null reading of the month (ties broken by the value itself for determinism)
        aggs.append(F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(F.col(time), F.col(c)))).alias(c))
    return df.groupBy(station, cal.month_floor(time).alias(out_time)).agg(*aggs)


def densify(df: DataFrame, station: str = STATION, time: str = MONTH,
            carry: tuple[str, ...] = ("lon", "lat"), step: str = "month") -> DataFrame:
    """Add the absent months (or days) between each station's first and last row.

    Measures are null on added rows; ``carry`` columns are filled from the station's first row.
    """
    interval = F.expr(f"INTERVAL 1 {step.upper()}")
    bounds = df.groupBy(station).agg(
        F.min(time).alias("_t0"), F.max(time).alias("_t1"),
        *[F.min_by(F.col(c), F.col(time)).alias(f"_ref_{c}") for c in carry])
    grid = bounds.select(station, F.explode(F.sequence("_t0", "_t1", interval)).alias(time),
                         *[f"_ref_{c}" for c in carry])
    out = grid.join(df, [station, time], "left")
    cols = [station, time]
    for c in df.columns:
        if c in (station, time):
            continue
        if c in carry:
            cols.append(F.coalesce(F.col(c), F.col(f"_ref_{c}")).alias(c))
        else:
            cols.append(F.col(c))
    return out.select(*cols)


def with_position(df: DataFrame, station: str = STATION, time: str = MONTH, pos: str = "pos") -> DataFrame:
    """Row position 0,1,2… inside each station (positional methods use it, not the calendar)."""
    return df.withColumn(pos, F.row_number().over(series_window(station, time)) - 1)


def series_diff(df: DataFrame, value: str, station: str = STATION, time: str = MONTH,
                out: str = "diff") -> DataFrame:
    """First difference of the non-null values (gaps closed first); first row of each series dropped."""
    w = series_window(station, time)
    k = df.filter(F.col(value).isNotNull())
    return (k.withColumn(out, F.col(value) - F.lag(value, 1).over(w))
            .filter(F.col(out).isNotNull()))


def rate_per_day(df: DataFrame, value: str, station: str = STATION, time: str = MONTH) -> DataFrame:
    """Elapsed days, change and change per day between consecutive rows."""
    w = series_window(station, time)
    d = F.datediff(F.col(time), F.lag(time, 1).over(w)).cast("double")
    dv = F.col(value) - F.lag(value, 1).over(w)
    return (df.withColumn("days_diff", d).withColumn("delta", dv)
            .withColumn("delta_per_day", F.try_divide(F.col("delta"), F.col("days_diff"))))


def variation_transform(df: DataFrame, cols: list[str], station: str = STATION, time: str = MONTH) -> DataFrame:
    """Previous − current for each column; first row and nulls → 0."""
    w = series_window(station, time)
    for c in cols:
        df = df.withColumn(c, F.coalesce(F.lag(c, 1).over(w) - F.col(c), F.lit(0.0)))
    return df


def ffill_bfill(df: DataFrame, value: str, station: str = STATION, time: str = MONTH,
                out: str | None = None) -> DataFrame:
    """Forward fill, then backward fill what is still null (leading gap)."""
    w = series_window(station, time)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fwd = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    f = F.last(value, ignorenulls=True).over(back)
    b = F.first(value, ignorenulls=True).over(fwd)
    return df.withColumn(out or value, F.coalesce(f, b))


def longest_streak(df: DataFrame, value: str, station: str = STATION, time: str = MONTH) -> DataFrame:
    """E5: longest run of calendar-consecutive months among rows with a non-null value.

    Gaps-and-islands: month_index − dense_rank is constant inside a run.
    """
    k = df.filter(F.col(value).isNotNull()).select(station, cal.month_index(time).alias("_mi")).distinct()
    w = Window.partitionBy(station).orderBy("_mi")
    isl = k.withColumn("_island", F.col("_mi") - F.row_number().over(w))
    runs = isl.groupBy(station, "_island").agg(F.count(F.lit(1)).alias("_len"))
    return runs.groupBy(station).agg(F.max("_len").alias("longest_streak"))


def segments_and_gaps(df: DataFrame, value: str, station: str = STATION, time: str = MONTH) -> DataFrame:
    """Maximal runs of consecutive non-null rows (start, end, n) and the gap to the next run.

    Island id = running count of null rows; ``gap_rows`` = rows between this run and the next.
    """
    w = series_window(station, time)
    t = (df.withColumn("_rn", F.row_number().over(w))
         .withColumn("_isl", F.sum(F.when(F.col(value).isNull(), 1).otherwise(0))
                     .over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    seg = (t.filter(F.col(value).isNotNull())
           .groupBy(station, "_isl")
           .agg(F.min(time).alias("seg_start"), F.max(time).alias("seg_end"),
                F.count(F.lit(1)).alias("n_rows"), F.min("_rn").alias("_r0"), F.max("_rn").alias("_r1")))
    ws = Window.partitionBy(station).orderBy("seg_start")
    seg = (seg.withColumn("segment", F.row_number().over(ws))
           .withColumn("next_start", F.lead("seg_start", 1).over(ws))
           .withColumn("gap_rows", F.lead("_r0", 1).over(ws) - F.col("_r1") - 1))
    return seg.select(station, "segment", "seg_start", "seg_end", "n_rows", "next_start", "gap_rows")


def series_shift(df: DataFrame, value: str, lag: int | str, station: str = STATION,
                 pos: str = "pos", out: str = "shifted") -> DataFrame:
    """Value moved ``lag`` rows later (shifted[p] = x[p − lag]); ``lag`` may be a column.

    A per-row lag cannot use ``F.lag`` (constant offset), so it is an equi-join on position.
    """
    lag_col = F.col(lag) if isinstance(lag, str) else F.lit(lag)
    src = df.select(F.col(station).alias("_s"), F.col(pos).alias("_p"), F.col(value).alias(out))
    keyed = df.withColumn("_src_pos", F.col(pos) - lag_col)
    j = keyed.join(src, (keyed[station] == src["_s"]) & (keyed["_src_pos"] == src["_p"]), "left")
    return j.drop("_s", "_p", "_src_pos")


def cumulative_reconstruct(df: DataFrame, level: str, delta: str, station: str = STATION,
                           time: str = MONTH, sign: int = 1, out: str = "rebuilt") -> DataFrame:
    """Start from the first row's level, then prev + sign·delta (null delta counts as 0)."""
    w = series_window(station, time)
    run = F.sum(F.coalesce(F.col(delta), F.lit(0.0))).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    first_delta = F.first(F.coalesce(F.col(delta), F.lit(0.0))).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    start = F.first(level).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out, start + F.lit(float(sign)) * (run - first_delta))


def time_split(df: DataFrame, frac: float = 0.8, station: str = STATION, time: str = MONTH,
               out: str = "split", parts: int = 64) -> DataFrame:
    """The first int(frac·n) rows of the table ordered by (station, time) are 'train', the rest 'val'.

    No global row_number and no single-task window: rows per station are counted (one row per
    station), range-partitioned by station, summed per range partition (``parts`` rows), those few
    totals are prefix-summed, and each station's offset is its partition offset plus a prefix inside
    its own partition; a row's global position is offset + local position.
    """
    from lacuna.session import cut_lineage
    counts = cut_lineage(df.groupBy(station).agg(F.count(F.lit(1)).alias("_n"))  # sampled ranges are drawn once
                         .repartitionByRange(parts, station).withColumn("_pid", F.spark_partition_id()))
    per_part = counts.groupBy("_pid").agg(F.sum("_n").alias("_pn"))
    wp = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)      # ≤ parts rows
    part_off = per_part.select("_pid", F.coalesce(F.sum("_pn").over(wp), F.lit(0)).alias("_poff"))
    total = per_part.select(F.sum("_pn")).scalar()
    wl = Window.partitionBy("_pid").orderBy(station).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("_loff", F.coalesce(F.sum("_n").over(wl), F.lit(0)))
               .join(part_off, "_pid")
               .select(station, (F.col("_poff") + F.col("_loff")).alias("_off")))
    w = series_window(station, time)
    t = df.join(offsets, station).withColumn("_g", F.col("_off") + F.row_number().over(w) - 1)
    cut = F.floor(total * F.lit(frac))
    return t.withColumn(out, F.when(F.col("_g") < cut, "train").otherwise("val")).drop("_off", "_g")
