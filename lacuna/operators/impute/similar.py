"""H9a–H9d, C9, C10, C11, E7, F2: imputation from spectrally similar series.

  signature     series forward- then backward-filled, mean removed, |DFT| at bins 1..10
                (a join-free DFT: rows × 10 bins, summed per station and bin).
                As a *target* a station uses its own grid; as a *reference* it uses the union of
                all months of its class (the reference pivots all other series on one time index).
  similarity    Pearson correlation of bins 1..L−1, L = min(N_target, N_union, 11); 0 when L ≤ 2;
                undefined (constant vector) sorts last. Because L depends on the target only, the
                correlation is a Euclidean distance between z-normalised prefixes, and the top-n
                search is exact over cells of pivots (triangle inequality) in vectorised blocks;
                a pair of stations is never a row unless it is among the n best of a block.
  best lag      lag in −24..24 maximising the correlation of forward-filled target and reference
                (pairs pos_x = pos_y + lag, ≥5 pairs, both std ≠ 0, ties → smallest lag, default 0).
  completion    reference shifted by its lag on the target grid; a gap row takes
                x_last + (s_i − s_last) when the reference is non-null from the last known target row
                to the row (a null reference row breaks the chain); with no common row,
                s − mean(s) + mean(target); the references are averaged (nulls skipped).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lacuna.operators.neighbours import cell_topk
from lacuna.operators.series import STATION, MONTH

N_FREQ = 10
MAX_LAG = 24
MIN_PAIRS = 5


def _ffill(col, w):
    return F.last(col, True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _bfill(col, back):
    """``back``: the series from its end; a frame up to the end would be read anew at every row."""
    return F.last(col, True).over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def spectrum(series: DataFrame, value: str, key: list[str], time: str = MONTH) -> DataFrame:
    """(key…, n, bin, amp) for bins 1..10 (null for bins ≥ n)."""
    w = Window.partitionBy(*key).orderBy(time)
    t = series.withColumn("_x", F.coalesce(_ffill(F.col(value), w), _bfill(F.col(value), Window.partitionBy(*key).orderBy(F.desc(time)))))
    t = t.withColumn("_i", F.row_number().over(w) - 1)
    whole = Window.partitionBy(*key)
    t = t.withColumn("_n", F.count(F.lit(1)).over(whole)).withColumn("_xc", F.col("_x") - F.avg("_x").over(whole))
    t = t.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(N_FREQ))))
    ang = F.lit(2 * math.pi) * F.col("bin") * F.col("_i") / F.col("_n")
    g = t.groupBy(*key, "bin").agg(F.first("_n").alias("n"), F.sum(F.col("_xc") * F.cos(ang)).alias("_re"),
                                   F.sum(F.col("_xc") * F.sin(ang)).alias("_im"))
    amp = F.when(F.col("bin") < F.col("n"), F.sqrt(F.col("_re") * F.col("_re") + F.col("_im") * F.col("_im")))
    return g.select(*key, "n", "bin", amp.alias("amp"))


def union_grid(df: DataFrame, part: str, station: str = STATION, time: str = MONTH) -> DataFrame:
    """Every station on the union of all months that its class has (reference signatures)."""
    months = df.groupBy(part).agg(F.collect_set(time).alias("_months"))  # bounded by the calendar
    grid = df.select(part, station).distinct().join(months, part).select(part, station, F.explode("_months").alias(time))
    return grid.join(df, [part, station, time], "left")


def _z_prefix(sig: DataFrame, key: list[str], length_col: str) -> DataFrame:
    """Array of the first L−1 amplitudes, z-normalised (population std); null if constant."""
    arr = sig.groupBy(*key).agg(F.first("n").alias("n"),
                                F.sort_array(F.collect_list(F.struct("bin", "amp"))).alias("_a"))
    arr = arr.withColumn("_v", F.transform("_a", lambda s: s["amp"]))
    return arr.drop("_a")


def _zvec_dyn(df: DataFrame, vcol: str, m_col) -> DataFrame:
    """z-normalised first m amplitudes (m a column; population std; null if constant or short)."""
    v = F.slice(F.col(vcol), F.lit(1), m_col)
    t = df.withColumn("_m", m_col).withColumn("_pv", v)
    t = t.withColumn("_mu", F.aggregate("_pv", F.lit(0.0), lambda a, x: a + x) / F.col("_m"))
    var = F.aggregate(F.transform("_pv", lambda x: (x - F.col("_mu")) * (x - F.col("_mu"))), F.lit(0.0),
                      lambda a, x: a + x) / F.col("_m")
    t = t.withColumn("_sd", F.sqrt(var))
    ok = (F.size("_pv") == F.col("_m")) & ~F.exists("_pv", lambda x: x.isNull()) & (F.col("_sd") > 1e-9 * F.abs("_mu"))
    t = t.withColumn("_z", F.when(ok, F.transform("_pv", lambda x: (x - F.col("_mu")) / F.col("_sd"))))
    return t.drop("_pv", "_mu", "_sd")


def similarity_topn(df: DataFrame, value: str, n_top: int = 10, station: str = STATION,
                    time: str = MONTH, cluster: str | None = "cluster") -> DataFrame:
    """H9b + F2 (+C9 scope): (station, other, sim, rank) for the n most similar others in the cluster."""
    from lacuna.session import cut_lineage
    part_col = cluster if cluster and cluster in df.columns else None
    base = df if part_col else df.withColumn("_part", F.lit(""))
    part = part_col or "_part"
    tgt = spectrum(base, value, [part, station], time)
    ref = spectrum(union_grid(base.select(part, station, time, value), part, station, time), value, [part, station], time)
    tv = _z_prefix(tgt, [part, station], "n").withColumnRenamed("n", "_nt").withColumnRenamed("_v", "_tv")
    rv = _z_prefix(ref, [part, station], "n").withColumnRenamed("n", "_nr").withColumnRenamed("_v", "_rv")
    n_union = rv.groupBy(F.col(part).alias("_up")).agg(F.max("_nr").alias("_nu"))
    tv = tv.join(n_union, F.col(part) == F.col("_up")).withColumn("_L", F.least(F.col("_nt"), F.col("_nu"), F.lit(N_FREQ + 1)).cast("int")).drop("_nu", "_up")
    # one query row per target at its own L; one item row per reference and L in 3..11 that a target has (few but the last, mostly)
    q = cut_lineage(_zvec_dyn(tv, "_tv", F.greatest(F.col("_L") - 1, F.lit(1)))
                    .select(part, "_L", F.col(station).alias("q_id"), F.col("_z").alias("q_z")))
    qd = q.filter((F.col("_L") >= 3) & F.col("q_z").isNotNull())
    asked = sorted(r._L for r in qd.select("_L").distinct().collect())  # at most 9 numbers
    items = rv.withColumn("_L", F.explode(F.array(*[F.lit(n) for n in sorted({*asked, N_FREQ + 1})])))  # all ids are at the last one
    it = cut_lineage(_zvec_dyn(items, "_rv", F.col("_L") - 1)
                     .select(part, "_L", F.col(station).alias("i_id"), F.col("_z").alias("i_z")))
    top = cell_topk(qd, it.filter(F.col("i_z").isNotNull() & F.col("_L").isin(asked)), [part, "_L"], n_top, correlate=True)
    top = cut_lineage(top.select(part, "_L", F.col("q_id").alias(station), F.col("i_id").alias("other"), "sim", "rank"))  # the search is run once
    # partners with an undefined correlation (constant prefix) sort last, by id: at most n of them
    # are needed, taken from the n+1 smallest undefined ids of the partition
    undefined = it.filter(F.col("i_z").isNull()).select(part, "_L", F.col("i_id").alias("other"))
    undefined = (undefined.withColumn("_r", F.row_number().over(Window.partitionBy(part, "_L").orderBy("other")))
                 .filter(F.col("_r") <= n_top + 1))
    have = top.groupBy(part, "_L", station).agg(F.count(F.lit(1)).alias("_k"))
    short = (qd.select(part, "_L", F.col("q_id").alias(station)).join(have, [part, "_L", station], "left")
             .withColumn("_k", F.coalesce("_k", F.lit(0))).filter(F.col("_k") < n_top))
    extra = (short.join(undefined, [part, "_L"]).filter(F.col("other") != F.col(station))
             .withColumn("rank", F.col("_k") + F.row_number().over(Window.partitionBy(part, station).orderBy("other")))
             .filter(F.col("rank") <= n_top)
             .select(part, "_L", station, "other", F.lit(None).cast("double").alias("sim"), "rank"))
    # L <= 2 (similarity 0 with everyone) or constant target (undefined with everyone): n smallest ids
    flat = q.filter((F.col("_L") <= 2) | F.col("q_z").isNull()).select(part, "_L", F.col("q_id").alias(station))
    ids = it.filter(F.col("_L") == N_FREQ + 1).select(part, F.col("i_id").alias("other"))
    cand = ids.withColumn("_r", F.row_number().over(Window.partitionBy(part).orderBy("other"))).filter(F.col("_r") <= n_top + 1)
    fl = (flat.join(cand, part).filter(F.col("other") != F.col(station))
          .withColumn("sim", F.when(F.col("_L") <= 2, F.lit(0.0)))
          .withColumn("rank", F.row_number().over(Window.partitionBy(part, station).orderBy("other")))
          .filter(F.col("rank") <= n_top).select(part, "_L", station, "other", "sim", "rank"))
    out = top.unionByName(extra).unionByName(fl).drop("_L")
    if not part_col:
        out = out.drop("_part")
    return out


def lags_of(x: np.ndarray, y: np.ndarray, max_lag: int = MAX_LAG) -> np.ndarray:
    """Correlation of two series on one grid (NaN = missing) at the lags −max_lag … max_lag: pairs are x[i], y[i − lag]
    with both known. NaN where a lag has fewer than MIN_PAIRS pairs or a std of 0.

    The counts, sums, squares and products of all lags are six cross-correlations of the two arrays."""
    kx, ky = ~np.isnan(x), ~np.isnan(y)
    a = np.where(kx, x - (x[kx].mean() if kx.any() else 0.0), 0.0)
    b = np.where(ky, y - (y[ky].mean() if ky.any() else 0.0), 0.0)
    mx, my = kx.astype(np.float64), ky.astype(np.float64)
    n, sx, sy, sxx, syy, sxy = (np.correlate(u, v, "full") for u, v in ((mx, my), (a, my), (mx, b), (a * a, my), (mx, b * b), (a, b)))
    n = np.rint(n)
    with np.errstate(all="ignore"):
        vx, vy = sxx - sx * sx / n, syy - sy * sy / n
        found = (sxy - sx * sy / n) / np.sqrt(vx * vy)
    # sums of squares about the mean below this are rounding: the series is constant there
    small = lambda m: 1e-12 * max(float(np.max(np.abs(m), initial=0.0)) ** 2, 1e-300) * np.maximum(n, 1)
    found[(n < MIN_PAIRS) | (vx <= small(a)) | (vy <= small(b))] = np.nan
    out, zero = np.full(2 * max_lag + 1, np.nan), len(y) - 1  # where lag 0 stands
    for lag in range(-min(max_lag, zero), min(max_lag, len(x) - 1) + 1):
        out[lag + max_lag] = found[zero + lag]
    return out


def lag_of(x: np.ndarray, y: np.ndarray, max_lag: int = MAX_LAG) -> int:
    """The lag of the largest correlation (9 digits) above −1, ties to the smallest; no such lag → 0."""
    c = np.round(lags_of(x, y, max_lag), 9)
    ok = c > -1.0
    return int(np.flatnonzero(c == c[ok].max())[0]) - max_lag if ok.any() else 0


def best_lag(pairs_series: DataFrame, pair_key: list[str], x: str = "x", y: str = "y", pos: str = "pos",
             max_lag: int = MAX_LAG) -> DataFrame:
    """(pair_key…, lag). The two forward-filled series of a pair (one target grid, bounded by
    the calendar) are gathered as arrays; Arrow batches of pairs are searched for all lags of a pair at once."""
    g = pairs_series.groupBy(*pair_key).agg(
        F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")))).alias("_s"))
    g = g.select(*pair_key, F.col("_s.x").alias("_x"), F.col("_s.y").alias("_y"))
    kinds = ", ".join(f"`{c}` {g.schema[c].dataType.simpleString()}" for c in pair_key)

    def search(batches):
        for b in batches:
            lags = [lag_of(u.values.to_numpy(zero_copy_only=False), v.values.to_numpy(zero_copy_only=False), max_lag) for u, v in zip(b.column("_x"), b.column("_y"))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in pair_key), pa.array(lags, pa.int32())], [*pair_key, "lag"])

    return g.mapInArrow(search, f"{kinds}, lag int")


def similar_pairs(df: DataFrame, top: DataFrame, value: str, station: str = STATION, time: str = MONTH) -> DataFrame:
    """One row a station that has similar ones, with its own series (arrays ``_t``, ``_x`` in time order) and, in ``_o``,
    those of its similar ones (other, t, y; no t where the other has no rows). A series is bounded by the calendar and a
    station has a few similar ones, so a row is bounded too, and no month of a pair is a row."""
    row = F.struct(F.col(time).alias("t"), F.col(value).cast("double").alias("v"))
    series = df.groupBy(station).agg(F.sort_array(F.collect_list(row)).alias("_s"))
    dated = F.filter("_s", lambda r: r["t"].isNotNull())  # a row without a time is on no grid
    own = series.filter(F.col(station).isNotNull()).select(station, F.col("_s.t").alias("_t"), F.col("_s.v").alias("_x"))
    others = series.select(F.col(station).alias("other"), F.transform(dated, lambda r: r["t"]).alias("t"), F.transform(dated, lambda r: r["v"]).alias("y"))
    found = top.select(station, "other", "rank").join(others, "other", "left")
    found = found.groupBy(station).agg(F.sort_array(F.collect_list(F.struct("rank", "other", "t", "y"))).alias("_o"))
    return found.join(own, station)


def _numbers(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The entries of an array and which of them are there."""
    return a.to_numpy(zero_copy_only=False).astype(np.float64), a.is_valid().to_numpy(zero_copy_only=False)


def _matches(asked: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A left join with the sorted ``items``: places of the asked entries, repeated for each match, and of the match (-1: none)."""
    lo, hi = np.searchsorted(items, asked, "left"), np.searchsorted(items, asked, "right")
    n = np.maximum(hi - lo, 1)
    i = np.repeat(np.arange(len(asked)), n)
    return i, np.where(hi > lo, lo, -1)[i] + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)  # one place only where there is none


def _taken(v: np.ndarray, known: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries at the places ``at`` and which of them are known; nothing is at -1."""
    if not len(v):
        return np.full(len(at), np.nan), np.zeros(len(at), bool)
    return np.where(at >= 0, v[at], np.nan), (at >= 0) & known[at]


def _carried(v: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Forward-filled, NaN before the first known entry."""
    last = np.maximum.accumulate(np.where(known, np.arange(len(v)), -1))
    return np.where(last >= 0, v[last], np.nan)


def _each(own: pa.Array, values: pa.Array, others: pa.StructArray):
    """(pos, x, x known, y, y known, lag) of a station with each of its similar ones, on the station's grid."""
    grid = own.to_numpy(zero_copy_only=False)
    x, kx = _numbers(values)
    for t, y in zip(others.field("t"), others.field("y")):
        if t.is_valid:
            pos, at = _matches(grid, t.values.to_numpy(zero_copy_only=False))
            yv, ky = _taken(*_numbers(y.values), at)
        else:
            pos, yv, ky = np.arange(len(grid)), np.full(len(grid), np.nan), np.zeros(len(grid), bool)
        yield pos, x[pos], kx[pos], yv, ky, lag_of(_carried(x[pos], kx[pos]), _carried(yv, ky))


def completed(pos: np.ndarray, x: np.ndarray, kx: np.ndarray, y: np.ndarray, ky: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """H9d for one reference: (pos, adjusted value, whether there is one). The reference moves ``lag`` rows later."""
    i, j = _matches(pos - lag, pos)
    pos, x, kx = pos[i], x[i], kx[i]
    s, ks = _taken(y, ky, j)
    if (kx & ks).any():
        gone = np.cumsum(~ks)
        last = np.maximum.accumulate(np.where(kx, np.arange(len(x)), -1))
        ok = ks & (last >= 0) & ks[last] & (gone == gone[last])
        adj = x[last] + s - s[last]
    else:
        ok = ks & bool(kx.any())
        adj = s - (s[ks].mean() if ks.any() else 0.0) + (x[kx].mean() if kx.any() else 0.0)
    return pos, np.where(kx, x, adj), kx | ok


def similar_lags(df: DataFrame, value: str, station: str = STATION, time: str = MONTH, n_top: int = 10,
                 cluster: str | None = "cluster") -> tuple[DataFrame, DataFrame]:
    """The series of each station and its ``n_top`` similar ones on the station's grid (station, other, pos, x, y_raw),
    and (station, other, lag)."""
    top = similarity_topn(df, value, n_top, station, time, cluster)
    w = Window.partitionBy(station).orderBy(time)
    tgt = df.select(station, time, F.col(value).alias("x")).withColumn("pos", F.row_number().over(w) - 1)
    oth = df.select(F.col(station).alias("other"), time, F.col(value).alias("y_raw"))
    pairs = top.select(station, "other").join(tgt, station).join(oth, ["other", time], "left")
    wp = Window.partitionBy(station, "other").orderBy("pos")
    pairs = pairs.withColumn("xf", _ffill(F.col("x"), wp)).withColumn("yf", _ffill(F.col("y_raw"), wp))
    kind = df.schema[station].dataType.simpleString()

    def search(batches):
        for b in batches:
            if not b.num_rows:
                continue
            lags = [[found[-1] for found in _each(t.values, x.values, o.values)] for t, x, o in zip(b.column("_t"), b.column("_x"), b.column("_o"))]
            others = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([len(found) for found in lags])], pa.int32()),
                                              pa.concat_arrays([o.values.field("other") for o in b.column("_o")]))
            yield pa.RecordBatch.from_arrays([b.column(station), others, pa.array(lags, pa.list_(pa.int32()))], [station, "other", "lag"])

    found = similar_pairs(df, top, value, station, time).mapInArrow(search, f"`{station}` {kind}, other array<{kind}>, lag array<int>")
    return pairs, found.select(station, F.inline(F.arrays_zip("other", "lag")))


def impute_similar_series(df: DataFrame, value: str, station: str = STATION, time: str = MONTH,
                          out: str | None = None, n_top: int = 10, cluster: str | None = "cluster") -> DataFrame:
    """H9d. A station with all its similar ones is the unit of work: lags, shifts and chains are array operations of one task."""
    out = out or value
    from lacuna.session import cut_lineage
    part_col = cluster if cluster and cluster in df.columns else None
    df = cut_lineage(df)  # read by every step below
    top = similarity_topn(df, value, n_top, station, time, part_col)
    kind, when = (df.schema[c].dataType.simpleString() for c in (station, time))

    def run(batches):
        for b in batches:
            found = []
            for t, x, o in zip(b.column("_t"), b.column("_x"), b.column("_o")):
                total, hits = np.zeros(len(t.values)), np.zeros(len(t.values))
                for pair in _each(t.values, x.values, o.values):
                    pos, adj, ok = completed(*pair)
                    total += np.bincount(pos[ok], adj[ok], len(total))
                    hits += np.bincount(pos[ok], minlength=len(hits))
                found.append(pa.array(total / np.where(hits > 0, hits, 1), mask=hits == 0))
            if found:
                ends = pa.array(np.r_[0, np.cumsum([len(f) for f in found])], pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(station), b.column("_t"), pa.ListArray.from_arrays(ends, pa.concat_arrays(found))], [station, "_t", "_rec"])

    rec = similar_pairs(df, top, value, station, time).mapInArrow(run, f"`{station}` {kind}, _t array<{when}>, _rec array<double>")
    res = rec.select(station, F.inline(F.arrays_zip("_t", "_rec"))).select(station, F.col("_t").alias(time), "_rec")
    keep = [c for c in df.columns if c != out]
    return (df.join(res, [station, time], "left")
            .withColumn(out, F.coalesce(F.col(value), F.col("_rec"))).select(*keep, out))
