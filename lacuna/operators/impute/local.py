"""H5 (PCHIP) and H6 (Akima): local cubic Hermite interpolation, computed with window functions only.

All windows share ``partitionBy(station)`` and run forward by time or backward by row position, so the whole operator
is a few sorts per station partition and no extra shuffle; no frame starts at its own row and ends with the series, for
which Spark would read the rest of the series anew at every row. Known points are addressed through "last known strictly
before" / "first known strictly after" frames with ``ignorenulls``; stacking them once more gives
the second neighbours, which is all the end conditions need.

Conventions (public behaviour of the interpolators the reference calls, on the row position):
  PCHIP  interior slope: weighted harmonic mean of the adjacent secants, 0 at a sign change;
         end slope: 3-point formula, set to 0 if its sign differs from the first secant, clamped to
         3·secant when the two secants differ in sign; 2 known points → linear. Leading rows stay
         null, trailing rows are extrapolated with the last piece.
  Akima  slope from the four surrounding secants (two reflected secants added at each end); equal
         weights when the secant differences vanish (relative 1e-9 of the series maximum);
         2 known points → linear. Leading and trailing rows stay null.
Fewer than 2 known points → the series is returned unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lacuna.operators.series import STATION, MONTH, series_window


def _sign(c: Column) -> Column:
    return F.signum(c)


def _backward(station: str):
    return Window.partitionBy(station).orderBy(F.desc("_pos"))


def _neighbours(df: DataFrame, value: str, w, station: str) -> DataFrame:
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = _backward(station).rowsBetween(Window.unboundedPreceding, -1)
    known = F.col(value).isNotNull()
    df = df.withColumn("_pos", (F.row_number().over(w) - 1).cast("double"))
    k0 = F.when(known, F.struct(F.col("_pos").alias("p"), F.col(value).alias("y")))
    df = df.withColumn("_k0", k0)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # all that looks back comes first, then all that looks forward: a change of direction sorts the series anew
    df = df.withColumn("_a1", F.last("_k0", True).over(before)).withColumn("_m", F.count(value).over(whole))
    df = df.withColumn("_k1", F.when(known, F.struct(F.col("_a1").alias("a"))))
    df = df.withColumn("_a2", F.last("_k1", True).over(before).getField("a"))
    df = df.withColumn("_b1", F.last("_k0", True).over(after))
    df = df.withColumn("_k2", F.when(known, F.struct(F.col("_b1").alias("b"))))
    return df.withColumn("_b2", F.last("_k2", True).over(after).getField("b"))


def _slope(a: str, b: str) -> Column:
    """secant from struct column a to struct column b."""
    return (F.col(f"{b}.y") - F.col(f"{a}.y")) / (F.col(f"{b}.p") - F.col(f"{a}.p"))


def _evaluate(df: DataFrame, value: str, w, out: str, extrapolate_right: bool, station: str) -> DataFrame:
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    frm = _backward(station).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kd = F.when(F.col(value).isNotNull() & F.col("_d").isNotNull(),
                F.struct(F.col("_pos").alias("p"), F.col(value).alias("y"), F.col("_d").alias("d")))
    df = df.withColumn("_kd", kd)
    df = df.withColumn("_R", F.last("_kd", True).over(frm))
    df = df.withColumn("_kdp", F.when(F.col("_kd").isNotNull(),
                                      F.struct(F.col("_kd").alias("cur"), F.last("_kd", True).over(before).alias("prev"))))
    df = df.withColumn("_L", F.last("_kdp", True).over(upto))
    # inner piece: (L.cur, R); trailing piece: (L.prev, L.cur)
    inner = F.col("_R").isNotNull()
    lp = F.when(inner, F.col("_L.cur")).otherwise(F.col("_L.prev"))
    rp = F.when(inner, F.col("_R")).otherwise(F.col("_L.cur"))
    df = df.withColumn("_lp", lp).withColumn("_rp", rp)
    h = F.col("_rp.p") - F.col("_lp.p")
    t = (F.col("_pos") - F.col("_lp.p")) / h
    t2 = t * t
    t3 = t2 * t
    val = ((2 * t3 - 3 * t2 + 1) * F.col("_lp.y") + (t3 - 2 * t2 + t) * h * F.col("_lp.d")
           + (-2 * t3 + 3 * t2) * F.col("_rp.y") + (t3 - t2) * h * F.col("_rp.d"))
    fill = F.when(F.col(value).isNotNull(), F.col(value))
    fill = fill.when(F.col("_m") < 2, F.lit(None))
    fill = fill.when(F.col("_L").isNull(), F.lit(None))          # leading rows
    if not extrapolate_right:
        fill = fill.when(~inner, F.lit(None))
    fill = fill.otherwise(val)
    return df.withColumn(out, fill)


_TMP = ["_pos", "_k0", "_a1", "_b1", "_k1", "_k2", "_a2", "_b2", "_m", "_d", "_kd", "_kdp", "_L", "_R", "_lp", "_rp"]


def impute_pchip(df: DataFrame, value: str, station: str = STATION, time: str = MONTH,
                 out: str | None = None) -> DataFrame:
    out = out or value
    w = series_window(station, time)
    t = _neighbours(df, value, w, station)
    s_prev = _slope("_a1", "_k0")          # δ_{k-1}
    s_next = _slope("_k0", "_b1")          # δ_k
    h_prev = F.col("_k0.p") - F.col("_a1.p")
    h_next = F.col("_b1.p") - F.col("_k0.p")
    w1 = 2 * h_next + h_prev
    w2 = h_next + 2 * h_prev
    zero = (_sign(s_prev) != _sign(s_next)) | (s_prev == 0) | (s_next == 0)
    interior = F.when(zero, F.lit(0.0)).otherwise((w1 + w2) / (w1 / s_prev + w2 / s_next))

    def edge(h0, h1, m0, m1):
        d = ((2 * h0 + h1) * m0 - h0 * m1) / (h0 + h1)
        return (F.when(_sign(d) != _sign(m0), F.lit(0.0))
                .when((_sign(m0) != _sign(m1)) & (F.abs(d) > 3 * F.abs(m0)), 3 * m0)
                .otherwise(d))

    # first point: secants k→k+1, k+1→k+2 ; last point: k-1→k, k-2→k-1
    s_next2 = (F.col("_b2.y") - F.col("_b1.y")) / (F.col("_b2.p") - F.col("_b1.p"))
    h_next2 = F.col("_b2.p") - F.col("_b1.p")
    s_prev2 = (F.col("_a1.y") - F.col("_a2.y")) / (F.col("_a1.p") - F.col("_a2.p"))
    h_prev2 = F.col("_a1.p") - F.col("_a2.p")
    d = (F.when(F.col(value).isNull(), F.lit(None))
         .when(F.col("_m") == 2, F.coalesce(s_next, s_prev))
         .when(F.col("_a1").isNull(), edge(h_next, h_next2, s_next, s_next2))
         .when(F.col("_b1").isNull(), edge(h_prev, h_prev2, s_prev, s_prev2))
         .otherwise(interior))
    t = t.withColumn("_d", d)
    return _evaluate(t, value, w, out, extrapolate_right=True, station=station).drop(*_TMP)


def impute_akima(df: DataFrame, value: str, station: str = STATION, time: str = MONTH,
                 out: str | None = None) -> DataFrame:
    out = out or value
    w = series_window(station, time)
    whole = _backward(station).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # from the end: the first is the last
    t = _neighbours(df, value, w, station)
    # actual secants around point k: m(k-2), m(k-1), m(k), m(k+1)
    m_km1 = _slope("_a1", "_k0")
    m_k = _slope("_k0", "_b1")
    m_km2 = (F.col("_a1.y") - F.col("_a2.y")) / (F.col("_a1.p") - F.col("_a2.p"))
    m_kp1 = (F.col("_b2.y") - F.col("_b1.y")) / (F.col("_b2.p") - F.col("_b1.p"))
    t = (t.withColumn("_mk", F.when(F.col(value).isNotNull(), m_k))
          .withColumn("_mk1", F.when(F.col(value).isNotNull(), m_kp1)))
    # station constants: first two and last two secants
    first_k = F.last(F.when(F.col(value).isNotNull(), F.struct(F.col("_mk").alias("s0"), F.col("_mk1").alias("s1"))), True).over(whole)
    last_k = F.first(F.when(F.col(value).isNotNull(), F.struct(m_km1.alias("s0"), m_km2.alias("s1"))), True).over(whole)
    t = t.withColumn("_fs", first_k).withColumn("_ls", last_k)
    d0, d1 = F.col("_fs.s0"), F.col("_fs.s1")
    e0, e1 = F.col("_ls.s0"), F.col("_ls.s1")          # δ_{n-2}, δ_{n-3}
    left1 = 2 * d0 - d1                                  # reflected secants on the left
    left2 = 2 * left1 - d0
    right1 = 2 * e0 - e1                                 # … and on the right
    right2 = 2 * right1 - e0
    s_a = F.coalesce(m_km2, F.when(F.col("_a1").isNotNull(), left1), left2)          # m(k-2)
    s_b = F.coalesce(m_km1, left1)                                                   # m(k-1)
    s_c = F.coalesce(m_k, right1)                                                    # m(k)
    s_d = F.coalesce(m_kp1, F.when(F.col("_b1").isNotNull(), right1), right2)        # m(k+1)
    t = (t.withColumn("_sa", s_a).withColumn("_sb", s_b).withColumn("_sc", s_c).withColumn("_sd", s_d)
          .withColumn("_f1", F.abs(F.col("_sd") - F.col("_sc")))
          .withColumn("_f2", F.abs(F.col("_sb") - F.col("_sa")))
          .withColumn("_f12", F.col("_f1") + F.col("_f2")))
    t = t.withColumn("_f12max", F.max(F.when(F.col(value).isNotNull(), F.col("_f12"))).over(whole))
    weighted = (F.col("_f1") * F.col("_sb") + F.col("_f2") * F.col("_sc")) / F.col("_f12")
    plain = 0.5 * (F.col("_sd") + F.col("_sa"))
    d = (F.when(F.col(value).isNull(), F.lit(None))
         .when(F.col("_m") == 2, F.coalesce(m_k, m_km1))
         .when(F.col("_f12") > 1e-9 * F.col("_f12max"), weighted)
         .otherwise(plain))
    t = t.withColumn("_d", d)
    extra = ["_mk", "_mk1", "_fs", "_ls", "_sa", "_sb", "_sc", "_sd", "_f1", "_f2", "_f12", "_f12max"]
    return _evaluate(t, value, w, out, extrapolate_right=False, station=station).drop(*(_TMP + extra))
