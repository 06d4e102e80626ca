"""DuckDB oracle SQL for each catalog key, written from the semantics (not from the Spark code).

Common table expressions re-derive the domain tables from the driver tables with the same fixed
rules as ``lacuna.sources.driver_tables``.
"""

from __future__ import annotations

SQL: dict[str, str] = {}

READINGS = """
r AS (
  SELECT l_suppkey AS station_id, CAST(l_shipdate AS DATE) AS time, CASE WHEN l_returnflag = 'R' THEN l_quantity END AS level,
         CAST(41 + (l_suppkey * 37 % 1000) / 100.0 AS DOUBLE) AS lat,
         CAST(-5 + (l_suppkey * 91 % 1400) / 100.0 AS DOUBLE) AS lon
  FROM lineitem)"""

MONTHLY = READINGS + """,
m AS (
  SELECT station_id, CAST(date_trunc('month', time) AS DATE) AS month, avg(level) AS level,
         arg_min(lon, time) FILTER (WHERE lon IS NOT NULL) AS lon,
         arg_min(lat, time) FILTER (WHERE lat IS NOT NULL) AS lat
  FROM r GROUP BY 1, 2)"""

DENSE = MONTHLY + """,
b AS (SELECT station_id, min(month) AS t0, max(month) AS t1,
             arg_min(lon, month) AS lon0, arg_min(lat, month) AS lat0 FROM m GROUP BY 1),
g AS (SELECT station_id, CAST(unnest(generate_series(t0, t1, INTERVAL 1 MONTH)) AS DATE) AS month, lon0, lat0 FROM b),
f AS (SELECT g.station_id, g.month, m.level, coalesce(m.lon, g.lon0) AS lon, coalesce(m.lat, g.lat0) AS lat
      FROM g LEFT JOIN m ON g.station_id = m.station_id AND g.month = m.month)"""

# f = dense monthly grid (station_id, month, level, lon, lat); fp adds pos
DENSE_POS = DENSE + """,
fp AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY month) - 1 AS pos FROM f)"""


def with_(ctes: str, body: str) -> str:
    return "WITH " + ctes + "\n" + body


SQL["monthly_mean_by_station"] = with_(MONTHLY, """
SELECT station_id, month, round(level, 6) AS level, round(lon, 6) AS lon, round(lat, 6) AS lat FROM m""")

SQL["densify_series"] = with_(DENSE, """
SELECT station_id, month, round(level, 6) AS level, round(lon, 6) AS lon, round(lat, 6) AS lat FROM f""")

SQL["impute_linear"] = with_(DENSE_POS + """,
nb AS (
  SELECT station_id, month, level, pos,
    (SELECT max(k.pos) FROM fp k WHERE k.station_id = fp.station_id AND k.pos <= fp.pos AND k.level IS NOT NULL) AS p0,
    (SELECT min(k.pos) FROM fp k WHERE k.station_id = fp.station_id AND k.pos >= fp.pos AND k.level IS NOT NULL) AS p1
  FROM fp),
v AS (
  SELECT nb.*, a.level AS x0, c.level AS x1 FROM nb
  LEFT JOIN fp a ON a.station_id = nb.station_id AND a.pos = nb.p0
  LEFT JOIN fp c ON c.station_id = nb.station_id AND c.pos = nb.p1)""", """
SELECT station_id, month, round(level, 6) AS level,
  round(CASE WHEN level IS NOT NULL THEN level
             WHEN p0 IS NULL THEN x1
             WHEN p1 IS NULL THEN x0
             ELSE x0 + (x1 - x0) * (pos - p0) / (p1 - p0) END, 6) AS filled
FROM v""")

PET_DAILY = """
pd_ AS (
  SELECT CAST(41 + (c.c_nationkey * 53 % 1000) / 100.0 AS DOUBLE) AS lat,
         CAST(-5 + (c.c_nationkey * 71 % 1400) / 100.0 AS DOUBLE) AS lon,
         CAST(o.o_orderdate AS DATE) AS time,
         CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE o.o_totalprice / 100000.0 END AS pet
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
petm AS (SELECT lat, lon, CAST(date_trunc('month', time) AS DATE) AS month, coalesce(sum(pet), 0.0) AS pet
         FROM pd_ GROUP BY 1, 2, 3)"""

POINTS = """
pt0 AS (
  SELECT c.c_nationkey AS nk, CAST(date_trunc('month', o.o_orderdate) AS DATE) AS month,
         avg(o.o_totalprice) AS rain_v, CAST(count(*) AS DOUBLE) AS temp_v
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2),
pt AS (
  SELECT CAST(41 + (nk * 53 % 1000) / 100.0 AS DOUBLE) AS lat, CAST(-5 + (nk * 71 % 1400) / 100.0 AS DOUBLE) AS lon, month,
         CASE WHEN (nk + month(month)) % 4 = 0 THEN NULL ELSE rain_v END AS rain,
         CASE WHEN (nk + month(month)) % 3 = 0 THEN NULL ELSE temp_v END AS temp
  FROM pt0)"""

SQL["monthly_sum_by_point"] = with_(PET_DAILY, "SELECT lat, lon, month, round(pet, 6) AS pet FROM petm")
SQL["monthly_mean_by_point"] = with_(PET_DAILY, """
SELECT lat, lon, CAST(date_trunc('month', time) AS DATE) AS month, round(avg(pet), 6) AS pet FROM pd_ GROUP BY 1, 2, 3""")

FUSED = DENSE + "," + PET_DAILY + "," + POINTS + """,
pl AS (SELECT lat AS plat, lon AS plon, month, 'pet' AS variable, pet AS value FROM petm WHERE pet IS NOT NULL
       UNION ALL SELECT lat, lon, month, 'rain', rain FROM pt WHERE rain IS NOT NULL
       UNION ALL SELECT lat, lon, month, 'temp', temp FROM pt WHERE temp IS NOT NULL),
tc AS (SELECT DISTINCT lat, lon, month FROM f),
cand AS (
  SELECT tc.lat, tc.lon, tc.month, pl.variable, pl.value,
         row_number() OVER (PARTITION BY tc.lat, tc.lon, tc.month, pl.variable
                            ORDER BY (tc.lat - pl.plat) * (tc.lat - pl.plat) + (tc.lon - pl.plon) * (tc.lon - pl.plon), pl.plat, pl.plon) AS rn
  FROM tc JOIN pl ON tc.month = pl.month),
best AS (
  SELECT lat, lon, month,
         max(value) FILTER (WHERE variable = 'pet') AS pet,
         max(value) FILTER (WHERE variable = 'rain') AS rain,
         max(value) FILTER (WHERE variable = 'temp') AS temp
  FROM cand WHERE rn = 1 GROUP BY 1, 2, 3),
fz AS (SELECT f.*, best.pet, best.rain, best.temp FROM f LEFT JOIN best
       ON f.lat = best.lat AND f.lon = best.lon AND f.month = best.month)"""

SQL["nearest_valid_join"] = with_(FUSED, """
SELECT station_id, month, round(level, 6) AS level, round(lon, 6) AS lon, round(lat, 6) AS lat,
       round(pet, 6) AS pet, round(rain, 6) AS rain, round(temp, 6) AS temp FROM fz""")

SOIL = """
soil AS (
  SELECT CAST(41 + (n_nationkey * 53 % 1000) / 100.0 AS DOUBLE) AS lat,
         CAST(-5 + (n_nationkey * 71 % 1400) / 100.0 AS DOUBLE) AS lon, y.year,
         CAST(n_nationkey * 10 + y.year - 2019 AS DOUBLE) AS sealed_area,
         CAST(n_nationkey + 1000 AS DOUBLE) AS total_area
  FROM nation CROSS JOIN (VALUES (2020), (2023)) AS y(year))"""

SQL["nearest_reference_year_join"] = with_(DENSE + "," + SOIL + """,
t AS (SELECT station_id, CAST(month + INTERVAL 288 MONTH AS DATE) AS month, lat, lon FROM f),
t2 AS (SELECT *, CASE WHEN year(month) < 2023 THEN 2020 ELSE 2023 END AS ry FROM t),
c AS (SELECT t2.station_id, t2.month, s.sealed_area, s.total_area,
             row_number() OVER (PARTITION BY t2.station_id, t2.month
               ORDER BY (t2.lat - s.lat) * (t2.lat - s.lat) + (t2.lon - s.lon) * (t2.lon - s.lon), s.lat, s.lon) AS rn
      FROM t2 LEFT JOIN soil s ON s.year = t2.ry AND s.sealed_area IS NOT NULL)""", """
SELECT station_id, month, round(sealed_area, 6) AS sealed_area, round(total_area, 6) AS total_area FROM c WHERE rn = 1""")

CLUSTERED = DENSE + """,
dd AS (SELECT station_id, level - lag(level) OVER (PARTITION BY station_id ORDER BY month) AS d
       FROM f WHERE level IS NOT NULL),
fi AS (SELECT s.station_id, avg(abs(d)) + stddev_samp(d) AS fluctuation_index
       FROM (SELECT DISTINCT station_id FROM f) s LEFT JOIN dd ON dd.station_id = s.station_id GROUP BY 1),
cl AS (SELECT f.*, CASE WHEN fi.fluctuation_index > 0.4 THEN 'reactive' ELSE 'inertial' END AS cluster
       FROM f LEFT JOIN fi ON f.station_id = fi.station_id)"""

SPARSE = """
sp AS (SELECT o_custkey AS station_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
              avg(o_totalprice) AS level FROM orders GROUP BY 1, 2)"""

SQL["availability_by_month"] = with_(POINTS, "SELECT month, count(rain) AS n_rain, count(temp) AS n_temp FROM pt GROUP BY 1")

SQL["calendar_left_join"] = with_(READINGS + """,
cnt AS (SELECT CAST(date_trunc('month', time) AS DATE) AS month, count(level) AS n FROM r GROUP BY 1),
calm AS (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM cnt)""", """
SELECT calm.month, coalesce(cnt.n, 0) AS n_level FROM calm LEFT JOIN cnt ON calm.month = cnt.month""")

SQL["missing_months_by_year"] = with_(POINTS + """,
cnt AS (SELECT month, count(rain) AS nr, count(temp) AS nt FROM pt GROUP BY 1),
calm AS (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM cnt)""", """
SELECT year(calm.month) AS year,
       CAST(sum(CASE WHEN coalesce(nr, 0) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS missing_rain,
       CAST(sum(CASE WHEN coalesce(nt, 0) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS missing_temp
FROM calm LEFT JOIN cnt ON calm.month = cnt.month GROUP BY 1""")

SQL["fill_ratio"] = with_(DENSE, """
SELECT station_id, round(count(level) / count(*), 6) AS ratio_level, round(count(lon) / count(*), 6) AS ratio_lon,
       round(count(lat) / count(*), 6) AS ratio_lat FROM f GROUP BY 1""")

SQL["activity_span"] = with_(DENSE, """
SELECT station_id, min(month) AS first, max(month) AS last, datediff('day', min(month), max(month)) AS span_days
FROM f WHERE level IS NOT NULL GROUP BY 1""")

SQL["presence_matrix"] = with_(SPARSE + """,
calm AS (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM sp),
pres AS (SELECT station_id, month, max(CASE WHEN level IS NOT NULL THEN 1 ELSE 0 END) AS present FROM sp GROUP BY 1, 2),
fa AS (SELECT station_id, min(month) AS fm FROM pres WHERE present = 1 GROUP BY 1),
rk AS (SELECT station_id, dense_rank() OVER (ORDER BY fm, station_id) AS station_rank FROM fa)""", """
SELECT s.station_id, calm.month, coalesce(pres.present, 0) AS present, rk.station_rank
FROM (SELECT DISTINCT station_id FROM sp) s CROSS JOIN calm
LEFT JOIN pres ON pres.station_id = s.station_id AND pres.month = calm.month
LEFT JOIN rk ON rk.station_id = s.station_id""")

SQL["distinct_stations"] = with_(READINGS, "SELECT DISTINCT station_id, round(lon, 6) AS lon, round(lat, 6) AS lat FROM r")

SQL["seasonal_median"] = with_(DENSE, """
SELECT station_id, dayofyear(month) AS doy, round(median(level), 6) AS profile FROM f GROUP BY 1, 2""")

SQL["station_constants"] = with_(DENSE, """
SELECT station_id,
  round(round(arg_min(lon, month) FILTER (WHERE lon IS NOT NULL), 4), 6) AS lon,
  round(round(arg_min(lat, month) FILTER (WHERE lat IS NOT NULL), 4), 6) AS lat,
  round(round(arg_min(level, month) FILTER (WHERE level IS NOT NULL), 4), 6) AS level
FROM f GROUP BY 1""")

SQL["value_range_padded"] = with_(DENSE + """,
a AS (SELECT station_id, min(level) AS vmin, max(level) AS vmax FROM f GROUP BY 1)""", """
SELECT station_id,
  round(vmin - (CASE WHEN vmax <> vmin THEN vmax - vmin ELSE 1.0 END) * 0.05, 6) AS y_min,
  round(vmax + (CASE WHEN vmax <> vmin THEN vmax - vmin ELSE 1.0 END) * 0.05, 6) AS y_max FROM a""")

SQL["station_dimension"] = with_(CLUSTERED, """
SELECT station_id, round(arg_min(lat, month), 6) AS lat, round(arg_min(lon, month), 6) AS lon, arg_min(cluster, month) AS cluster
FROM cl GROUP BY 1 HAVING arg_min(lat, month) <> 0 AND arg_min(lon, month) <> 0""")

SQL["fluctuation_index"] = with_(CLUSTERED, "SELECT station_id, round(fluctuation_index, 6) AS fluctuation_index FROM fi")

SQL["fluctuation_class"] = with_(CLUSTERED, """
SELECT station_id, round(fluctuation_index, 6) AS fluctuation_index,
  CASE WHEN fluctuation_index > 1.0 THEN 'reactive' WHEN fluctuation_index > 0.4 THEN 'intermediate' ELSE 'inertial' END AS class
FROM fi""")

SQL["cluster_two_way"] = with_(CLUSTERED, """
SELECT station_id, round(fluctuation_index, 6) AS fluctuation_index,
  CASE WHEN fluctuation_index > 0.4 THEN 'reactive' ELSE 'inertial' END AS cluster FROM fi""")

BUCKET_LIST = "bl AS (SELECT * FROM (VALUES ('>30'), ('>20'), ('>10'), ('<10')) AS t(bucket))"


def _bucket_sql(expr: str) -> str:
    return (f"CASE WHEN {expr} > 30 THEN '>30' WHEN {expr} > 20 THEN '>20' "
            f"WHEN {expr} > 10 THEN '>10' ELSE '<10' END")


SQL["duration_buckets"] = with_(DENSE + ",\n" + BUCKET_LIST + """,
du AS (SELECT station_id, datediff('day', min(month), max(month)) / 365.25 AS years FROM f WHERE level IS NOT NULL GROUP BY 1),
bc AS (SELECT """ + _bucket_sql("years") + """ AS bucket, count(*) AS n FROM du GROUP BY 1)""", """
SELECT bl.bucket, coalesce(bc.n, 0) AS n_stations FROM bl LEFT JOIN bc ON bl.bucket = bc.bucket""")

SQL["streak_buckets"] = with_(SPARSE + ",\n" + BUCKET_LIST + """,
k AS (SELECT DISTINCT station_id, year(month) * 12 + month(month) AS mi FROM sp WHERE level IS NOT NULL),
isl AS (SELECT station_id, mi - row_number() OVER (PARTITION BY station_id ORDER BY mi) AS g FROM k),
st AS (SELECT station_id, max(n) AS ls FROM (SELECT station_id, g, count(*) AS n FROM isl GROUP BY 1, 2) GROUP BY 1),
bc AS (SELECT """ + _bucket_sql("ls") + """ AS bucket, count(*) AS n FROM st GROUP BY 1)""", """
SELECT bl.bucket, coalesce(bc.n, 0) AS n_stations FROM bl LEFT JOIN bc ON bl.bucket = bc.bucket""")

SQL["longest_streak"] = with_(SPARSE + """,
k AS (SELECT DISTINCT station_id, year(month) * 12 + month(month) AS mi FROM sp WHERE level IS NOT NULL),
isl AS (SELECT station_id, mi - row_number() OVER (PARTITION BY station_id ORDER BY mi) AS g FROM k)""", """
SELECT station_id, max(n) AS longest_streak FROM (SELECT station_id, g, count(*) AS n FROM isl GROUP BY 1, 2) GROUP BY 1""")

SQL["cluster_counts"] = with_(CLUSTERED + """,
pc AS (SELECT cluster, count(*) AS n_stations FROM (SELECT DISTINCT station_id, cluster FROM cl) GROUP BY 1)""", """
SELECT cluster, n_stations, count(*) OVER () AS n_classes FROM pc""")

SQL["cluster_override"] = with_(CLUSTERED + """,
ov AS (SELECT s_suppkey AS station_id, 'inertial' AS cluster FROM supplier WHERE s_acctbal < 0),
sc AS (SELECT DISTINCT station_id, cluster FROM cl)""", """
SELECT sc.station_id, coalesce(ov.cluster, sc.cluster) AS cluster FROM sc LEFT JOIN ov ON sc.station_id = ov.station_id""")

SQL["quality_filter"] = with_(DENSE + """,
ok AS (SELECT station_id FROM f WHERE level IS NOT NULL GROUP BY 1
       HAVING datediff('day', min(month), max(month)) / 365.25 >= 5)""", """
SELECT station_id, month, round(level, 6) AS level FROM f WHERE station_id IN (SELECT station_id FROM ok)""")

SQL["cluster_selection"] = with_(CLUSTERED, """
SELECT station_id, month, round(level, 6) AS level, cluster FROM cl WHERE cluster IN ('reactive')""")

SQL["series_diff"] = with_(DENSE + """,
k AS (SELECT station_id, month, level - lag(level) OVER (PARTITION BY station_id ORDER BY month) AS diff
      FROM f WHERE level IS NOT NULL)""", "SELECT station_id, month, round(diff, 6) AS diff FROM k WHERE diff IS NOT NULL")

SQL["rate_per_day"] = with_(DENSE + """,
k AS (SELECT station_id, month,
        CAST(datediff('day', lag(month) OVER w, month) AS DOUBLE) AS days_diff,
        level - lag(level) OVER w AS delta
      FROM f WINDOW w AS (PARTITION BY station_id ORDER BY month))""", """
SELECT station_id, month, round(days_diff, 6) AS days_diff, round(delta, 6) AS delta,
       round(delta / days_diff, 6) AS delta_per_day FROM k""")

SQL["variation_transform"] = with_(DENSE, """
SELECT station_id, month, round(coalesce(lag(level) OVER (PARTITION BY station_id ORDER BY month) - level, 0.0), 6) AS level FROM f""")

SQL["ffill_bfill"] = with_(DENSE, """
SELECT station_id, month, round(coalesce(
  last_value(level IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(level IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS filled
FROM f""")

SQL["segments_and_gaps"] = with_(DENSE + """,
t AS (SELECT *, row_number() OVER w AS rn,
        sum(CASE WHEN level IS NULL THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl
      FROM f WINDOW w AS (PARTITION BY station_id ORDER BY month)),
sg AS (SELECT station_id, isl, min(month) AS seg_start, max(month) AS seg_end, count(*) AS n_rows,
              min(rn) AS r0, max(rn) AS r1 FROM t WHERE level IS NOT NULL GROUP BY 1, 2)""", """
SELECT station_id, row_number() OVER w AS segment, seg_start, seg_end, n_rows,
       lead(seg_start) OVER w AS next_start, lead(r0) OVER w - r1 - 1 AS gap_rows
FROM sg WINDOW w AS (PARTITION BY station_id ORDER BY seg_start)""")

SQL["series_shift"] = with_(DENSE_POS, """
SELECT a.station_id, a.month, a.station_id % 5 - 2 AS lag, round(b.level, 6) AS shifted
FROM fp a LEFT JOIN fp b ON b.station_id = a.station_id AND b.pos = a.pos - (a.station_id % 5 - 2)""")

SQL["cumulative_reconstruct"] = with_(DENSE + """,
ff AS (SELECT station_id, month, coalesce(
  last_value(level IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(level IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level FROM f),
de AS (SELECT *, coalesce(lag(level) OVER w - level, 0.0) AS delta,
              row_number() OVER w AS rn, first_value(level) OVER w AS start
       FROM ff WINDOW w AS (PARTITION BY station_id ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""", """
SELECT station_id, month,
  round(start - sum(CASE WHEN rn = 1 THEN 0.0 ELSE delta END) OVER (PARTITION BY station_id ORDER BY month
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS rebuilt FROM de""")

SQL["time_split"] = with_(DENSE + """,
o AS (SELECT station_id, month, row_number() OVER (ORDER BY station_id, month) - 1 AS g, count(*) OVER () AS n FROM f)""", """
SELECT station_id, month, CASE WHEN g < floor(n * 0.8) THEN 'train' ELSE 'val' END AS split FROM o""")

# ---- local cubic interpolation, written over the known points only (independent of the window form)
KNOWN_NB = DENSE_POS + """,
k AS (SELECT station_id, pos, level AS y FROM fp WHERE level IS NOT NULL),
kk AS (SELECT station_id, pos AS p, y,
         lag(pos, 1) OVER w AS p1, lag(y, 1) OVER w AS y1, lag(pos, 2) OVER w AS p2, lag(y, 2) OVER w AS y2,
         lead(pos, 1) OVER w AS q1, lead(y, 1) OVER w AS z1, lead(pos, 2) OVER w AS q2, lead(y, 2) OVER w AS z2,
         count(*) OVER (PARTITION BY station_id) AS m
       FROM k WINDOW w AS (PARTITION BY station_id ORDER BY pos)),
sl AS (SELECT *, (y - y1) / (p - p1) AS sp, (z1 - y) / (q1 - p) AS sn,
              (y1 - y2) / (p1 - p2) AS sp2, (z2 - z1) / (q2 - q1) AS sn2,
              CAST(p - p1 AS DOUBLE) AS hp, CAST(q1 - p AS DOUBLE) AS hn,
              CAST(p1 - p2 AS DOUBLE) AS hp2, CAST(q2 - q1 AS DOUBLE) AS hn2 FROM kk)"""

HERMITE_EVAL = """,
ev AS (SELECT fp.station_id, fp.month, fp.pos, fp.level,
         max(CASE WHEN fp.level IS NOT NULL THEN fp.pos END) OVER (PARTITION BY fp.station_id ORDER BY fp.pos
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lpos,
         min(CASE WHEN fp.level IS NOT NULL THEN fp.pos END) OVER (PARTITION BY fp.station_id ORDER BY fp.pos
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rpos
       FROM fp),
ev2 AS (SELECT ev.*, CASE WHEN rpos IS NULL THEN a.p1 ELSE lpos END AS pa,
               CASE WHEN rpos IS NULL THEN lpos ELSE rpos END AS pb, a.m AS m
        FROM ev LEFT JOIN dd a ON a.station_id = ev.station_id AND a.p = ev.lpos),
ev3 AS (SELECT ev2.*, A.y AS ya, A.d AS da, B.y AS yb, B.d AS db, CAST(pb - pa AS DOUBLE) AS h,
               (pos - pa) / CAST(pb - pa AS DOUBLE) AS t
        FROM ev2 LEFT JOIN dd A ON A.station_id = ev2.station_id AND A.p = ev2.pa
                 LEFT JOIN dd B ON B.station_id = ev2.station_id AND B.p = ev2.pb)"""

HERMITE_VALUE = """((2*t*t*t - 3*t*t + 1) * ya + (t*t*t - 2*t*t + t) * h * da + (-2*t*t*t + 3*t*t) * yb + (t*t*t - t*t) * h * db)"""

SQL["impute_pchip"] = with_(KNOWN_NB + """,
eg AS (SELECT *, ((2*hn + hn2) * sn - hn * sn2) / (hn + hn2) AS ef, ((2*hp + hp2) * sp - hp * sp2) / (hp + hp2) AS el FROM sl),
dd AS (SELECT station_id, p, p1, y, m, CASE
    WHEN m = 2 THEN coalesce(sn, sp)
    WHEN p1 IS NULL THEN CASE WHEN sign(ef) <> sign(sn) THEN 0.0
                              WHEN sign(sn) <> sign(sn2) AND abs(ef) > 3 * abs(sn) THEN 3 * sn ELSE ef END
    WHEN q1 IS NULL THEN CASE WHEN sign(el) <> sign(sp) THEN 0.0
                              WHEN sign(sp) <> sign(sp2) AND abs(el) > 3 * abs(sp) THEN 3 * sp ELSE el END
    WHEN sign(sp) <> sign(sn) OR sp = 0 OR sn = 0 THEN 0.0
    ELSE ((2*hn + hp) + (hn + 2*hp)) / ((2*hn + hp) / sp + (hn + 2*hp) / sn) END AS d
  FROM eg)""" + HERMITE_EVAL, """
SELECT station_id, month, round(level, 6) AS level,
  round(CASE WHEN level IS NOT NULL THEN level WHEN m IS NULL OR m < 2 OR lpos IS NULL THEN NULL
             ELSE """ + HERMITE_VALUE + """ END, 6) AS filled
FROM ev3""")

SQL["impute_akima"] = with_(KNOWN_NB + """,
ends AS (SELECT station_id,
           max(CASE WHEN p1 IS NULL THEN sn END) AS d0, max(CASE WHEN p1 IS NULL THEN sn2 END) AS d1,
           max(CASE WHEN q1 IS NULL THEN sp END) AS e0, max(CASE WHEN q1 IS NULL THEN sp2 END) AS e1
         FROM sl GROUP BY 1),
ex AS (SELECT sl.*, 2*d0 - d1 AS l1, 2*(2*d0 - d1) - d0 AS l2, 2*e0 - e1 AS r1, 2*(2*e0 - e1) - e0 AS r2
       FROM sl JOIN ends USING (station_id)),
s4 AS (SELECT *,
         CASE WHEN p2 IS NOT NULL THEN sp2 WHEN p1 IS NOT NULL THEN l1 ELSE l2 END AS ma,
         CASE WHEN p1 IS NOT NULL THEN sp ELSE l1 END AS mb,
         CASE WHEN q1 IS NOT NULL THEN sn ELSE r1 END AS mc,
         CASE WHEN q2 IS NOT NULL THEN sn2 WHEN q1 IS NOT NULL THEN r1 ELSE r2 END AS md FROM ex),
s5 AS (SELECT *, abs(md - mc) AS f1, abs(mb - ma) AS f2, abs(md - mc) + abs(mb - ma) AS f12 FROM s4),
s6 AS (SELECT *, max(f12) OVER (PARTITION BY station_id) AS f12max FROM s5),
dd AS (SELECT station_id, p, p1, y, m, CASE
    WHEN m = 2 THEN coalesce(sn, sp)
    WHEN f12 > 1e-9 * f12max THEN (f1 * mb + f2 * mc) / f12
    ELSE 0.5 * (md + ma) END AS d FROM s6)""" + HERMITE_EVAL, """
SELECT station_id, month, round(level, 6) AS level,
  round(CASE WHEN level IS NOT NULL THEN level WHEN m IS NULL OR m < 2 OR lpos IS NULL OR rpos IS NULL THEN NULL
             ELSE """ + HERMITE_VALUE + """ END, 6) AS filled
FROM ev3""")

SEASONAL = DENSE + """,
pr AS (SELECT station_id, dayofyear(month) AS doy, median(level) AS med FROM f GROUP BY 1, 2),
pr2 AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY doy) - 1 AS pos FROM pr),
pr3 AS (SELECT a.*,
   (SELECT max(b.pos) FROM pr2 b WHERE b.station_id = a.station_id AND b.pos <= a.pos AND b.med IS NOT NULL) AS p0,
   (SELECT min(b.pos) FROM pr2 b WHERE b.station_id = a.station_id AND b.pos >= a.pos AND b.med IS NOT NULL) AS p1
   FROM pr2 a),
pr4 AS (SELECT pr3.station_id, pr3.doy, CASE
     WHEN pr3.med IS NOT NULL THEN pr3.med WHEN p0 IS NULL THEN NULL WHEN p1 IS NULL THEN x0.med
     ELSE x0.med + (x1.med - x0.med) * (pr3.pos - p0) / (p1 - p0) END AS v
   FROM pr3 LEFT JOIN pr2 x0 ON x0.station_id = pr3.station_id AND x0.pos = pr3.p0
            LEFT JOIN pr2 x1 ON x1.station_id = pr3.station_id AND x1.pos = pr3.p1),
mn AS (SELECT station_id, avg(level) AS mean FROM f GROUP BY 1),
prof AS (SELECT pr4.station_id, pr4.doy, coalesce(pr4.v, mn.mean) AS profile FROM pr4 JOIN mn USING (station_id))"""

SQL["lookup_seasonal_profile"] = with_(SEASONAL, "SELECT station_id, doy, round(profile, 6) AS profile FROM prof")
SQL["impute_seasonal"] = with_(SEASONAL, """
SELECT f.station_id, f.month, round(f.level, 6) AS level, round(coalesce(f.level, prof.profile), 6) AS filled
FROM f LEFT JOIN prof ON prof.station_id = f.station_id AND prof.doy = dayofyear(f.month)""")


def _knn_sql(past_only: bool) -> str:
    past = "AND i.month < q.month" if past_only else ""
    return with_(DENSE + """,
ft AS (SELECT *, CAST(year(month) AS DOUBLE) AS fy, sin(2 * pi() * month(month) / 12) AS fs,
              cos(2 * pi() * month(month) / 12) AS fc,
              (lon IS NOT NULL AND lat IS NOT NULL) AS fok FROM f),
st AS (SELECT station_id, count(*) FILTER (WHERE level IS NOT NULL AND fok) AS nc,
         avg(level) FILTER (WHERE level IS NOT NULL AND fok) AS cmean, avg(level) AS vmean,
         avg(lon) FILTER (WHERE level IS NOT NULL AND fok) AS m1, stddev_pop(lon) FILTER (WHERE level IS NOT NULL AND fok) AS s1,
         avg(lat) FILTER (WHERE level IS NOT NULL AND fok) AS m2, stddev_pop(lat) FILTER (WHERE level IS NOT NULL AND fok) AS s2,
         avg(fy) FILTER (WHERE level IS NOT NULL AND fok) AS m3, stddev_pop(fy) FILTER (WHERE level IS NOT NULL AND fok) AS s3,
         avg(fs) FILTER (WHERE level IS NOT NULL AND fok) AS m4, stddev_pop(fs) FILTER (WHERE level IS NOT NULL AND fok) AS s4,
         avg(fc) FILTER (WHERE level IS NOT NULL AND fok) AS m5, stddev_pop(fc) FILTER (WHERE level IS NOT NULL AND fok) AS s5
       FROM ft GROUP BY 1),
z AS (SELECT ft.station_id, ft.month, ft.level, ft.fok, st.nc, st.cmean, st.vmean,
        (lon - m1) / CASE WHEN s1 = 0 THEN 1.0 ELSE s1 END AS z1, (lat - m2) / CASE WHEN s2 = 0 THEN 1.0 ELSE s2 END AS z2,
        (fy - m3) / CASE WHEN s3 = 0 THEN 1.0 ELSE s3 END AS z3, (fs - m4) / CASE WHEN s4 = 0 THEN 1.0 ELSE s4 END AS z4,
        (fc - m5) / CASE WHEN s5 = 0 THEN 1.0 ELSE s5 END AS z5
      FROM ft JOIN st USING (station_id)),
pairs AS (SELECT q.station_id, q.month, i.level AS v,
    row_number() OVER (PARTITION BY q.station_id, q.month ORDER BY
      round(sqrt((q.z1-i.z1)*(q.z1-i.z1) + (q.z2-i.z2)*(q.z2-i.z2) + (q.z3-i.z3)*(q.z3-i.z3)
               + (q.z4-i.z4)*(q.z4-i.z4) + (q.z5-i.z5)*(q.z5-i.z5)), 9), i.month) AS rn
  FROM z q JOIN z i ON q.station_id = i.station_id AND i.level IS NOT NULL AND i.fok """ + past + """
  WHERE q.level IS NULL AND q.fok AND q.nc >= 5),
est AS (SELECT station_id, month, avg(v) AS knn FROM pairs WHERE rn <= 5 GROUP BY 1, 2)""", """
SELECT z.station_id, z.month, round(z.level, 6) AS level,
  round(CASE WHEN z.level IS NOT NULL THEN z.level WHEN z.nc < 5 THEN z.vmean WHEN NOT z.fok THEN z.cmean
             ELSE est.knn END, 6) AS filled
FROM z LEFT JOIN est ON est.station_id = z.station_id AND est.month = z.month""")


SQL["impute_knn"] = _knn_sql(False)
SQL["impute_knn_past"] = _knn_sql(True)

SQL["spectrum_signature"] = with_(DENSE + """,
x AS (SELECT station_id, month, coalesce(
  last_value(level IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(level IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY month ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v,
  row_number() OVER (PARTITION BY station_id ORDER BY month) - 1 AS i, count(*) OVER (PARTITION BY station_id) AS n FROM f),
xc AS (SELECT *, v - avg(v) OVER (PARTITION BY station_id) AS c FROM x),
bins AS (SELECT unnest(range(1, 11)) AS bin),
d AS (SELECT station_id, bin, any_value(n) AS n, sum(c * cos(2 * pi() * bin * i / n)) AS re, sum(c * sin(2 * pi() * bin * i / n)) AS im
      FROM xc CROSS JOIN bins GROUP BY 1, 2)""", """
SELECT station_id, n, CAST(bin AS INTEGER) AS bin, round(CASE WHEN bin < n THEN sqrt(re * re + im * im) END, 4) AS amp FROM d""")

SQL["spectrum_similarity"] = """
WITH e AS (SELECT vec_id AS station_id, CAST(label AS VARCHAR) AS cluster, embedding AS a FROM embeddings),
v AS (SELECT station_id, cluster, unnest(range(2, len(a) + 1)) AS k, a FROM e),
vv AS (SELECT station_id, cluster, k, CAST(a[k] AS DOUBLE) AS x FROM v),
p AS (SELECT a.cluster, a.station_id, b.station_id AS other,
             covar_pop(a.x, b.x) / (stddev_pop(a.x) * stddev_pop(b.x)) AS sim
      FROM vv a JOIN vv b ON a.cluster = b.cluster AND a.k = b.k AND a.station_id <> b.station_id
      GROUP BY 1, 2, 3 HAVING stddev_pop(a.x) > 0 AND stddev_pop(b.x) > 0),
r AS (SELECT *, row_number() OVER (PARTITION BY cluster, station_id ORDER BY round(sim, 9) DESC, other) AS rank FROM p)
SELECT cluster, station_id, other, round(sim, 6) AS sim, rank FROM r WHERE rank <= 3"""


def holes_cte(pct: float, seed: int, a: int, b: int, src: str = "f", prefix: str = "h") -> str:
    """I2 block holes on table ``src`` → ``{prefix}z`` (station_id, month, level, truth, hole, lon, lat)
    restricted to stations keeping ≥ 4 known values."""
    p = prefix
    hh = lambda tag, blk: f"CAST(('0x' || substr(md5(concat_ws('|', CAST(station_id AS VARCHAR), CAST({blk} AS VARCHAR), '{seed}', '{tag}')), 1, 8)) AS BIGINT)"
    return f""",
{p}p AS (SELECT station_id, month, level, lon, lat, row_number() OVER (PARTITION BY station_id ORDER BY month) - 1 AS pos FROM {src}),
{p}n AS (SELECT station_id, count(*) AS n, CAST(floor(count(*) * {pct}) AS BIGINT) AS target FROM {p}p GROUP BY 1),
{p}b AS (SELECT station_id, n, target, unnest(range(0, 2 * target)) AS blk FROM {p}n),
{p}b2 AS (SELECT *, least({a} + {hh('len', 'blk')} % {b - a + 1}, n) AS len FROM {p}b),
{p}b3 AS (SELECT station_id, blk, target, len, {hh('start', 'blk')} % (n - len + 1) AS st FROM {p}b2
  UNION ALL SELECT station_id, 2 * target + row_number() OVER (PARTITION BY station_id ORDER BY {hh('tail', 'pos')}, pos) - 1, target, 1, pos FROM {p}p JOIN {p}n USING (station_id)),
{p}c AS (SELECT station_id, blk, target, unnest(range(st, st + len)) AS pos FROM {p}b3),
{p}f AS (SELECT station_id, pos, min(blk) AS blk, any_value(target) AS target FROM {p}c GROUP BY 1, 2),
{p}k AS (SELECT station_id, blk, count(*) AS nw, any_value(target) AS target FROM {p}f GROUP BY 1, 2),
{p}k2 AS (SELECT *, coalesce(sum(nw) OVER (PARTITION BY station_id ORDER BY blk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM {p}k),
{p}hit AS (SELECT {p}f.station_id, {p}f.pos FROM {p}f JOIN {p}k2 ON {p}f.station_id = {p}k2.station_id AND {p}f.blk = {p}k2.blk
          WHERE {p}k2.before < {p}k2.target),
{p}l AS (SELECT {p}p.*, {p}hit.pos IS NOT NULL AS hole FROM {p}p LEFT JOIN {p}hit ON {p}hit.station_id = {p}p.station_id AND {p}hit.pos = {p}p.pos),
{p}z0 AS (SELECT station_id, month, CASE WHEN hole THEN NULL ELSE level END AS level, level AS truth, hole, lon, lat FROM {p}l),
{p}z AS (SELECT * FROM {p}z0 WHERE station_id IN (SELECT station_id FROM {p}z0 GROUP BY 1 HAVING count(level) >= 4))"""


def holed_base(pct: float, seed: int, a: int, b: int) -> str:
    """DENSE with ``f`` replaced by the holed series (truth kept in ``hz``)."""
    base = DENSE.replace("\nf AS (SELECT g.station_id", "\nf_true AS (SELECT g.station_id")
    return base + holes_cte(pct, seed, a, b, "f_true") + """,
f AS (SELECT station_id, month, level, lon, lat FROM hz)"""


SQL["holes_blocks"] = with_(DENSE + holes_cte(0.2, 42, 1, 5), """
SELECT station_id, month, round(level, 6) AS level, round(truth, 6) AS truth, hole FROM hz""")

SQL["holes_points"] = with_(DENSE + """,
hp AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY month) - 1 AS pos, count(*) OVER (PARTITION BY station_id) AS n FROM f),
hr AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY
         CAST(('0x' || substr(md5(concat_ws('|', CAST(station_id AS VARCHAR), CAST(pos AS VARCHAR), '42')), 1, 8)) AS BIGINT), pos) AS r FROM hp),
hz AS (SELECT station_id, month, CASE WHEN r <= floor(n * 0.2) THEN NULL ELSE level END AS level, level AS truth,
              r <= floor(n * 0.2) AS hole FROM hr)""", """
SELECT station_id, month, round(level, 6) AS level, round(truth, 6) AS truth, hole FROM hz
WHERE station_id IN (SELECT station_id FROM hz GROUP BY 1 HAVING count(level) >= 4)""")

SQL["year_range_mask"] = with_(DENSE, """
SELECT station_id, month, round(CASE WHEN year(month) BETWEEN 1997 AND 1998 THEN NULL ELSE level END, 6) AS level FROM f""")


def method_sql(method: str, base: str) -> str:
    src = {"lineaire": SQL["impute_linear"], "bss": SQL["impute_seasonal"], "pchip": SQL["impute_pchip"], "akima": SQL["impute_akima"], "knn": SQL["impute_knn"]}[method]
    assert src.startswith("WITH " + DENSE) and ", 6) AS filled" in src
    return "WITH " + base + src[len("WITH " + DENSE):].replace(", 6) AS filled", ", 13) AS filled")


SCORE_METHODS = ["lineaire", "pchip", "akima", "bss"]
SQL_METHODS = [*SCORE_METHODS, "knn"]


def preds_sql(methods, base):
    return " UNION ALL ".join(
        f"SELECT station_id, month, '{m}' AS method, filled AS pred FROM ({method_sql(m, base)})" for m in methods)


def _score_sql(methods) -> str:
    base = holed_base(0.2, 42, 1, 5)
    return with_(CLUSTERED + holes_cte(0.2, 42, 1, 5, "f", "h") + """,
pr AS (""" + preds_sql(methods, base) + """),
sc AS (SELECT pr.station_id, pr.method,
         CASE WHEN max(hz.truth) = 0 THEN -10000000000.0
              ELSE abs(sqrt(avg((hz.truth - pr.pred) * (hz.truth - pr.pred))) / max(hz.truth)) END AS nrmse
       FROM pr JOIN hz ON pr.station_id = hz.station_id AND pr.month = hz.month
       WHERE hz.hole AND hz.truth IS NOT NULL AND pr.pred IS NOT NULL GROUP BY 1, 2),
keys AS (SELECT DISTINCT hz.station_id, m.method FROM hz CROSS JOIN (VALUES """ + ", ".join(f"('{m}')" for m in methods) + """) AS m(method)),
info AS (SELECT station_id, arg_min(lat, month) AS lat, arg_min(lon, month) AS lon, arg_min(cluster, month) AS cluster FROM cl GROUP BY 1),
scores AS (SELECT keys.station_id, info.lat, info.lon, info.cluster, 'level' AS variable, keys.method, sc.nrmse
           FROM keys LEFT JOIN sc ON sc.station_id = keys.station_id AND sc.method = keys.method
           LEFT JOIN info ON info.station_id = keys.station_id)""", "{body}")


SQL["score_on_holes"] = _score_sql(SCORE_METHODS).replace("{body}", """
SELECT station_id, round(lat, 6) AS lat, round(lon, 6) AS lon, cluster, variable, method, round(nrmse, 6) AS nrmse FROM scores""")

SQL["summary_range"] = _score_sql(SCORE_METHODS).replace("{body}", """
SELECT round(max(coalesce(nrmse, 0.0)), 6) AS max_score, round(avg(coalesce(nrmse, 0.0)), 6) AS mean_score,
       round(avg(coalesce(nrmse, 0.0)) * 2, 6) AS scale_max FROM scores""")


def _eval_sql(pct: float, seed: int, tag: str) -> str:
    """errors (dataset, method, pct_removed, NMAE, NRMSE) for one removal rate, as a subquery."""
    base = holed_base(pct, seed, 1, 6)
    return "(" + with_(DENSE + holes_cte(pct, seed, 1, 6, "f", "h") + """,
pr AS (""" + preds_sql(SQL_METHODS, base) + """),
j AS (SELECT pr.*, hz.truth AS r, row_number() OVER (PARTITION BY pr.station_id, pr.method ORDER BY pr.month) AS rn
      FROM pr JOIN hz ON pr.station_id = hz.station_id AND pr.month = hz.month)""", f"""
SELECT station_id AS dataset, method, CAST({pct} AS DOUBLE) AS pct_removed,
  CASE WHEN count(r) < count(*) OR count(pred) < count(*) THEN NULL WHEN max(r) = 0 THEN 0.0
       ELSE avg(abs(r - pred)) / max(r) END AS NMAE,
  CASE WHEN count(r) < count(*) OR count(pred) < count(*) THEN NULL WHEN max(r) = 0 THEN -10000000000.0
       ELSE abs(sqrt(avg((r - pred) * (r - pred))) / max(r)) END AS NRMSE
FROM j WHERE rn > 6 GROUP BY 1, 2""") + ")"


SQL["evaluate_methods"] = "SELECT dataset, method, pct_removed, round(NMAE, 6) AS NMAE, round(NRMSE, 6) AS NRMSE FROM " + _eval_sql(0.1, 42, "a")

ERRORS = "err AS (SELECT * FROM " + _eval_sql(0.1, 42, "a") + " UNION ALL SELECT * FROM " + _eval_sql(0.2, 43, "b") + ")"

SQL["evaluate_all"] = with_(ERRORS, "SELECT dataset, method, pct_removed, round(NMAE, 6) AS NMAE, round(NRMSE, 6) AS NRMSE FROM err")
SQL["mean_error_by_method"] = with_(ERRORS, "SELECT method, round(avg(NMAE), 6) AS mean_nmae, round(avg(NRMSE), 6) AS mean_nrmse FROM err GROUP BY 1")
SQL["error_pivot"] = with_(ERRORS, "SELECT dataset, " + ", ".join(
    f"round(avg(NRMSE) FILTER (WHERE method = '{m}'), 6) AS {m}" for m in SQL_METHODS) + " FROM err GROUP BY 1")
SQL["method_rank"] = with_(ERRORS, """
SELECT dataset, pct_removed, method, round(NRMSE, 6) AS NRMSE,
       rank() OVER (PARTITION BY dataset, pct_removed ORDER BY NRMSE ASC NULLS LAST) AS rank FROM err""")
SQL["method_league"] = with_(ERRORS + """,
rk AS (SELECT *, rank() OVER (PARTITION BY dataset, pct_removed ORDER BY NRMSE ASC NULLS LAST) AS r1,
              rank() OVER (PARTITION BY dataset, pct_removed ORDER BY NRMSE DESC NULLS FIRST) AS r2 FROM err)""", """
SELECT method, CAST(sum(CASE WHEN r1 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS first,
       CAST(sum(CASE WHEN r2 = 1 THEN 1 ELSE 0 END) AS BIGINT) AS last, round(avg(r1), 6) AS mean_rank FROM rk GROUP BY 1""")

SQL["nse"] = with_(DENSE + holes_cte(0.2, 42, 1, 5, "f", "h") + """,
pr AS (""" + preds_sql(["lineaire"], holed_base(0.2, 42, 1, 5)) + """),
j AS (SELECT pr.*, hz.truth AS r FROM pr JOIN hz ON pr.station_id = hz.station_id AND pr.month = hz.month WHERE hz.truth IS NOT NULL),
j2 AS (SELECT *, avg(r) OVER (PARTITION BY station_id, method) AS mr FROM j)""", """
SELECT station_id, method, round(1 - sum((r - pred) * (r - pred)) / nullif(sum((r - mr) * (r - mr)), 0), 6) AS nse FROM j2 GROUP BY 1, 2""")

SQL["masked_mse"] = "SELECT station_id, round(avg(CASE WHEN y <> -999 THEN (y - filled) * (y - filled) END), 6) AS masked_mse FROM (SELECT station_id, coalesce(level, -999.0) AS y, filled FROM (" + SQL["impute_linear"] + ")) GROUP BY 1"

_filled = lambda m: f"({method_sql(m, DENSE)})"
SQL["complete_variables"] = ("SELECT station_id, month, a.level, " + ", ".join(f"round({m}.filled, 6) AS {m}_level" for m in SQL_METHODS)
                             + " FROM (" + SQL["densify_series"] + ") a " + " ".join(f"JOIN {_filled(m)} {m} USING (station_id, month)" for m in SQL_METHODS))

SQL["apply_best_method"] = with_("""
sc AS (""" + SQL["score_on_holes"].replace("round(nrmse, 6)", "nrmse") + """),
best AS (SELECT station_id, arg_min(method, (nrmse, method)) AS best_method FROM sc WHERE nrmse IS NOT NULL GROUP BY 1),
pr AS (""" + " UNION ALL ".join(f"SELECT station_id, month, level, '{m}' AS method, filled FROM {_filled(m)}" for m in SCORE_METHODS) + ")", """
SELECT pr.station_id, pr.month, best.best_method, round(coalesce(pr.level, p2.filled), 6) AS completed
FROM (SELECT DISTINCT station_id, month, level FROM pr) pr
LEFT JOIN best ON best.station_id = pr.station_id
LEFT JOIN (SELECT * FROM pr) p2 ON p2.station_id = pr.station_id AND p2.month = pr.month AND p2.method = best.best_method""")

WEATHER_RAW = POINTS + """,
wr AS (SELECT CAST(strftime(month, '%Y%m') AS INTEGER) AS AAAAMM, rain AS RR, temp AS TMM, rain / 1000.0 AS ETP, lat AS LAT, lon AS LON FROM pt)"""

SQL["project_rename"] = with_(WEATHER_RAW, """
SELECT CAST(strptime(CAST(AAAAMM AS VARCHAR), '%Y%m') AS DATE) AS month, round(RR, 6) AS rain, round(TMM, 6) AS temp,
       round(ETP, 6) AS pet, round(LAT, 6) AS lat, round(LON, 6) AS lon FROM wr""")
SQL["rain_daily_rate"] = with_(WEATHER_RAW, """
SELECT CAST(strptime(CAST(AAAAMM AS VARCHAR), '%Y%m') AS DATE) AS month,
       round(RR / day(last_day(CAST(strptime(CAST(AAAAMM AS VARCHAR), '%Y%m') AS DATE))), 6) AS rain, round(TMM, 6) AS temp,
       round(ETP, 6) AS pet, round(LAT, 6) AS lat, round(LON, 6) AS lon FROM wr""")

COMMUNES = """
cm AS (SELECT CAST(c_custkey AS VARCHAR) AS insee_code, CAST((c_custkey * 37) % 96000 AS VARCHAR) AS postal_code,
              CAST(41 + (c_nationkey * 53 % 1000) / 100.0 AS DOUBLE) AS lat, CAST(-5 + (c_nationkey * 71 % 1400) / 100.0 AS DOUBLE) AS lon
       FROM customer)"""

SQL["filter_department"] = with_(COMMUNES, """
SELECT insee_code, postal_code, round(lat, 6) AS lat, round(lon, 6) AS lon FROM cm
WHERE floor(TRY_CAST(postal_code AS INTEGER) / 1000) IN (1, 13, 45)""")
SQL["filter_bbox"] = with_(POINTS, """
SELECT round(lat, 6) AS lat, round(lon, 6) AS lon, month, round(rain, 6) AS rain, round(temp, 6) AS temp FROM pt
WHERE lat BETWEEN 43.0 AND 47.0 AND lon BETWEEN -2.0 AND 4.0""")
SQL["drop_incomplete_rows"] = with_(POINTS, """
SELECT round(lat, 6) AS lat, round(lon, 6) AS lon, month, round(rain, 6) AS rain, round(temp, 6) AS temp FROM pt
WHERE lat IS NOT NULL AND lon IS NOT NULL AND month IS NOT NULL AND rain IS NOT NULL AND temp IS NOT NULL""")
SQL["drop_all_null_rows"] = with_(POINTS, """
SELECT round(lat, 6) AS lat, round(lon, 6) AS lon, month, round(rain, 6) AS rain, round(temp, 6) AS temp FROM pt
WHERE rain IS NOT NULL OR temp IS NOT NULL""")
SQL["drop_null_target"] = with_(DENSE, """
SELECT station_id, month, round(level, 6) AS level, round(lon, 6) AS lon, round(lat, 6) AS lat FROM f WHERE level IS NOT NULL""")
SQL["fill_sentinel"] = with_(DENSE, """
SELECT station_id, month, round(coalesce(level, -1.0), 6) AS level, round(lon, 6) AS lon, round(lat, 6) AS lat FROM f""")
SQL["search_stations"] = """
SELECT s_suppkey AS station_id, s_name AS name, round(CAST(41 + (s_suppkey * 37 % 1000) / 100.0 AS DOUBLE), 6) AS lat,
       round(CAST(-5 + (s_suppkey * 91 % 1400) / 100.0 AS DOUBLE), 6) AS lon
FROM supplier WHERE contains(lower(s_name), 'plier#00000001')"""
SQL["coerce_types"] = """
SELECT event_id, TRY_CAST(event_type AS DOUBLE) AS as_number, round(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE), 6) AS value,
       TRY_CAST(props AS TIMESTAMP) AS as_time FROM events WHERE ts IS NOT NULL"""
SQL["compare_series"] = """
WITH a AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS n, avg(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1),
b AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS n, avg(l_quantity) AS q FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1),
c AS (SELECT CAST(unnest(generate_series((SELECT min(month) FROM (SELECT month FROM a UNION ALL SELECT month FROM b)),
                                         (SELECT max(month) FROM (SELECT month FROM a UNION ALL SELECT month FROM b)), INTERVAL 1 MONTH)) AS DATE) AS month)
SELECT c.month, a.n AS n_a, round(a.q, 6) AS q_a, b.n AS n_b, round(b.q, 6) AS q_b FROM c LEFT JOIN a ON a.month = c.month LEFT JOIN b ON b.month = c.month"""
SQL["join_commune_coords"] = with_(COMMUNES, """
SELECT o.o_orderkey, cm.postal_code, round(cm.lat, 6) AS lat, round(cm.lon, 6) AS lon
FROM orders o JOIN cm ON (CASE WHEN length(CAST(o.o_custkey AS VARCHAR)) < 5 THEN lpad(CAST(o.o_custkey AS VARCHAR), 5, '0') ELSE CAST(o.o_custkey AS VARCHAR) END)
                       = (CASE WHEN length(cm.insee_code) < 5 THEN lpad(cm.insee_code, 5, '0') ELSE cm.insee_code END)""")
SQL["join_grid_cells"] = """
WITH ce AS (SELECT s_suppkey AS lambx, unnest(range(1, 8)) AS lamby FROM supplier)
SELECT l.l_suppkey AS lambx, l.l_linenumber AS lamby, l.l_orderkey, round(l.l_quantity, 6) AS l_quantity,
       round(CAST(41 + (ce.lambx * 37 % 1000) / 100.0 AS DOUBLE) + ce.lamby / 100.0, 6) AS lat,
       round(CAST(-5 + (ce.lambx * 91 % 1400) / 100.0 AS DOUBLE), 6) AS lon
FROM lineitem l JOIN ce ON l.l_suppkey = ce.lambx AND l.l_linenumber = ce.lamby"""
SQL["semi_join_cells"] = """
SELECT l_orderkey, l_linenumber, l_suppkey AS cell_id FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)"""
SQL["union_all"] = """
SELECT l_orderkey, l_linenumber, round(l_quantity, 6) AS l_quantity FROM lineitem WHERE l_returnflag = 'R'
UNION ALL SELECT l_orderkey, l_linenumber, round(l_quantity, 6) FROM lineitem WHERE l_returnflag = 'A'
UNION ALL SELECT l_orderkey, l_linenumber, round(l_quantity, 6) FROM lineitem WHERE l_returnflag = 'N'"""
SQL["unpivot_vintages"] = with_(SOIL, """
SELECT round(lat, 6) AS lat, round(lon, 6) AS lon, round(total_area, 6) AS total_area, year, round(sealed_area, 6) AS sealed_area FROM soil""")
SQL["distinct_sorted"] = "SELECT DISTINCT event_type FROM events"
SQL["sort_series"] = with_(POINTS, "SELECT round(lat, 6) AS lat, round(lon, 6) AS lon, month, round(rain, 6) AS rain, round(temp, 6) AS temp FROM pt")
SQL["sort_stations"] = with_(CLUSTERED + """,
du AS (SELECT station_id, datediff('day', min(month), max(month)) / 365.25 AS years FROM f WHERE level IS NOT NULL GROUP BY 1),
k AS (SELECT DISTINCT station_id, year(month) * 12 + month(month) AS mi FROM f WHERE level IS NOT NULL),
isl AS (SELECT station_id, mi - row_number() OVER (PARTITION BY station_id ORDER BY mi) AS g FROM k),
st AS (SELECT station_id, max(n) AS longest_streak FROM (SELECT station_id, g, count(*) AS n FROM isl GROUP BY 1, 2) GROUP BY 1)""", """
SELECT fi.station_id, CASE WHEN fi.fluctuation_index > 0.4 THEN 'reactive' ELSE 'inertial' END AS cluster,
       round(du.years, 6) AS years, st.longest_streak FROM fi LEFT JOIN du USING (station_id) LEFT JOIN st USING (station_id)""")
SQL["scalar_functions"] = """
SELECT o_orderkey,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS k1_month, CAST(o_orderdate AS DATE) AS k1_day,
  make_date(year(o_orderdate), 1, 1) AS k1_year, CAST(date_trunc('month', o_orderdate) AS DATE) AS k2_month,
  day(last_day(o_orderdate)) AS k3_days, CAST(datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400 AS k4_epoch,
  year(o_orderdate) AS k5_year, month(o_orderdate) AS k5_month, dayofyear(o_orderdate) AS k5_doy,
  round(sin(2 * pi() * month(o_orderdate) / 12), 6) AS k6_sin, round(cos(2 * pi() * month(o_orderdate) / 12), 6) AS k6_cos,
  (year(o_orderdate) * 12 + month(o_orderdate)) - (1995 * 12 + 1) AS k11_step
FROM orders"""
SQL["string_functions"] = """
SELECT page_id, string_split(url, '/')[-1] AS k12_basename, replace(url, '/', '_') AS k8_safe,
  CASE WHEN length(CAST(page_id * 997 AS VARCHAR)) < 5 THEN lpad(CAST(page_id * 997 AS VARCHAR), 5, '0') ELSE CAST(page_id * 997 AS VARCHAR) END AS k7_pad,
  trim(replace(' #' || CAST(page_id AS VARCHAR) || '# ', '#', '')) AS k9_header,
  contains(lower(url), 'example.com') AS k10_contains,
  replace(replace('data_' || CAST(page_id AS VARCHAR) || '.csv', 'data_', ''), '.csv', '') AS k13_station
FROM pages"""
SQL["json_fields"] = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, coalesce(json_extract_string(props, '$.format'), '') AS format FROM events"""

_SERIES_BACK = with_(DENSE, "SELECT station_id, month, round(level, 6) AS level, round(lon, 6) AS lon, round(lat, 6) AS lat FROM f")
SQL["scan_series_csv"] = _SERIES_BACK
SQL["scan_series_folder"] = _SERIES_BACK
SQL["write_per_station"] = with_(DENSE, "SELECT station_id, count(*) AS n_rows FROM f GROUP BY 1")
SQL["write_by_cluster"] = with_(CLUSTERED, "SELECT station_id, month, round(level, 6) AS level, cluster FROM cl")
SQL["write_table"] = with_(POINTS, "SELECT round(lat, 6) AS lat, round(lon, 6) AS lon, month, round(rain, 6) AS rain, round(temp, 6) AS temp FROM pt")
SQL["append_run_log"] = SQL["evaluate_all"]
SQL["read_summary"] = _score_sql(SCORE_METHODS).replace("{body}", """
SELECT station_id, variable, method, round(nrmse, 6) AS nrmse FROM scores""")
SQL["read_clusters_or_fused"] = with_(DENSE, """
SELECT station_id, month, round(level, 6) AS level, round(lon, 6) AS lon, round(lat, 6) AS lat, CAST(NULL AS VARCHAR) AS cluster FROM f""")
SQL["scan_suffix_filter"] = with_(COMMUNES, "SELECT insee_code, postal_code, round(lat, 6) AS lat, round(lon, 6) AS lon FROM cm")

_MM = with_(DENSE + """,
s AS (SELECT min(level) AS a1, max(level) AS b1, min(lon) AS a2, max(lon) AS b2, min(lat) AS a3, max(lat) AS b3 FROM f)""", """
SELECT station_id, month,
  round(2 * (level - a1) / CASE WHEN b1 = a1 THEN 1.0 ELSE b1 - a1 END - 1, 6) AS level,
  round(2 * (lon - a2) / CASE WHEN b2 = a2 THEN 1.0 ELSE b2 - a2 END - 1, 6) AS lon,
  round(2 * (lat - a3) / CASE WHEN b3 = a3 THEN 1.0 ELSE b3 - a3 END - 1, 6) AS lat FROM f, s""")
SQL["minmax_scale"] = _MM
SQL["reuse_scaler"] = _MM
SQL["minmax_inverse"] = with_(DENSE, "SELECT station_id, month, round(level, 6) AS level, round(lon, 6) AS lon, round(lat, 6) AS lat FROM f")
SQL["standard_scale"] = with_(DENSE + """,
s AS (SELECT station_id, avg(level) AS mu, stddev_pop(level) AS sd FROM f GROUP BY 1)""", """
SELECT f.station_id, f.month, round((level - mu) / CASE WHEN sd = 0 THEN 1.0 ELSE sd END, 6) AS level,
       round(lon, 6) AS lon, round(lat, 6) AS lat FROM f JOIN s ON f.station_id = s.station_id""")
SQL["overlap_average"] = with_(DENSE_POS + """,
nn AS (SELECT station_id, count(*) AS n FROM fp GROUP BY 1),
cov AS (SELECT a.station_id, a.pos, avg(coalesce(b.level, -1.0)) AS pred
        FROM fp a JOIN nn ON nn.station_id = a.station_id
        JOIN fp b ON b.station_id = a.station_id AND b.pos = a.pos
        JOIN (SELECT station_id, pos AS st FROM fp) w ON w.station_id = a.station_id AND w.st <= a.pos AND a.pos < w.st + 12
             AND w.st <= nn.n - 12 - 1
        GROUP BY 1, 2)""", """
SELECT fp.station_id, fp.month, round(cov.pred, 6) AS pred FROM fp LEFT JOIN cov ON cov.station_id = fp.station_id AND cov.pos = fp.pos""")
SQL["explode_api_pages"] = "SELECT l_suppkey AS station_id, CAST(l_shipdate AS DATE) AS time, CASE WHEN l_returnflag = 'R' THEN round(l_quantity, 6) END AS level FROM lineitem"

SQL["scan_mixed_compressed"] = SQL["scan_with_preamble"] = SQL["explode_api_pages"]
SQL["scan_schema_drift"] = """
SELECT l_suppkey AS station_id, CAST(l_shipdate AS DATE) AS time,
  CASE WHEN l_returnflag = 'R' AND l_suppkey % 3 <> 2 THEN round(l_quantity, 6) END AS level FROM lineitem"""
SQL["filter_manifest"] = """
SELECT 'Set_' || s_nationkey || '_' || s_suppkey AS title, 'http://x/' || s_suppkey AS url, 'CSV' AS format
FROM supplier WHERE s_suppkey % 3 = 0 AND s_nationkey IN (1, 7)"""
SQL["month_year_pivot"] = with_(DENSE, "SELECT CAST(month(month) AS INTEGER) AS month_of_year, " + ", ".join(
    f"round(max(level) FILTER (WHERE year(month) = {y}), 6) AS y{y}" for y in range(1992, 1999)) + " FROM f GROUP BY 1")

# every pair of a class, from the definition: own grid against the class's months, Pearson over bins 1 … L − 1
SQL["top_similar_series"] = with_(CLUSTERED + """,
um AS (SELECT DISTINCT cluster, month FROM cl),
us AS (SELECT DISTINCT cluster, station_id FROM cl),
both_grids AS (
  SELECT 't' AS kind, cluster, station_id, month, level FROM cl
  UNION ALL
  SELECT 'r', us.cluster, us.station_id, um.month, cl.level
  FROM us JOIN um ON us.cluster = um.cluster LEFT JOIN cl ON cl.station_id = us.station_id AND cl.month = um.month),
fl AS (
  SELECT kind, cluster, station_id, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY kind, station_id) AS n,
    coalesce(last_value(level IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
             first_value(level IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v
  FROM both_grids WINDOW w AS (PARTITION BY kind, station_id ORDER BY month)),
ce AS (SELECT *, v - avg(v) OVER (PARTITION BY kind, station_id) AS c FROM fl),
am AS (SELECT kind, cluster, station_id, n, bin, sqrt(sum(c * cos(2 * pi() * bin * i / n)) ** 2 + sum(c * sin(2 * pi() * bin * i / n)) ** 2) AS amp
       FROM ce CROSS JOIN (SELECT unnest(range(1, 11)) AS bin) GROUP BY ALL),
nu AS (SELECT cluster, max(n) AS nu FROM am WHERE kind = 'r' GROUP BY 1),
ln AS (SELECT DISTINCT am.cluster, station_id, least(n, nu, 11) AS L FROM am JOIN nu ON am.cluster = nu.cluster WHERE kind = 't'),
pr AS (SELECT ln.cluster, ln.station_id, r.station_id AS other, ln.L, covar_pop(a.amp, r.amp) / (stddev_pop(a.amp) * stddev_pop(r.amp)) AS sim
       FROM ln JOIN am a ON a.kind = 't' AND a.station_id = ln.station_id AND a.bin < ln.L
       JOIN am r ON r.kind = 'r' AND r.cluster = ln.cluster AND r.bin = a.bin AND r.station_id <> ln.station_id
       GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY round(sim, 9) DESC, other) AS rank FROM pr)""", """
SELECT cluster, station_id, other, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 10""")

SQL["unpivot_scores"] = _score_sql(SCORE_METHODS).replace("{body}", """
SELECT station_id, method, variable, round(nrmse, 6) AS nrmse FROM scores""")


def _tiled(rows: str, keys: str, value: str, width: int) -> str:
    """Rows of a table with station_id, in tiles by the station's hash."""
    return f""",
ids AS (SELECT DISTINCT station_id FROM {rows}),
tile AS (SELECT station_id, ('0x' || substr(md5(concat_ws('|', CAST(station_id AS VARCHAR), 'tile')), 1, 8))::BIGINT
           % greatest(ceil((SELECT count(*) FROM ids) / {width}), 1)::BIGINT AS tile FROM ids)""", f"""
SELECT {keys}, tile, string_agg(station_id::VARCHAR, ',' ORDER BY station_id) AS stations,
  string_agg(coalesce(round({value} * 1000)::BIGINT::VARCHAR, '-'), ',' ORDER BY station_id) AS values
FROM {rows} JOIN tile USING (station_id) GROUP BY {keys}, tile"""


SQL["pivot_series"] = with_(DENSE + _tiled("f", "month", "level", 16)[0], _tiled("f", "month", "level", 16)[1])
_matrix = _tiled("scores", "cluster, variable, method", "nrmse", 16)
SQL["score_matrix_by_cluster"] = _score_sql(SCORE_METHODS).replace("{body}", _matrix[0] + _matrix[1])
SQL["dataset_focus"] = with_(ERRORS, "SELECT dataset, method, pct_removed, round(NMAE, 6) AS NMAE, round(NRMSE, 6) AS NRMSE FROM err WHERE dataset = 7")


def _windows_sql(ahead: int) -> str:
    """Windows of 12 rows that end at e, x holed with -1 for gaps, y the truth of the rows ``ahead``."""
    return with_(DENSE_POS + holes_cte(0.1, 42, 1, 5), f"""
SELECT w.station_id, e AS x_end, 12 AS n_x, round(sum(coalesce(h.level, -1.0)), 6) AS sum_x_level, round(sum(coalesce(t.level, 0.0)), 6) AS sum_y_level
FROM (SELECT station_id, unnest(range(11, n - 1 - {ahead}))::INTEGER AS e FROM (SELECT station_id, count(*) AS n FROM hz GROUP BY 1) WHERE n > 13 + {ahead}) w
JOIN (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY month) - 1 AS pos FROM hz) h ON h.station_id = w.station_id AND h.pos BETWEEN e - 11 AND e
JOIN fp t ON t.station_id = w.station_id AND t.pos = h.pos + {ahead}
GROUP BY ALL""")


SQL["sliding_windows"] = _windows_sql(0)
SQL["sliding_windows_lstm"] = _windows_sql(1)


def _det(a: list[list[str]]) -> str:
    (a, b, c), (d, e, f), (g, h, i) = a
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


def _pair_model(pct: float, ridges: list[float], share: str = "1.0") -> str:
    """Rows of the level, scaled and holed (sc … v), their two outputs (o) with the part that they belong to, and by output
    and ridge term the three weights (wt): the normal equations solved by Cramer's rule. The first ``share`` of a series trains."""
    a = [["n", "s1", "s2"], ["s1", "s11", "s12"], ["s2", "s12", "s22"]]
    b = ["sy", "s1y", "s2y"]
    weights = ", ".join(_det([[b[i] if j == w else a[i][j] for j in range(3)] for i in range(3)]) + f" / {_det(a)} AS w{w}" for w in range(3))
    return holes_cte(pct, 42, 1, 5) + f""",
mm AS (SELECT min(level) AS lo, CASE WHEN max(level) = min(level) THEN 1.0 ELSE max(level) - min(level) END AS span FROM f),
sc AS (SELECT station_id, month, pos, hole, 2 * (truth_ - lo) / span - 1 AS y FROM (SELECT station_id, month, pos, hole, level AS truth_ FROM hl) CROSS JOIN mm),
x AS (SELECT *, CASE WHEN hole THEN -1.0 ELSE coalesce(y, -1.0) END AS h, coalesce(y, -1.0) AS p, count(*) OVER (PARTITION BY station_id) AS rows_,
        pos < floor(count(*) OVER (PARTITION BY station_id) * {share}::DOUBLE) AS train FROM sc),
v AS (SELECT *, lag(h, 1, -1.0) OVER w AS h0, lead(h, 1, -1.0) OVER w AS h2, lag(p) OVER w AS p0, lead(p) OVER w AS p2
      FROM x WINDOW w AS (PARTITION BY station_id, train ORDER BY pos)),
o AS (SELECT 0 AS t, train, h AS a, h2 AS b, y FROM v WHERE y IS NOT NULL UNION ALL SELECT 1, train, h0, h, y FROM v WHERE y IS NOT NULL),
rd(ridge) AS (VALUES {", ".join(f"({r}::DOUBLE)" for r in ridges)}),
q AS (SELECT t, ridge, count(*)::DOUBLE AS n, sum(a) AS s1, sum(b) AS s2, sum(a * a) + ridge * count(*) AS s11, sum(a * b) AS s12, sum(b * b) + ridge * count(*) AS s22,
        sum(y) AS sy, sum(a * y) AS s1y, sum(b * y) AS s2y FROM o, rd WHERE train GROUP BY t, ridge),
wt AS (SELECT t, ridge, {weights} FROM q)"""


SQL["impute_window_regression_pair"] = with_(DENSE + _pair_model(0.1, [1e-3]) + """,
pr AS (SELECT station_id, month, CASE WHEN pos <= rows_ - 3 THEN (SELECT w0 FROM wt WHERE t = 0) + (SELECT w1 FROM wt WHERE t = 0) * p + (SELECT w2 FROM wt WHERE t = 0) * p2 END AS first,
         CASE WHEN pos BETWEEN 1 AND rows_ - 2 THEN (SELECT w0 FROM wt WHERE t = 1) + (SELECT w1 FROM wt WHERE t = 1) * p0 + (SELECT w2 FROM wt WHERE t = 1) * p END AS second FROM v)""", """
SELECT f.station_id, f.month, round(level, 6) AS level,
  round((CASE WHEN first IS NULL THEN second WHEN second IS NULL THEN first ELSE (first + second) / 2 END + 1) / 2 * span + lo, 6) AS filled
FROM f JOIN pr USING (station_id, month) CROSS JOIN mm""")


def _grid_sql(pct: float) -> str:
    return "(" + with_(DENSE + _pair_model(pct, [0.001, 0.1, 1.0], "0.8"), f"""
SELECT {pct}::DOUBLE AS pct, 2 AS size, ridge, avg((y - w0 - w1 * a - w2 * b) ** 2) AS val_loss,
  1 - avg((y - w0 - w1 * a - w2 * b) ** 2) / var_pop(y) AS val_accuracy
FROM o JOIN wt USING (t) WHERE NOT train GROUP BY ridge""") + ")"


SQL["grid_search_resume"] = f"""
SELECT pct, size, ridge, round(val_loss, 6) AS val_loss, round(val_accuracy, 6) AS val_accuracy, row_number() OVER (ORDER BY val_loss, pct, ridge)::INTEGER AS rank
FROM (SELECT * FROM {_grid_sql(0.1)} UNION ALL SELECT * FROM {_grid_sql(0.2)})"""


def _split_sql(rows: str, name: str) -> str:
    """The best split of each node of ``rows`` (station_id, node, x1, x2, y, w), and its rows a level further down (node 2k+1 or 2k+2)."""
    return f""",
{name}l AS (SELECT station_id, node, f, x, sum(w) AS w, sum(w * y) AS s FROM (
         SELECT station_id, node, 1 AS f, x1 AS x, y, w FROM {rows} UNION ALL SELECT station_id, node, 2, x2, y, w FROM {rows}) GROUP BY ALL),
{name}c AS (SELECT *, sum(w) OVER o AS lw, sum(s) OVER o AS ls, sum(w) OVER (PARTITION BY station_id, node, f) AS tw, sum(s) OVER (PARTITION BY station_id, node, f) AS ts,
         lead(x) OVER o AS nx FROM {name}l WINDOW o AS (PARTITION BY station_id, node, f ORDER BY x)),
{name}b AS (SELECT station_id, node, f, (x + nx) / 2 AS thr FROM {name}c WHERE nx IS NOT NULL
         AND (station_id, node) IN (SELECT (station_id, node) FROM {rows} GROUP BY station_id, node HAVING count(DISTINCT y) > 1)
         QUALIFY row_number() OVER (PARTITION BY station_id, node ORDER BY round(ls * ls / lw + (ts - ls) * (ts - ls) / (tw - lw), 9) DESC, f, x) = 1),
{name} AS (SELECT r.* EXCLUDE (node), 2 * r.node + 1 + (CASE WHEN f = 1 THEN x1 ELSE x2 END > thr)::INT AS node FROM {rows} r JOIN {name}b USING (station_id, node))"""


SQL["impute_forest_delta_tree"] = with_(FUSED + """,
ft AS (SELECT station_id, month, level, pet, temp, row_number() OVER o AS rn, date_diff('day', lag(month) OVER o, month)::DOUBLE AS days,
         (level - lag(level) OVER o) / date_diff('day', lag(month) OVER o, month) AS dpd, first_value(level IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_known
       FROM fz WINDOW o AS (PARTITION BY station_id ORDER BY month)),
tr AS (SELECT station_id, dpd AS y, pet AS x1, temp AS x2, row_number() OVER (PARTITION BY station_id ORDER BY month) - 1 AS i, count(*) OVER (PARTITION BY station_id) AS n
       FROM ft WHERE level IS NOT NULL AND dpd IS NOT NULL AND pet IS NOT NULL AND temp IS NOT NULL),
dr AS (SELECT station_id, n, ('0x' || substr(md5(concat_ws('|', station_id::VARCHAR, '0', i::VARCHAR, '42')), 1, 8))::BIGINT % n AS i FROM tr WHERE n >= 3),
wt AS (SELECT station_id, i, count(*) AS w FROM dr GROUP BY 1, 2),
n0 AS (SELECT station_id, 0 AS node, x1, x2, y, w FROM tr JOIN wt USING (station_id, i))""" + _split_sql("n0", "n1") + _split_sql("n1", "n2") + """,
mean AS (SELECT station_id, node, sum(w * y) / sum(w) AS p FROM (SELECT * FROM n0 UNION ALL SELECT station_id, node, x1, x2, y, w FROM n1
         UNION ALL SELECT station_id, node, x1, x2, y, w FROM n2) GROUP BY 1, 2),
av AS (SELECT station_id, avg(x1) AS a1, avg(x2) AS a2 FROM tr WHERE n >= 3 GROUP BY 1),
q0 AS (SELECT ft.*, coalesce(pet, a1) AS x1, coalesce(temp, a2) AS x2 FROM ft JOIN av USING (station_id)),
q1 AS (SELECT q0.*, CASE WHEN n1b.f IS NULL THEN 0 ELSE 1 + (CASE WHEN n1b.f = 1 THEN x1 ELSE x2 END > n1b.thr)::INT END AS node FROM q0 LEFT JOIN n1b ON n1b.station_id = q0.station_id AND n1b.node = 0),
q2 AS (SELECT q1.* EXCLUDE (node), CASE WHEN n2b.f IS NULL THEN q1.node ELSE 2 * q1.node + 1 + (CASE WHEN n2b.f = 1 THEN x1 ELSE x2 END > n2b.thr)::INT END AS node
       FROM q1 LEFT JOIN n2b ON n2b.station_id = q1.station_id AND n2b.node = q1.node AND q1.node > 0),
pd AS (SELECT q2.*, p, CASE WHEN rn = 1 AND level IS NULL THEN first_known ELSE level END AS y,
         sum(CASE WHEN rn = 1 THEN 0.0 ELSE p * coalesce(days, 0.0) END) OVER (PARTITION BY q2.station_id ORDER BY month) AS s FROM q2 JOIN mean USING (station_id, node)),
an AS (SELECT *, last_value(CASE WHEN y IS NOT NULL THEN {'y': y, 's': s} END IGNORE NULLS) OVER (PARTITION BY station_id ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a FROM pd)""", """
SELECT ft.station_id, ft.month, round(ft.level, 4) AS level, round(CASE WHEN an.y IS NOT NULL THEN an.y ELSE an.a.y + an.s - an.a.s END, 4) AS filled
FROM ft LEFT JOIN an USING (station_id, month)""")


def _sweep_sql(equations: str) -> str:
    """Tridiagonal systems by station: eq(station_id, i, n, a, b, c, r), i from 1 to n, solved row by row into sol(station_id, i, v)."""
    return f""",
eq AS ({equations}),
fw AS (SELECT station_id, i, n, c / b AS c, r / b AS r FROM eq WHERE i = 1
       UNION ALL SELECT e.station_id, e.i, e.n, e.c / (e.b - e.a * f.c), (e.r - e.a * f.r) / (e.b - e.a * f.c) FROM fw f JOIN eq e ON e.station_id = f.station_id AND e.i = f.i + 1),
sol AS (SELECT station_id, i, r AS v FROM fw WHERE i = n
        UNION ALL SELECT f.station_id, f.i, f.r - f.c * s.v FROM sol s JOIN fw f ON f.station_id = s.station_id AND f.i = s.i - 1)"""


# known points k = 0 … m-1 with their neighbours, h the distance and d the slope to the next
_POINTS = DENSE_POS + """,
kn AS (SELECT *, h0 + h1 AS hh FROM (SELECT station_id, pos::DOUBLE AS p, level AS y, row_number() OVER w - 1 AS k, count(*) OVER (PARTITION BY station_id) AS m,
         (lead(pos) OVER w - pos)::DOUBLE AS h1, (pos - lag(pos) OVER w)::DOUBLE AS h0, (lead(level) OVER w - level) / (lead(pos) OVER w - pos) AS d1,
         (level - lag(level) OVER w) / (pos - lag(pos) OVER w) AS d0, (lead(pos, 2) OVER w - lead(pos) OVER w)::DOUBLE AS h2
       FROM fp WHERE level IS NOT NULL WINDOW w AS (PARTITION BY station_id ORDER BY pos)))"""

SQL["impute_cubic"] = "WITH RECURSIVE " + _POINTS + _sweep_sql("""
  SELECT station_id, k AS i, m - 2 AS n,
    CASE WHEN k = 1 THEN 0.0 WHEN k = m - 2 THEN h0 - h1 * h1 / h0 ELSE h0 END AS a,
    2 * hh + CASE WHEN k = 1 THEN h0 + h0 * h0 / h1 ELSE 0 END + CASE WHEN k = m - 2 THEN h1 + h1 * h1 / h0 ELSE 0 END AS b,
    CASE WHEN k = m - 2 THEN 0.0 WHEN k = 1 THEN h1 - h0 * h0 / h1 ELSE h1 END AS c, 6 * (d1 - d0) AS r
  FROM kn WHERE m >= 4 AND k BETWEEN 1 AND m - 2""") + """,
cu AS (SELECT station_id, i AS k, v FROM sol
       UNION ALL SELECT a.station_id, 0, a.v + kn.h0 / kn.h1 * (a.v - b.v) FROM kn JOIN sol a ON a.station_id = kn.station_id AND a.i = 1 JOIN sol b ON b.station_id = kn.station_id AND b.i = 2 WHERE kn.k = 1
       UNION ALL SELECT a.station_id, m - 1, a.v + kn.h1 / kn.h0 * (a.v - b.v) FROM kn JOIN sol a ON a.station_id = kn.station_id AND a.i = m - 2 JOIN sol b ON b.station_id = kn.station_id AND b.i = m - 3 WHERE kn.k = m - 2),
pc AS (SELECT kn.station_id, kn.p, kn.h1, kn.y AS y0, kn.y + kn.d1 * kn.h1 AS y1, a.v AS c0, b.v AS c1 FROM kn JOIN cu a ON a.station_id = kn.station_id AND a.k = kn.k JOIN cu b ON b.station_id = kn.station_id AND b.k = kn.k + 1)
SELECT fp.station_id, fp.month, round(level, 6) AS level, round(coalesce(level,
    (c0 * (p + h1 - pos) ** 3 + c1 * (pos - p) ** 3) / (6 * h1) + (y0 / h1 - c0 * h1 / 6) * (p + h1 - pos) + (y1 / h1 - c1 * h1 / 6) * (pos - p)), 6) AS filled
FROM fp LEFT JOIN pc ON pc.station_id = fp.station_id AND fp.pos > p AND fp.pos < p + h1"""

SQL["impute_quadratic"] = "WITH RECURSIVE " + _POINTS + _sweep_sql("""
  SELECT station_id, k AS i, m - 3 AS n, CASE WHEN k = 1 THEN 0.0 ELSE h1 / (h0 + h1) END AS a, h0 / (h0 + h1) + 2 + h2 / (h1 + h2) AS b,
    CASE WHEN k = m - 3 THEN 0.0 ELSE h1 / (h1 + h2) END AS c,
    4 * d1 - CASE WHEN k = 1 THEN h1 / (h0 + h1) * d0 ELSE 0 END - CASE WHEN k = m - 3 THEN h1 / (h1 + h2) * lead_d ELSE 0 END AS r
  FROM (SELECT *, lead(d1) OVER (PARTITION BY station_id ORDER BY k) AS lead_d FROM kn) WHERE m >= 4 AND k BETWEEN 1 AND m - 3""") + """,
sl AS (SELECT station_id, i AS k, v FROM sol UNION ALL SELECT station_id, k, d1 FROM kn WHERE m >= 3 AND k IN (0, m - 2)),
pc AS (SELECT kn.*, a.v AS s0, b.v AS s1, CASE WHEN kn.k = 1 THEN -1e9 ELSE p - h0 / 2 END AS lo, CASE WHEN kn.k = m - 2 THEN 1e9 ELSE p + h1 / 2 END AS hi
       FROM kn JOIN sl a ON a.station_id = kn.station_id AND a.k = kn.k - 1 JOIN sl b ON b.station_id = kn.station_id AND b.k = kn.k WHERE kn.k BETWEEN 1 AND m - 2),
ends AS (SELECT station_id, min(p) AS p0, max(p) AS p1 FROM kn GROUP BY 1)
SELECT fp.station_id, fp.month, round(fp.level, 6) AS level, round(coalesce(fp.level,
    CASE WHEN fp.pos BETWEEN p0 AND p1 THEN y + (s0 * h1 + s1 * h0) / hh * (fp.pos - p) + (s1 - s0) / hh * (fp.pos - p) ** 2 END), 6) AS filled
FROM fp LEFT JOIN ends ON ends.station_id = fp.station_id LEFT JOIN pc ON pc.station_id = fp.station_id AND fp.pos > lo AND fp.pos <= hi"""


# the ten most similar series of each station on its grid, forward-filled; all lags of a pair from the definition
_LAGS = CLUSTERED + """,
tp AS (SELECT station_id, other FROM (""" + SQL["top_similar_series"] + """)),
gr AS (SELECT station_id, month, level AS x, row_number() OVER (PARTITION BY station_id ORDER BY month) - 1 AS pos FROM cl),
pa_ AS (SELECT gr.station_id, tp.other, gr.month, gr.pos, gr.x, o.level AS y FROM tp JOIN gr USING (station_id) LEFT JOIN cl o ON o.station_id = tp.other AND o.month = gr.month),
fi_ AS (SELECT *, last_value(x IGNORE NULLS) OVER w AS xf, last_value(y IGNORE NULLS) OVER w AS yf FROM pa_
        WINDOW w AS (PARTITION BY station_id, other ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
lc AS (SELECT a.station_id, a.other, g.lag, covar_pop(a.xf, b.yf) / (stddev_pop(a.xf) * stddev_pop(b.yf)) AS c
       FROM fi_ a CROSS JOIN (SELECT unnest(range(-24, 25)) AS lag) g JOIN fi_ b ON b.station_id = a.station_id AND b.other = a.other AND b.pos = a.pos - g.lag
       WHERE a.xf IS NOT NULL AND b.yf IS NOT NULL
       GROUP BY ALL HAVING count(*) >= 5 AND min(a.xf) <> max(a.xf) AND min(b.yf) <> max(b.yf)),
lb AS (SELECT station_id, other, lag FROM lc WHERE round(c, 9) > -1 QUALIFY row_number() OVER (PARTITION BY station_id, other ORDER BY round(c, 9) DESC, lag) = 1),
lg AS (SELECT tp.station_id, tp.other, coalesce(lb.lag, 0)::INTEGER AS lag FROM tp LEFT JOIN lb USING (station_id, other))"""

SQL["lag_search_join"] = with_(_LAGS, "SELECT station_id, other, lag FROM lg")

SQL["impute_similar_series"] = with_(_LAGS + """,
sh AS (SELECT p.station_id, p.other, p.pos, p.x, q.y AS s FROM pa_ p JOIN lg USING (station_id, other) LEFT JOIN pa_ q ON q.station_id = p.station_id AND q.other = p.other AND q.pos = p.pos - lg.lag),
cn AS (SELECT *, sum((s IS NULL)::INT) OVER (PARTITION BY station_id, other ORDER BY pos) AS broken,
         avg(s) OVER p AS ms, avg(x) OVER p AS mx, max((x IS NOT NULL AND s IS NOT NULL)::INT) OVER p AS common FROM sh WINDOW p AS (PARTITION BY station_id, other)),
kn AS (SELECT *, last_value(CASE WHEN x IS NOT NULL THEN {'x': x, 's': s, 'broken': broken} END IGNORE NULLS)
         OVER (PARTITION BY station_id, other ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS k FROM cn),
ad AS (SELECT station_id, pos, CASE WHEN x IS NOT NULL THEN x WHEN common = 1 THEN CASE WHEN s IS NOT NULL AND k.s IS NOT NULL AND broken = k.broken THEN k.x + s - k.s END
         ELSE s - ms + mx END AS v FROM kn),
rc AS (SELECT station_id, pos, avg(v) AS v FROM ad GROUP BY 1, 2)""", """
SELECT gr.station_id, gr.month, round(gr.x, 6) AS level, round(coalesce(gr.x, rc.v) + 1e-10, 6) AS filled FROM gr LEFT JOIN rc USING (station_id, pos)""")

SQL["series_pipeline"] = SQL["score_on_holes"]
