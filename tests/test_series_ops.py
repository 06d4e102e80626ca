import datetime as dt

import pytest

from conftest import column
from lacuna.operators import series as S
from lacuna.operators import cluster as CL
from lacuna.operators.spatial import nearest_valid_join, to_long, reference_year
from lacuna.operators.holes import holes_blocks, holes_points
from lacuna.functions import stats as ST
from lacuna.functions.text import zero_pad
from pyspark.sql import functions as F

N = None


def test_step_months_streak_segments_densify(spark):
    months = [dt.date(2020, m, 1) for m in (1, 2, 3, 5, 6)]
    df = spark.createDataFrame([(1, m, 1.0, 0.0, 0.0) for m in months],
                               "station_id long, month date, level double, lon double, lat double")
    assert S.longest_streak(df, "level").collect()[0]["longest_streak"] == 3
    d = S.densify(df)
    assert d.count() == 6
    seg = S.segments_and_gaps(d, "level").orderBy("segment").collect()
    assert len(seg) == 2 and seg[0]["n_rows"] == 3 and seg[0]["gap_rows"] == 1


def test_fluctuation_classes(series):
    flat = series([3, 3, 3, 3])
    idx = CL.cluster_two_way(CL.fluctuation_index(flat, "level")).collect()[0]
    assert idx["fluctuation_index"] == 0.0 and idx["cluster"] == "inertial"
    allnull = series([N, N, N])
    c = CL.assign_clusters(allnull, "level").select("cluster").distinct().collect()
    assert c[0]["cluster"] == "inertial"


def test_metrics_fixtures(spark):
    zm = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "r double, p double")
    row = zm.agg(ST.nmae("r", "p").alias("a"), ST.nrmse("r", "p").alias("b")).collect()[0]
    assert row["a"] == 0.0 and row["b"] == -1e10
    neg = spark.createDataFrame([(-4.0, -3.0), (-2.0, -3.0)], "r double, p double")
    row = neg.agg(ST.nmae("r", "p").alias("a"), ST.nrmse("r", "p").alias("b")).collect()[0]
    assert row["a"] == pytest.approx(1.0 / -2.0)
    assert row["b"] == pytest.approx(1.0 / 2.0)


def test_zero_pad(spark):
    df = spark.createDataFrame([("1001",), ("45234",), ("123456",)], "c string")
    assert [r[0] for r in df.select(zero_pad("c")).collect()] == ["01001", "45234", "123456"]


def test_nearest_valid_two_points_tie_and_none(spark):
    t = spark.createDataFrame([(1, dt.date(2020, 1, 1), 0.0, 0.0), (1, dt.date(2020, 2, 1), 0.0, 0.0)],
                              "station_id long, month date, lat double, lon double")
    pts = spark.createDataFrame([
        (0.1, 0.0, dt.date(2020, 1, 1), None, 5.0),      # nearer, rain null
        (2.0, 0.0, dt.date(2020, 1, 1), 7.0, 6.0),       # farther, valid rain
        (-0.5, 0.0, dt.date(2020, 2, 1), 1.0, None),     # tie at 0.5 …
        (0.5, 0.0, dt.date(2020, 2, 1), 2.0, None)],     # … smallest lat wins
        "lat double, lon double, month date, rain double, temp double")
    out = nearest_valid_join(t, to_long(pts, ["rain", "temp"]), ["rain", "temp"]).orderBy("month").collect()
    assert out[0]["rain"] == 7.0 and out[0]["temp"] == 5.0
    assert out[1]["rain"] == 1.0 and out[1]["temp"] is None


def test_soil_years(spark):
    df = spark.createDataFrame([(dt.date(y, 1, 1),) for y in (2019, 2022, 2023, 2024)], "m date")
    assert [r[0] for r in df.select(reference_year(F.col("m"))).collect()] == [2020, 2020, 2023, 2023]


def test_holes_small_dropped(series):
    df = series([1, 2, 3, 4])
    assert holes_points(df, "level", 0.5).count() == 0
    assert holes_blocks(df, "level", 0.5).count() == 0


def test_holes_blocks_hit_count(series):
    df = series([float(i) for i in range(100)])
    h = holes_blocks(df, "level", 0.2, seed=7, sizes=(1, 5))
    n = h.filter("hole").count()
    assert 20 <= n <= 24


def test_cumulative_reconstruct_inverts_variation(series):
    df = series([1.0, 4.0, 2.0, 8.0, 5.0])
    d = S.variation_transform(df.withColumn("delta", F.col("level")), ["delta"])
    r = S.cumulative_reconstruct(d, "level", "delta", sign=-1)
    assert column(r, "rebuilt") == pytest.approx([1.0, 4.0, 2.0, 8.0, 5.0])


@pytest.mark.parametrize("batches", [(16, 128), (2,)])
def test_nearest_valid_join_equals_brute_force(spark, batches):
    import random
    r = random.Random(4)
    near = [(r.uniform(0, 3), r.uniform(0, 3)) for _ in range(300)]
    grid = [(float(x), float(y)) for x in range(6) for y in range(6)]  # ties
    points = [(la, lo, m, r.random() if r.random() < 0.1 else None, r.random() if m != 2 else None) for la, lo in near + grid for m in (1, 2)]
    targets = [(i, r.choice([0.5, 1.5, 2.0, r.uniform(0, 4)]), r.choice([0.5, 2.5, r.uniform(0, 4)]), r.choice([1, 2, 3])) for i in range(150)] + [(999, None, 1.0, 1)]
    pts = spark.createDataFrame(points, "lat double, lon double, month int, rain double, temp double")
    t = spark.createDataFrame(targets, "id long, lat double, lon double, month int")
    got = {x.id: (x.rain, x.temp) for x in nearest_valid_join(t, to_long(pts, ["rain", "temp"]), ["rain", "temp"], batches=batches).collect()}

    def best(la, lo, m, col):
        c = [((la - p[0]) ** 2 + (lo - p[1]) ** 2, p[0], p[1], p[col]) for p in points if p[2] == m and p[col] is not None]
        return min(c)[3] if c else None

    for i, la, lo, m in targets:
        assert got[i] == ((None, None) if la is None else (best(la, lo, m, 3), best(la, lo, m, 4)))
