"""Scoring goes method by method; large tables are staged as Parquet."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.operators import scoring as SC
from lacuna.operators.impute import registry as REG
from lacuna.session import cut_lineage, ensure_checkpoint_dir, staged


@pytest.fixture
def grid(spark):
    rows = [(s, dt.date(2020 + i // 12, i % 12 + 1, 1), float((s * 7 + i * i) % 11), 1.0, 45.0, "a" if s % 2 else "b") for s in range(6) for i in range(30)]
    return spark.createDataFrame(rows, "station_id long, month date, level double, lon double, lat double, cluster string")


@pytest.fixture
def methods(spark):
    """Two plug-ins: the first counts the rows that it fills, the second notes that count when it is planned."""
    filled, noted = spark.sparkContext.accumulator(0), []

    def one(v):
        filled.add(1)
        return 1.0 if v is None else v

    def first(df, value, station, time, out):
        return df.withColumn(out, F.udf(one, T.DoubleType())(value))

    def second(df, value, station, time, out):
        noted.append(filled.value)
        return df.withColumn(out, F.coalesce(value, F.lit(2.0)))

    REG.get("lineaire")
    REG.register("first", first)
    REG.register("second", second)
    yield noted
    del REG.METHODS["first"], REG.METHODS["second"]


def test_evaluate_all_scores_a_method_before_the_next_is_planned(grid, methods):
    got = SC.evaluate_all(grid, "level", ["lineaire", "first", "second"], [0.1, 0.2])
    assert methods and methods[0] >= 2 * grid.count()
    rows = {(r.dataset, r.method, r.pct_removed) for r in got.collect()}
    assert rows == {(s, m, p) for s in range(6) for m in ("lineaire", "first", "second") for p in (0.1, 0.2)} and got.count() == len(rows)
    assert got.columns == ["dataset", "method", "NMAE", "NRMSE", "pct_removed"]


def test_score_on_holes_scores_a_method_before_the_next_is_planned(grid, methods):
    got = SC.score_on_holes(grid, "level", ["first", "second", "pchip", "lineaire"])
    assert methods and methods[0] >= grid.count()
    holed = SC.holes_blocks(grid, "level", 0.2).collect()
    for r in got.filter("method = 'second'").collect():
        truth = [h.truth for h in holed if h.station_id == r.station_id and h.hole]
        rmse = (sum((t - 2.0) ** 2 for t in truth) / len(truth)) ** 0.5
        assert r.nrmse == pytest.approx(rmse / max(truth)) and (r.lon, r.lat, r.variable) == (1.0, 45.0, "level")
    assert {(r.method, r["count"]) for r in got.groupBy("method").count().collect()} == {(m, 6) for m in ("first", "second", "pchip", "lineaire")}


def test_staged_rows_are_the_same_in_fewer_bytes(spark):
    df = spark.range(200000, numPartitions=2).select("id", (F.col("id") % 7).cast("double").alias("x"), F.lit("a name").alias("s"), F.when(F.col("id") % 3 > 0, F.lit(True)).alias("b"),
                                                     F.lit(float("nan")).alias("n"), F.lit(dt.date(2020, 1, 1)).alias("d"), F.array(F.lit(1), F.lit(None).cast("int")).alias("a"))
    base = spark._jvm.java.net.URI(ensure_checkpoint_dir(spark)).getPath()

    def size():
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(base) for f in files)

    before = size()
    kept = staged(df)
    small, before = size() - before, size()
    whole = df.checkpoint()
    assert 0 < small * 2 < size() - before
    assert kept.dtypes == df.dtypes and whole.exceptAll(kept).isEmpty() and kept.exceptAll(whole).isEmpty()


def test_staged_tables_are_not_taken_for_small_ones(spark):
    kept = staged(spark.range(1000).select("id", F.lit(1.0).alias("x")))
    plan = kept.join(kept.select("id", F.col("x").alias("y")), "id")._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_what_is_materialised_is_not_copied(spark):
    kept = staged(spark.range(5))
    assert cut_lineage(kept) is kept and staged(kept) is kept and cut_lineage(cut := cut_lineage(spark.range(5))) is cut
    assert staged(spark.range(0)).columns == ["id"] and staged(spark.range(0)).isEmpty()
    assert staged(spark.range(3).withColumn("v", F.lit(None))).count() == 3  # void has no Parquet form
