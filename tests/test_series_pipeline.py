"""The run over a folder: stages by themselves, what they leave, and the settings file."""

import datetime as dt

import pytest

from conftest import month
from lacuna.plans import series_pipeline as P
from lacuna.sources import writers as WR


def sources(spark):
    readings = [(s, month(i), None if (i + s) % 7 == 0 else float((i * s) % 11 if s < 3 else 5), 45.0 + s, 2.0) for s in (1, 2, 3) for i in range(40)]
    weather = [(45.0 + s, 2.0, month(i), float(i), float(i % 12)) for s in (1, 2, 3) for i in range(40)]
    pet = [(45.0 + s, 2.0, month(i) + dt.timedelta(days=3), 1.0) for s in (1, 2, 3) for i in range(40)]
    soil = [(45.0, 2.0, y, 1.0, 2.0) for y in (2020, 2023)]
    make = spark.createDataFrame
    return {"readings": make(readings, "station_id long, time date, level double, lat double, lon double"),
            "weather": make(weather, "lat double, lon double, month date, rain double, temp double"),
            "pet": make(pet, "lat double, lon double, time date, pet double"),
            "soil": make(soil, "lat double, lon double, year int, sealed_area double, total_area double")}


def test_stages_one_after_the_other(spark, tmp_path):
    base = str(tmp_path / "run")
    only = lambda stage, **k: P.Settings(stages=(stage,), window=4, **k)
    assert P.run(spark, base, only("fusion"), sources(spark)) is None
    fused = spark.read.parquet(base + "/fused")
    assert set(P.FEATURES) <= set(fused.columns) and fused.count() == 120
    early = P.run(spark, base, only("completion"))  # before there are classes
    assert {r.cluster for r in early.collect()} == {None}
    P.run(spark, base, only("classes"))
    P.run(spark, base, only("training"))
    methods = {"level": ("lineaire", "bss", P.GLOBAL, P.OWN_CLASS), "rain": ("pchip",)}
    summary = P.run(spark, base, only("completion", methods=methods)).collect()
    assert {(r.station_id, r.variable, r.method) for r in summary} == {(s, v, m) for s in (1, 2, 3) for v, ms in methods.items() for m in ms}
    assert {r.cluster for r in summary} == {"reactive", "inertial"}
    done = spark.read.option("sep", ";").option("header", True).csv(base + "/completed")
    assert {"lineaire_level", "global_window_level", "class_window_level", "pchip_rain"} <= set(done.columns) and done.count() == 120
    one = P.run(spark, base, only("completion", classes=("inertial",)))
    assert {r.cluster for r in one.collect()} == {"inertial"}


def test_settings_from_a_file(tmp_path):
    p = tmp_path / "run.toml"
    p.write_text('[run]\nstages = ["classes", "completion"]\nwindow = 24\nclasses = ["reactive"]\n[methods]\nlevel = ["lineaire"]\nrain = []\n')
    s = P.Settings.from_toml(str(p))
    assert s.stages == ("classes", "completion") and s.window == 24 and s.methods == {"level": ("lineaire",)} and s.classes == ("reactive",)
    p.write_text('[run]\nstages = ["plots"]\n')
    with pytest.raises(ValueError):
        P.Settings.from_toml(str(p))


def test_files_by_station(spark, tmp_path):
    rows = [(f"A/{s}", month(i), float(i)) for s in range(5) for i in range(30)] + [("hot", month(i), 1.0) for i in range(100)]
    path = str(tmp_path / "out")
    manifest = WR.write_per_station(spark.createDataFrame(rows, "station_id string, month date, level double").repartition(4), path, rows=20).collect()
    total = {}
    for r in manifest:
        total[r.station_file] = total.get(r.station_file, 0) + r.n_rows
    assert total == {**{f"data_A_{s}": 30 for s in range(5)}, "data_hot": 100}
    by_file = {}
    for r in manifest:
        by_file[r.file] = by_file.get(r.file, 0) + r.n_rows
    assert max(by_file.values()) <= 20
    got = WR.read_station(spark, path, "A/3", "station_id string, month date, level double").orderBy("month").collect()
    assert [tuple(r) for r in got] == [("A/3", month(i), float(i)) for i in range(30)]
    assert WR.read_station(spark, path, "none", "station_id string").count() == 0
