"""Readers on landed files, the session's checkpoint rule and the calendar functions."""

import datetime as dt
import gzip
import zipfile

import pytest
from pyspark.sql import functions as F

from lacuna import session
from lacuna.functions import calendar as cal
from lacuna.operators import scale as SCL
from lacuna.sources import readers as RD

SCHEMA = "a long, note string, b double"
PLAIN = "a;b;note\n1;1.5;plain\n2;;\"two\nlines\"\n"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_mixed_files_by_magic_with_quoted_line_breaks(spark, tmp_path):
    (tmp_path / "one.csv").write_text(PLAIN)
    (tmp_path / "two.csv").write_bytes(gzip.compress(b"note;a;b\n\"x;y\";3;2\n"))  # gzip without its ending
    with zipfile.ZipFile(tmp_path / "three.csv.zip", "w") as z:
        z.writestr("in/four.csv", "b;a\n4.5;4\n")
        z.writestr("five.csv", "a;b;note\n5;5;é\n")
        z.writestr("read.me", "no;table\n")
    assert rows(RD.scan_mixed_compressed(spark, str(tmp_path), SCHEMA)) == [
        (1, "plain", 1.5), (2, "two\nlines", None), (3, "x;y", 2.0), (4, None, 4.5), (5, "é", 5.0)]


def test_mixed_files_in_splits_and_empty_ones(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a;b\n1;1.5\n")
    (tmp_path / "two.csv.gz").write_bytes(gzip.compress(b"b;a\n2.5;2\n"))
    (tmp_path / "none.csv").write_text("")
    for multiline in (False, True):
        assert rows(RD.scan_mixed_compressed(spark, str(tmp_path), "a long, b double", multiline=multiline)) == [(1, 1.5), (2, 2.5)]
    (tmp_path / "sub").mkdir()
    assert RD.scan_mixed_compressed(spark, str(tmp_path / "sub"), "a long").count() == 0


def test_columns_are_taken_by_name(spark, tmp_path):
    (tmp_path / "s.csv").write_text("b;a\n1.5;1\n")
    assert rows(RD.scan_series_csv(spark, str(tmp_path / "s.csv"), "a long, b double")) == [(1, 1.5)]
    assert rows(RD.scan_series_folder(spark, str(tmp_path), "a long, b double, c string")) == [(1, 1.5, None)]
    got = RD.scan_series_folder(spark, str(tmp_path), "a long, b double", with_file=True).collect()[0]
    assert got.source_file.endswith("s.csv")
    assert RD.scan_series_folder(spark, str(tmp_path), "a long", glob="*.none").count() == 0


def test_a_differing_header_is_an_error_in_a_folder_and_fine_with_drift(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a;b\n1;1.5\n")
    (tmp_path / "two.csv").write_text("b;a\n2.5;2\n")
    (tmp_path / "three.csv").write_text("a;extra\n3;x\n")
    with pytest.raises(Exception):
        RD.scan_series_folder(spark, str(tmp_path), "a long, b double").collect()
    paths = [str(tmp_path / f"{n}.csv") for n in ("one", "two", "three")]
    assert rows(RD.scan_schema_drift(spark, paths, "a long, b double")) == [(1, 1.5), (2, 2.5), (3, None)]


def test_preamble(spark, tmp_path):
    (tmp_path / "one.csv").write_text("x\n\ny;z\n--\n# a; b\n1;1.5\n\n2;\n")
    (tmp_path / "two.csv").write_text("x\ny\nz\n--\nb ;#a\n2.5;3\n")
    assert rows(RD.scan_with_preamble(spark, str(tmp_path), "a long, b double")) == [(1, 1.5), (2, None), (3, 2.5)]
    assert {(r.i, r["name"]) for r in RD.header_names(spark, str(tmp_path)).collect()} == {(0, "a"), (1, "b"), (0, "b"), (1, "a")}


def test_preamble_with_many_columns(spark, tmp_path):
    names = [f"c{i}" for i in range(250)]
    (tmp_path / "one.csv").write_text("x\n" * 4 + "#" + ";".join(names) + "\n" + ";".join(map(str, range(250))) + "\n")
    (tmp_path / "two.csv").write_text("x\n" * 4 + "c249;c3\n7;8\n")
    assert rows(RD.scan_with_preamble(spark, str(tmp_path), "c3 long, c120 long, c249 long")) == [(3, 120, 249), (8, None, 7)]


def test_clusters_or_fused(spark, tmp_path):
    spark.createDataFrame([(1, 2.0)], "station_id long, level double").write.parquet(str(tmp_path / "fused"))
    read = lambda: rows(RD.read_clusters_or_fused(spark, str(tmp_path / "clustered"), str(tmp_path / "fused")))
    assert read() == [(1, 2.0, None)]
    spark.createDataFrame([(7, "reactive")], "station_id long, cluster string").write.parquet(str(tmp_path / "clustered"))
    assert read() == [(7, "reactive")]
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"no parquet at all")
    with pytest.raises(Exception):
        RD.read_clusters_or_fused(spark, str(broken), str(tmp_path / "fused"))


def test_reused_scaler_is_not_refitted(spark, tmp_path):
    a, b = (spark.createDataFrame([(x,) for x in v], "x double") for v in ([0.0, 10.0], [0.0, 20.0]))
    path = str(tmp_path / "scaler")
    SCL.reuse_scaler(spark, a, ["x"], path)
    out, scaler = SCL.reuse_scaler(spark, b, ["x"], path)
    assert rows(out) == [(-1.0,), (3.0,)]
    assert rows(SCL.minmax_inverse(out, ["x"], scaler)) == [(0.0,), (20.0,)]


def test_epoch_seconds_in_two_zones(spark):
    df = spark.createDataFrame([(dt.date(1970, 1, 1),), (dt.date(2024, 7, 1),)], "d date")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "Europe/Paris"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert rows(df.select(cal.epoch_seconds(F.col("d")))) == [(0,), (1719792000,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf = {}
        sparkContext = Context

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session)


def test_run_log_evaluates_its_errors_once(spark, monkeypatch, tmp_path):
    from lacuna.plans import catalog
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = [(i, "knn", 0.5, 0.25, 0.1 if i % 2 else 0.2) for i in range(10)]
    df = spark.createDataFrame(rows, "dataset long, method string, NMAE double, NRMSE double, pct_removed double")
    monkeypatch.setattr(catalog, "_errors", lambda *_: df.mapInPandas(counted, df.schema))
    monkeypatch.setattr(catalog, "_stage", lambda *_: str(tmp_path / "log"))
    assert sorted(map(tuple, catalog.q_append_run_log(spark, "").collect())) == rows
    assert seen.value == 10
