"""The whole run over a folder: fusion, classes, training, completion with scores; each stage can be switched on by itself.

A stage reads what the stages before it have written under ``base``, so a run can stop after any of them and
go on later with other settings:

  fused/                     the fused table of all nine features, stations of too few years left out
  classes/cluster=…          the same by class (A9)
  models/, scaler/           window models of all series and of each class (J5), and their scaler (J4)
  completed/, …-manifest/    every variable with its methods' columns, in files by station (A8)
  summary/                   NRMSE on artificial holes by station, variable and method (I3)
"""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lacuna.operators import cluster as CL
from lacuna.operators import scoring as SC
from lacuna.operators import weather as W
from lacuna.operators.impute import registry as REG
from lacuna.operators.impute import window_model as WM
from lacuna.operators.series import MONTH, STATION
from lacuna.plans.fusion import fuse
from lacuna.session import cut_lineage
from lacuna.sources import readers as RD
from lacuna.sources import writers as WR

FEATURES = ["level", "lon", "lat", "time_num", "pet", "rain", "temp", "sealed_area", "total_area"]
STAGES = ("fusion", "classes", "training", "completion")
GLOBAL, OWN_CLASS = "global/window", "class/window"


@dataclass(frozen=True)
class Settings:
    """What to run. ``methods``: for each variable to complete, its methods; ``classes``: only these, none means all."""
    stages: tuple[str, ...] = STAGES
    methods: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"level": ("lineaire", "bss")})
    classes: tuple[str, ...] = ()
    min_years: float = 0.0
    rain: str = "sum"  # or "mean", a rate a day
    window: int = 120
    ridge: float = 1e-3
    holed: tuple[str, ...] = ("level",)
    pct: float = 0.2
    sizes: tuple[int, int] = (1, 5)
    seed: int = 42

    @staticmethod
    def from_toml(path: str) -> "Settings":
        """Table [run] has the fields above but for methods; [methods] lists the methods of each variable."""
        with open(path, "rb") as f:
            given = tomllib.load(f)
        plain = {k: tuple(v) if isinstance(v, list) else v for k, v in given.get("run", {}).items()}
        unknown = set(plain) - set(Settings.__dataclass_fields__)
        if unknown or set(plain.get("stages", ())) - set(STAGES):
            raise ValueError(f"unknown settings: {sorted(unknown | set(plain.get('stages', ())) - set(STAGES))}")
        if "methods" in given:
            plain["methods"] = {v: tuple(m) for v, m in given["methods"].items() if m}
        return Settings(**plain)


def fusion(sources: dict[str, DataFrame], settings: Settings, base: str) -> None:
    """``sources``: readings, weather (by point and month), pet (daily, by point) and soil."""
    weather = W.rain_daily_rate(sources["weather"], settings.rain)
    f = fuse(sources["readings"], weather, W.monthly_by_point(sources["pet"], "pet", "time", "sum"), sources["soil"])
    f = f.withColumn("time_num", F.unix_seconds(F.col(MONTH).cast("timestamp")).cast("double"))
    if settings.min_years > 0:
        f = CL.quality_filter(f, "level", settings.min_years)
    WR.write_table(f, os.path.join(base, "fused"))


def classes(spark: SparkSession, base: str) -> None:
    WR.write_by_cluster(CL.assign_clusters(spark.read.parquet(os.path.join(base, "fused")), "level"), os.path.join(base, "classes"))


def _series(spark: SparkSession, base: str) -> DataFrame:
    return RD.read_clusters_or_fused(spark, os.path.join(base, "classes"), os.path.join(base, "fused"))


def training(spark: SparkSession, settings: Settings, base: str) -> None:
    df = cut_lineage(_series(spark, base))
    _, scaler = WM.fit_global_and_per_cluster(df, "level", FEATURES, os.path.join(base, "models"), settings.window,
                                              ridge=settings.ridge, holed=list(settings.holed))
    scaler.write.mode("overwrite").parquet(os.path.join(base, "scaler"))


def _trained(spark: SparkSession, base: str) -> None:
    """The saved models as methods."""
    model, scaler = WM.WindowModel.load(spark, os.path.join(base, "models"), FEATURES, "level"), spark.read.parquet(os.path.join(base, "scaler"))

    def method(own: bool):
        def fn(df, value, station=STATION, time=MONTH, out=None):
            found = WM.apply_windows(df, model, scaler, "cluster", station, time)
            found = found.filter(F.col("scope") != WM.ALL if own else F.col("scope") == WM.ALL).select(station, time, F.col("pred").alias("_model"))
            keep = [c for c in df.columns if c != out]
            return df.join(found, [station, time], "left").withColumn(out, F.col("_model")).select(*keep, out)
        return fn

    REG.register(GLOBAL, method(False))
    REG.register(OWN_CLASS, method(True))


def completion(spark: SparkSession, settings: Settings, base: str) -> DataFrame:
    if any(m in (GLOBAL, OWN_CLASS) for methods in settings.methods.values() for m in methods):
        _trained(spark, base)
    df = cut_lineage(CL.cluster_selection(_series(spark, base), list(settings.classes)))
    done = REG.complete_variables(df, {v: list(m) for v, m in settings.methods.items()})
    WR.write_per_station(done.withColumnsRenamed({c: c.replace("/", "_") for c in done.columns}), os.path.join(base, "completed"))
    scores = None
    for variable, methods in settings.methods.items():
        s = SC.score_on_holes(df, variable, list(methods), settings.pct, settings.sizes, settings.seed)
        scores = s if scores is None else scores.unionByName(s)
    path = os.path.join(base, "summary")
    WR.write_table(scores, path)
    return spark.read.parquet(path)


def run(spark: SparkSession, base: str, settings: Settings, sources: dict[str, DataFrame] | None = None) -> DataFrame | None:
    """Runs the chosen stages in order; the summary, if completion is one of them."""
    if "fusion" in settings.stages:
        fusion(sources or {}, settings, base)
    if "classes" in settings.stages:
        classes(spark, base)
    if "training" in settings.stages:
        training(spark, settings, base)
    return completion(spark, settings, base) if "completion" in settings.stages else None
