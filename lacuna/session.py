"""Session helpers: one place for the configuration the operators rely on."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "lacuna",
              extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is. Only when it is
    unset (unit tests, a bare local session) is a scratch folder created.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="lacuna-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """Reliable checkpoint (survives executor loss); never a local checkpoint. What is materialised already is returned as it is."""
    ensure_checkpoint_dir(df.sparkSession)
    return df if getattr(df, "_materialised", False) else _marked(df.checkpoint(eager=True))


def _marked(df):
    df._materialised = True
    return df


def staged(df):
    """``cut_lineage`` for large tables: Parquet under the checkpoint folder. A checkpoint holds row after row, several times as
    much where values of a column repeat. For the planner its size is unknown: by the size of the files, tables would be
    broadcast that are far larger in memory."""
    schema, spark = df.schema, df.sparkSession
    if getattr(df, "_materialised", False) or any(kind in schema.simpleString() for kind in ("void", "interval")):  # not in Parquet
        return cut_lineage(df)
    path = shared_path(spark, f"staged-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return _marked(spark.read.schema(schema).parquet(path).union(spark.createDataFrame(spark.sparkContext.emptyRDD(), schema)))


def release(spark) -> None:
    """Lets Spark drop the shuffle files (and the checkpoints, if it is set to) of steps whose results are materialised. It does so when the
    driver collects its garbage, which may be long after; until then the files of all steps add up."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the checkpoint folder for intermediate tables written between stages."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)
