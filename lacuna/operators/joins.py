"""Equi/semi/anti joins of the fusion and selection steps (C1, C2, C3, C13) and code helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.functions.text import zero_pad


def join_commune_coords(rows: DataFrame, communes: DataFrame, code: str = "commune_code",
                        ref_code: str = "insee_code") -> DataFrame:
    """Inner join on the 5-character zero-padded code (several reference rows multiply).

    No broadcast hint: Spark broadcasts the reference side only when its estimated size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (and AQE re-plans on the measured size)."""
    r = rows.withColumn("_code", zero_pad(F.col(code), 5))
    c = communes.withColumn("_code", zero_pad(F.col(ref_code), 5))
    return r.join(c.drop(ref_code), "_code").drop("_code")


def join_grid_cells(rows: DataFrame, cells: DataFrame, keys=("lambx", "lamby")) -> DataFrame:
    """Inner equi-join on two keys to attach cell coordinates."""
    return rows.join(cells, list(keys))


def semi_join_cells(rows: DataFrame, cells: DataFrame, key: str = "cell_id") -> DataFrame:
    """Keep rows whose key is in the cell table (no columns added)."""
    return rows.join(cells.select(key), key, "left_semi")


def skip_done(configs: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Configurations not yet present in the run log."""
    return configs.join(done.select(*keys).distinct(), keys, "left_anti")
