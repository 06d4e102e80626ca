import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lacuna.session import get_spark
    s = get_spark("local[4]", shuffle_partitions=4)
    yield s


def month(i: int) -> dt.date:
    return dt.date(2020 + i // 12, i % 12 + 1, 1)


@pytest.fixture
def series(spark):
    """series(values, station=1, start=0) → DataFrame(station_id, month, level, lon, lat)."""
    def make(values, station=1, start=0, lon=1.0, lat=45.0):
        rows = [(station, month(start + i), None if v is None else float(v), lon, lat) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "station_id long, month date, level double, lon double, lat double")
    return make


def column(df, name="filled", order="month"):
    return [r[name] for r in df.orderBy(order).collect()]
