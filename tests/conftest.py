import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlens.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="marketlens-tests")
    yield s
    s.stop()


def day(i: int) -> dt.date:
    return dt.date(2024, 1, 1) + dt.timedelta(days=i)


@pytest.fixture
def bars(spark):
    """bars(rows) with rows = [(symbol, day_index, close), ...] -> daily bar frame."""
    def make(rows):
        data = [(day(i), s, float(c) if c is not None else None, float(c) if c is not None else None,
                 float(c) if c is not None else None, float(c) if c is not None else None, 1)
                for s, i, c in rows]
        return spark.createDataFrame(
            data, "date date, symbol string, open double, high double, low double, close double, volume long")
    return make


@pytest.fixture
def ticks(spark):
    """ticks(rows) with rows = [(symbol, second_offset, price), ...]."""
    def make(rows):
        base = dt.datetime(2024, 1, 1)
        data = [(s, float(p) if p is not None else None, base + dt.timedelta(seconds=t), i)
                for i, (s, t, p) in enumerate(rows)]
        return spark.createDataFrame(data, "symbol string, price double, event_time timestamp_ntz, seq long")
    return make
