import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threatlens.session import build_session  # noqa: E402

BASE = dt.datetime(2024, 1, 1, 12, 0, 0)


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4)
    yield s
    s.stop()


def at(seconds: float) -> dt.datetime:
    return BASE + dt.timedelta(seconds=seconds)


def collect(df, *order):
    rows = df.orderBy(*order).collect() if order else df.collect()
    return [r.asDict(recursive=True) for r in rows]
