from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from mediapanel.session import get_spark
    s = get_spark(master="local[*]", shuffle_partitions=8, app="mediapanel-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL


def rows(df, order=None):
    """Collect a small test frame as a list of dicts (tests only)."""
    if order:
        df = df.orderBy(*order)
    return [r.asDict(recursive=True) for r in df.collect()]
