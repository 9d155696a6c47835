import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))  # small_data, whatever folder pytest is started from


@pytest.fixture(scope="session")
def spark():
    from shelfprice.session import get_session

    s = get_session("local[4]", shuffle_partitions=8, app_name="shelfprice-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from shelfprice.session import scratch_path

    return lambda *parts: scratch_path(spark, *parts)
