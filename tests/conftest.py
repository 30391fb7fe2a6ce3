import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from barpanel.session import get_session
    s = get_session("local[4]", shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def daily(spark):
    from barpanel.sources.fixtures import panel_daily
    return panel_daily(spark, SF001).persist()


@pytest.fixture(scope="session")
def daily01(spark):
    from barpanel.sources.fixtures import panel_daily
    return panel_daily(spark, SF01).persist()
