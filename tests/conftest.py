import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from tidemart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(master="local[*]", shuffle_partitions=8, app_name="tidemart-tests")
    session.conf.set("spark.sql.maxMetadataStringLength", "100000")  # full PushedFilters in plans
    yield session
    session.stop()
