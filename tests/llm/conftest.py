import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_data import EDGES, docs_of  # noqa: E402

from tidemart.llm.common import ship_package  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def edges(spark):
    return docs_of(spark, EDGES).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return docs_of(spark, []).cache()
