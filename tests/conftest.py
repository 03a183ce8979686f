import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from tallyhouse.session import local_session

    return local_session(4, shuffle_partitions=4)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def table(spark):
    """Builds a frame from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)
