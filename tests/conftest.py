import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", shuffle=8)
    yield session
    session.stop()


@pytest.fixture
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("test data not available")
    return SMALL


@pytest.fixture
def rows(spark):
    """rows("a int, b string", (1, "x"), ...) -> DataFrame"""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)


@pytest.fixture
def path(spark):
    from tidemark.session import fresh_path

    return lambda label="t": fresh_path(spark, label)
