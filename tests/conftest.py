import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cauce.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("cauce-tests", master="local[8]")
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def many_slices(spark):
    """Keep every range slice, so that the small inputs of a test spread over several of them."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")
