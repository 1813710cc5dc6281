"""One small session for all tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from corpusmill.session import build_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", "tests", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "3g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tiny():
    return f"{DATA}/sf0.001"
