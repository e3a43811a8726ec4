import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from medallion.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("medallion-tests", master="local[4]", shuffle_partitions=8,
                  extra={"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp(spark):
    """A fresh scratch folder per test (never reused, never cleaned by rm)."""
    return tempfile.mkdtemp(prefix="medallion-test-")
