from __future__ import annotations

import os
import sys

import pytest

# one JVM runs all tests
os.environ.setdefault("PYSPARK_SUBMIT_ARGS", "--driver-memory 6g pyspark-shell")

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fraudmart.session import get_session  # noqa: E402
from fraudmart.warehouse import Warehouse  # noqa: E402
from planted_cases import planted_warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", app="fraudmart-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def planted(spark) -> Warehouse:
    return planted_warehouse(spark)
