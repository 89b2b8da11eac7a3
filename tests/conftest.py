import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orelake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, "orelake-tests")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def nothing_stays_cached():
    """What a module caches would stand in the plans that the next one looks at."""
    yield
    session = SparkSession.getActiveSession()
    if session is not None:
        session.catalog.clearCache()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"


def rows(df, *order):
    """Rows as tuples, sorted by the given columns (all columns by default)."""
    found = [tuple(r) for r in df.select(*order).collect()] if order else [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda t: tuple((v is not None, v) if not isinstance(v, dict) else str(v) for v in t))


@pytest.fixture(scope="session")
def collect():
    return rows
