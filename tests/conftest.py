"""One local session for all tests, and helpers to build small tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from sedimenta.session import local_session

    session = local_session("tests", 4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    yield session
    session.stop()


SF = os.environ.get("SEDIMENTA_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf():
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    return SF


def rows(df, *cols):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
