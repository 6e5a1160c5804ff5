from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from commerce_marts.session import get_session

    s = get_session(4, shuffle_partitions=4, app="commerce_marts_tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cm-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fixture_raw(spark):
    """The ten-order fixture (FIXTURES.md §2) as the nine raw sources."""
    from tests.fixture_data import ten_order_sources

    return ten_order_sources(spark)


@pytest.fixture(scope="session")
def layers(fixture_raw):
    from commerce_marts.plans.layers import Layers

    return Layers(fixture_raw)
