import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from kpimart.session import get_session

    s = get_session("local[*]", 8, app_name="kpimart-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def inputs_small(spark):
    from kpimart.plans import test_inputs

    return test_inputs(spark, SF0001)


def rows(df, order=None):
    """Collect as sorted list of tuples (order-insensitive compare)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
