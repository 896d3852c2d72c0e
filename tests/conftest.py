import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="strata-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples (optionally of selected columns) for order-free compares."""
    d = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in d.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint folder (never reused or deleted)."""
    from strata.session import scratch_path
    return lambda name="t": scratch_path(spark, name)
