import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelforge.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[*]", shuffle_partitions=8, app_name="panelforge-tests",
                            driver_memory="4g")
    yield session
    session.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)


def rows(df, *cols):
    """Sorted list of tuples, for order-insensitive comparison."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()),
                  key=lambda t: [(v is not None, str(v)) for v in t])
