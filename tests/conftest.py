import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martforge.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[4]", shuffle_partitions=4, app_name="martforge-tests")
    yield s


def rows(df, *cols):
    """Collect ``cols`` (default: all) as a list of tuples."""
    cols = cols or df.columns
    return [tuple(r[c] for c in cols) for r in df.collect()]
