import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from histmart.session import get_spark

    s = get_spark("local[4]", shuffle_partitions=4, app_name="histmart-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as sorted tuples (order-insensitive compare)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))
