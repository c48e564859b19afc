import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import get_session

    s = get_session(master="local[4]", app="tidemark-tests", shuffle_partitions=4)
    yield s
    s.stop()


def rows(df, cols=None):
    """Sorted plain tuples of a DataFrame (None-safe ordering)."""
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))
