import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from delaylake.session import build_session
    s = build_session("local[*]", shuffle_partitions=8, app_name="delaylake-tests",
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="delaylake-test-")


def rows(df, *cols, order=None):
    """Collected rows as tuples, optionally projected and sorted."""
    d = df.select(*cols) if cols else df
    out = [tuple(r) for r in d.collect()]
    return sorted(out, key=lambda t: tuple((x is None, x) for x in t)) if order is None else out
