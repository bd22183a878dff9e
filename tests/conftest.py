import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from football_fixture import write_football_fixture  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tools.local import local_session

    s = local_session("*", shuffle_partitions=8, app="rateprofile-tests", checkpoint_dir=tempfile.mkdtemp(prefix="rateprofile-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def football_dir():
    root = tempfile.mkdtemp(prefix="rateprofile-football-", dir="/tmp")
    write_football_fixture(root)
    return root


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="rateprofile-test-", dir="/tmp")


def rows(df, *cols):
    """Sorted plain tuples of ``cols`` (all columns when none given)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
