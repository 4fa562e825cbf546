import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tierkit.session import build_session, scratch_root

    s = build_session("local[4]", app_name="tierkit-tests", shuffle_partitions=8)
    scratch_root(s)  # sets a local checkpoint dir only when the session has none
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    # a fresh folder per test; never reused
    return tempfile.mkdtemp(prefix="tierkit-test-")
