import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from csvforge.session import local_session
    s = local_session(4, shuffle_partitions=8, app="csvforge-tests")
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
