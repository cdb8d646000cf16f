import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from tidelog.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(8, "tidelog-tests")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="tidelog-test-", dir="/tmp")


@pytest.fixture(scope="session")
def smallest():
    return os.environ.get("TIDELOG_TEST_DIR", "/root/testdata/sf0.001")
