from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(scratch):
    from lakemart.session import local_session

    s = local_session(cores="*", shuffle_partitions=8, scratch=scratch, driver_memory="8g", app="lakemart-tests")
    yield s
    s.stop()
