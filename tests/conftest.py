import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from holecard.session import build_session  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="holecard-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def tmp_out(tmp_path):
    return str(tmp_path)
