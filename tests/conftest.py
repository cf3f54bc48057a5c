import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from relprep.session import build_session  # noqa: E402

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    # local[*,4]: up to 4 attempts per task, so retry behaviour can be tested.
    s = build_session("local[*,4]", 8, app_name="relprep-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def smoke_dir():
    if not os.path.isdir(SMOKE):
        pytest.skip("driver test data not present")
    return SMOKE
