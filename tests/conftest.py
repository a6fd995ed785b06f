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
    from strandline.session import build_session
    scratch = tempfile.mkdtemp(prefix="strandline-test-")
    s = build_session("local[4]", 4, app="strandline-tests",
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    yield s
    s.stop()


@pytest.fixture
def tmp_out():
    return tempfile.mkdtemp(prefix="strandline-out-")
