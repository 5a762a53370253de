import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from quire.session import build_session
    s = build_session("local[4]", 8, app="quire-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="quire-test-ckpt-")})
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
