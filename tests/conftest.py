import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vaultline.session import build_session
    ckpt = tempfile.mkdtemp(prefix="vaultline-test-ckpt-")
    s = build_session("local[4]", 4, app_name="vaultline-tests",
                      extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def model():
    from vaultline.model import VaultModel
    return VaultModel.load()
