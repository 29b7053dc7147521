import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sievewright.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "6g")
    if not session.conf.get("spark.checkpoint.dir", None) and not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sievewright-ckpt-"))
    yield session
    session.stop()
