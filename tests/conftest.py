import os
import sys
import tempfile

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(_HERE))
# Test-only backends live in tests/backends.py; Python workers must import it.
os.environ["PYTHONPATH"] = os.pathsep.join([_HERE, os.environ.get("PYTHONPATH", "")])

from rowsmith.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores=8, shuffle_partitions=8)
    # Tests run without a cluster: give the session its own checkpoint folder.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="rowsmith-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="rowsmith-test-")
