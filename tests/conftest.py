import os
import sys
import tempfile
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from transitlab.session import get_spark
    s = get_spark("transitlab-tests", master="local[4]", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    # Tests only: the shared location of a cluster is spark.checkpoint.dir; here a fresh local folder.
    return tempfile.mkdtemp(prefix="transitlab-test-")


def ts(s: str) -> datetime:
    return datetime.fromisoformat(s)
