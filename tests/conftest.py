import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tollgate.session import build_session

    s = build_session("local[*]", "tollgate-tests", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None) and not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tollgate-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_table(tmp_path):
    return str(tmp_path / "table")
