import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerlens.session import get_session
    s = get_session("local[4]", app="ledgerlens-tests", shuffle_partitions=4)
    # tests only: a private checkpoint folder when the session names none
    if not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ll-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.001"
