import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from factlake.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cpus="*", shuffle_partitions=8, app="factlake-tests", memory="6g")
    # Tests set their own shared folder only because none is configured here.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="factlake-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    from factlake.session import scratch_dir
    return scratch_dir(spark, "test")
