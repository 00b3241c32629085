import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from joinery.session import local_session

    ckpt = tempfile.mkdtemp(prefix="joinery-test-ckpt-")
    s = local_session(
        "*",
        app="joinery-tests",
        shuffle_partitions=8,
        driver_memory="4g",
        **{"spark.checkpoint.dir": ckpt},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="joinery-test-")
