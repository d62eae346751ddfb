import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from editflow.session import build_session

    ckpt = tempfile.mkdtemp(prefix="editflow-test-ckpt-")
    session = build_session(
        "local[4]", app_name="editflow-tests", shuffle_partitions=8,
        extra={"spark.checkpoint.dir": ckpt},
    )
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    from editflow.session import scratch_path

    return lambda name: scratch_path(spark, name)
