import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cataloom.session import build_session

    scratch = tempfile.mkdtemp(prefix="cataloom-test-", dir="/tmp")
    session = build_session(
        master="local[*]",
        shuffle_partitions=8,
        checkpoint_dir=os.path.join(scratch, "checkpoints"),
        extra_conf={"spark.sql.warehouse.dir": os.path.join(scratch, "warehouse")},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def scratch_dir():
    return tempfile.mkdtemp(prefix="cataloom-scratch-", dir="/tmp")
