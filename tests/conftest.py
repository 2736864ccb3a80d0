from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarterdeck.session import build_session

    ckpt = tempfile.mkdtemp(prefix="qd-test-ckpt-")
    session = build_session(
        "local[*]", app_name="quarterdeck-tests", shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": ckpt},
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="qd-test-")
