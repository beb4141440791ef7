from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from costpulse.session import get_spark

    # Tests set their own checkpoint folder (a cluster names a shared one).
    ckpt = tempfile.mkdtemp(prefix="costpulse-test-")
    session = get_spark("costpulse-tests", master="local[4]", conf={
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": ckpt,
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="costpulse-case-")
