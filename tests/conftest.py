from __future__ import annotations

import os
import sys
import tempfile
import time

import pytest

os.environ["TZ"] = "UTC"
time.tzset()

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ridepulse.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="ridepulse-test-ckpt-")
    s = build_session(
        "local[4]",
        "ridepulse-tests",
        shuffle_partitions=8,
        extra_conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ridepulse-test-")
