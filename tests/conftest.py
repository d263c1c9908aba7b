from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from cardsentry.session import build_session

    ss = build_session(
        "local[*]",
        app_name="cardsentry-tests",
        shuffle_partitions=8,
    )
    ss.sparkContext.setLogLevel("ERROR")
    # tests own their checkpoint folder when the session names none
    if not ss.conf.get("spark.checkpoint.dir", None):
        ss.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cardsentry-test-"))
    yield ss
    ss.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
