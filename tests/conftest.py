import os
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, REPO)

from rulegrid.session import build_session  # noqa: E402

SMALL_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = build_session("local[8]", app_name="rulegrid-tests", shuffle_partitions=8, conf={"spark.checkpoint.dir": folder})
    yield session
    session.stop()
